"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases (each the longest known phrase plus one character).
The set of phrases says what a compressor could reuse; its hashes' smallest ``SIZE`` values
are the fingerprint, and two fingerprints' likeness estimates the overlap of the phrase sets
(exactly, where a set has at most ``SIZE`` phrases).

``neighbours`` also fingerprints each text edited with its successor: documents are
range-partitioned and sorted by id once, so a task sees a document and its successor side by
side; only each partition's first and last text meet in a second, small step. Null texts are
empty; the empty text has the empty fingerprint, like (1.0) only to itself. Repeated rows are
neighbours of each other, ties of the id ordered by text. Null ids come first. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import staged, text_or_empty
from touchline.llm.words import flat, mix64

SIZE = 64


def parse(text: str, phrases: dict[str, None], rest: str = "") -> str:
    """Add the phrases of ``text``, read after ``rest``; returns the unfinished last phrase."""
    for char in text:
        rest += char
        if rest not in phrases:
            phrases[rest] = None
            rest = ""
    return rest


_FACTOR = 0x9E3779B97F4A7C15
_powers = np.full(1, _FACTOR, np.uint64)


def _grow(n: int) -> np.ndarray:
    """At least the first ``n`` powers of the factor."""
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(max(n, 1 << 12), _FACTOR, np.uint64))
    return _powers


def hashes(phrases: list[str]) -> np.ndarray:
    """64-bit hashes of phrases of any length, from sums over their bytes."""
    data, places = flat(pa.array(phrases, pa.large_string()))
    start, end = places[:-1], places[1:]
    inside = np.arange(len(data)) - np.repeat(start, end - start)
    powers = _grow(int(inside.max(initial=0)) + 1)
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers[inside]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return mix64(sums[end] - sums[start])


def smallest(hashed: np.ndarray) -> np.ndarray:
    """The fingerprint values: the ``SIZE`` smallest distinct upper halves, ascending."""
    if len(hashed) > 4 * SIZE:
        hashed = np.partition(hashed, 4 * SIZE)[: 4 * SIZE]
    return np.unique((hashed >> np.uint64(32)).astype(np.uint32))[:SIZE]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:SIZE]
    return float(np.count_nonzero(np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)) / len(both))


def encoded(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


class Parsed:
    """A text parsed up to where its edit begins, and its whole fingerprint."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text, self.n = doc_id, text, len(text)
        self.replaced = self.n // 4
        phrases: dict[str, None] = {}
        self.rest = parse(text[: self.n - self.replaced], phrases)
        known = len(phrases)
        self.kept = phrases if not self.replaced else dict(phrases)
        parse(text[self.n - self.replaced :], phrases, self.rest)
        every = hashes(list(phrases))
        self.kept_hashes = every[:known]
        self.values = smallest(every)

    def row(self, following: Parsed) -> tuple:
        put = following.text[: self.replaced]
        edited = self.text[: self.n - self.replaced] + put
        if put:
            known, phrases = len(self.kept), dict(self.kept)
            parse(put, phrases, self.rest)
            fresh = hashes(list(phrases)[known:]) if len(phrases) > known else np.zeros(0, np.uint64)
            values = smallest(np.concatenate([self.kept_hashes, fresh]))
        else:
            values = smallest(self.kept_hashes)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        return (
            self.doc_id, self.n, sha, encoded(self.values), encoded(values),
            likeness(self.values, values), likeness(self.values, following.values),
        )


FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
DIGEST = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
FLUSH = 512


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    types += [pa.int32(), pa.string(), pa.string()]
    names = [*FIELDS, "part", "first_text", "last_text"]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(columns, names)


def _walk(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition; the last document's row is open and carries its text, and
    a row without figures carries the first document's text."""
    part, before, rows, id_type = TaskContext.get().partitionId(), None, [], pa.int64()
    empty = (None,) * 6
    for batch in parts:
        id_type = batch.schema.field("doc_id").type
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            now = Parsed(doc_id, text)
            if before is None:
                rows.append((doc_id, *empty, part, text, None))
            else:
                rows.append((*before.row(now), part, None, None))
            before = now
            if len(rows) >= FLUSH:
                yield _batch(rows, id_type)
                rows = []
    if before is not None:
        rows.append((before.doc_id, *empty, part, None, before.text))
    if rows:
        yield _batch(rows, id_type)


def _close(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        rows = [
            (*Parsed(doc_id, last).row(Parsed(None, first)), 0, None, None)
            for doc_id, last, first in zip(*(batch[c].to_pylist() for c in ("doc_id", "last_text", "first_text")))
        ]
        if rows:
            yield _batch(rows, batch.schema.field("doc_id").type)


def neighbours(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: the columns of FIELDS."""
    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {DIGEST}, part int, first_text string, last_text string"
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    walked = staged(ordered.mapInArrow(_walk, schema))
    # Two texts per non-empty partition: their order is settled without the texts.
    firsts = walked.filter(F.col("first_text").isNotNull()).select("part", "first_text")
    lasts = walked.filter(F.col("last_text").isNotNull()).select("part", "doc_id", "last_text")
    order = Window.orderBy("part")
    numbers = firsts.select("part")
    following = numbers.select("part", F.lead("part").over(order).alias("next"), F.min("part").over(Window.partitionBy()).alias("least"))
    following = following.select("part", F.coalesce("next", "least").alias("next"))
    ends = lasts.join(following, "part").join(firsts.withColumnRenamed("part", "next"), "next")
    closed = ends.select("doc_id", "last_text", "first_text").mapInArrow(_close, schema)
    return walked.filter(F.col("n_chars").isNotNull()).unionByName(closed).select(*FIELDS)

