"""Toxic spans by a linear-chain conditional random field, and document scores from them.

Labels are per document, so token labels are derived: hashed counts over all training rows say
in how many documents, and in how many toxic ones, a word or one of its prefixes occurs, and a
word of a toxic document is labelled toxic if that evidence is strong. The field learns on a
sample of about ``SAMPLE`` training rows how word and prefix evidence and the neighbouring
labels combine; forward-backward gives every word's marginal. A document's score is a logistic
function of its marginals, fitted on the same sample. ``spans`` returns the offending offsets.

Training rows have a label and crc32(id as text) mod 3 other than 1; a document labelled more
than once counts as toxic if any label says so. Null and empty texts get the score of a text
without toxic words. Without training rows every score is 0. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import crf
from touchline.llm.common import crc_bucket
from touchline.llm.words import LETTERS, Once, Piece, flat, pieces, slices

FOLDS, HELD_OUT = 3, 1
SAMPLE = 4000
PARTS, ROUNDS = 4, 2
BLOCK = 1 << 17  # words of the sample that a task trains on at once
SLICE = 1 << 20  # bytes of texts that a task scores at once; a longer text is scored whole
CUT = 0.7
# Hash bits of each feature's table: the word, then prefixes of so many bytes.
WORD_BITS, PREFIX_BITS, PREFIXES = 17, 16, (5, 6, 7, 8)
BITS = (WORD_BITS, *[PREFIX_BITS] * len(PREFIXES))
PLACES = np.concatenate([[0], np.cumsum([1 << b for b in BITS])])
STRONG = 2.0  # log odds ratio that marks a word of a toxic document as toxic
K = len(BITS) + 2


def _slots(piece: Piece) -> list[np.ndarray]:
    """Table slots per feature; -1 where a word is shorter than the prefix."""
    start, end = piece.start, piece.end
    out = [(piece.word_hashes() >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
    for size, place in zip(PREFIXES, PLACES[1:]):
        stop = np.minimum(start + size, end)
        slot = (piece.hashes(start, stop) >> np.uint64(64 - PREFIX_BITS)).astype(np.int64) + place
        out.append(np.where(end - start >= size, slot, -1))
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) -> (slot, n, t): documents and toxic documents having the slot; the slot
    after all others stands for all documents."""
    n, t = np.zeros((2, int(PLACES[-1]) + 1), np.int64)
    for batch in batches:
        toxic = batch["toxic"].to_numpy().astype(bool)
        n[-1] += len(toxic)
        t[-1] += np.count_nonzero(toxic)
        each = [Once(int(PLACES[-1])) for _ in BITS]
        for piece in pieces(batch["text"], LETTERS):
            for slots, once in zip(_slots(piece), each):
                at = np.flatnonzero(slots >= 0)
                doc, slot = once.fresh(piece.doc[at], slots[at])
                n += np.bincount(slot, minlength=len(n))
                t += np.bincount(slot[toxic[doc]], minlength=len(t))
    seen = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(n[seen]), pa.array(t[seen])], ["slot", "n", "t"]
    )


@dataclass
class Model:
    """Evidence per slot (log odds ratio), field, and weights of a document's summary."""

    evidence: np.ndarray
    field: crf.Crf
    judge: np.ndarray


def evidence(n: np.ndarray, t: np.ndarray, share: float) -> np.ndarray:
    """Shrunk log odds ratio of being toxic; 0 for a slot that was not seen."""
    odds = (t + 2 * share) / (n - t + 2 * (1 - share))
    return np.clip(np.log(odds) - np.log(share / (1 - share)), -2, 6).astype(np.float32)


def features(piece: Piece, table: np.ndarray) -> np.ndarray:
    """words x K: evidence of each feature (0 where missing), the largest, and if it is strong."""
    out = np.zeros((len(piece.start), K), np.float32)
    for k, slots in enumerate(_slots(piece)):
        out[:, k] = np.where(slots >= 0, table[np.maximum(slots, 0)], 0)
    out[:, K - 2] = out[:, : K - 2].max(axis=1, initial=0)
    out[:, K - 1] = out[:, K - 2] >= STRONG
    return out


def _two(values: np.ndarray) -> np.ndarray:
    """Features speak for label 1 only: words x K x 2."""
    both = np.zeros((*values.shape, 2), values.dtype)
    both[:, :, 1] = values
    return both


def _tagged(texts: pa.Array, table: np.ndarray, field: crf.Crf) -> Iterator[tuple[Piece, np.ndarray]]:
    """Pieces of a column with their words' marginals of being toxic."""
    found = [(p, field.scores(_two(features(p, table)))) for p in pieces(texts, LETTERS) if len(p.start)]
    if not found:
        return
    doc = np.concatenate([p.doc for p, _ in found])
    begins = np.concatenate([[True], doc[1:] != doc[:-1]])
    each = crf.marginals(field, np.concatenate([s for _, s in found]), begins)[:, 1]
    at = 0
    for piece, _ in found:
        yield piece, each[at : at + len(piece.start)]
        at += len(piece.start)


def summary(texts: pa.Array, table: np.ndarray, field: crf.Crf) -> np.ndarray:
    """documents x 5: constant, largest marginal, sums of likely and of all marginals, length."""
    n = len(texts)
    top, likely, every, words = np.zeros((4, n))
    # Texts are tagged in slices: messages take many times the memory of the texts.
    for at, part in slices(texts, SLICE):
        for piece, each in _tagged(part, table, field):
            doc = piece.doc + at
            np.maximum.at(top, doc, each)
            likely += np.bincount(doc, np.where(each > 0.5, each, 0), n)
            every += np.bincount(doc, each, n)
            words += np.bincount(doc, minlength=n)
    return np.stack([np.ones(n), top, np.log1p(likely), np.log1p(every), np.log1p(words) / 10], axis=1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def judged(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = _logistic(x @ w)
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def _trained(table, field: crf.Crf, block: int = BLOCK):
    """(toxic, text) of a partition of the sample -> a row of field parameters for each block of
    at least ``block`` words, so that memory does not grow with the length of the texts."""

    def fitted(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        x, y, begins = (np.concatenate(part) for part in zip(*found))
        found.clear()
        parameters = crf.train(field, _two(x), y.astype(int), begins).flat()
        return pa.RecordBatch.from_arrays([pa.array([len(y)]), pa.array([parameters.tolist()])], ["n", "parameters"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for batch in batches:
            toxic = batch["toxic"].to_numpy().astype(bool)
            before = -1
            for piece in pieces(batch["text"], LETTERS):
                if len(piece.start):
                    values = features(piece, table.value)
                    begins = np.concatenate([[piece.doc[0] != before or not found], piece.doc[1:] != piece.doc[:-1]])
                    found.append((values, toxic[piece.doc] & (values[:, K - 1] > 0), begins))
                    before, n = piece.doc[-1], n + len(values)
                    if n >= block:
                        yield fitted(found)
                        n = 0
        if found:
            yield fitted(found)

    return run


def _calibrated(table, field: crf.Crf):
    """(toxic, text) of a partition of the sample -> one row of summary weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = [], []
        for batch in batches:
            x.append(summary(batch["text"], table.value, field))
            y.append(batch["toxic"].to_numpy().astype(float))
        n = sum(map(len, y))
        w = judged(np.concatenate(x), np.concatenate(y)) if n else np.zeros(5)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([w.tolist()])], ["n", "parameters"])

    return run


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, toxic, text) of the rows to learn from."""
    marked = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(crc_bucket(F.col("doc_id"), FOLDS) != HELD_OUT)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    texts = docs.filter(crc_bucket(F.col(key), FOLDS) != HELD_OUT).select(
        F.col(key).alias("doc_id"), F.col(text).alias("text")
    )
    # The same plan at every size: texts are dealt by id, labels are never sent whole.
    return texts.join(marked.hint("merge"), "doc_id").select("doc_id", "toxic", "text")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    spark = docs.sparkSession
    picked = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    rows = training_rows(docs, labels, text, key)
    found = rows.select("toxic", "text").mapInArrow(_counted, "slot int, n long, t long")
    summed = found.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()  # at most all slots
    n, t = np.zeros((2, int(PLACES[-1]) + 1))
    n[summed["slot"].to_numpy()], t[summed["slot"].to_numpy()] = summed["n"].to_numpy(), summed["t"].to_numpy()
    learnt = n[-1]
    if not n[:-1].any():
        return None
    share = min(0.99, max(0.01, t[-1] / learnt))
    table = spark.sparkContext.broadcast(evidence(n[:-1], t[:-1], share))
    limit = int(min(1.0, sample / learnt) * (1 << 30))
    part = training_rows(
        docs.withColumnRenamed(key, "doc_id").filter(picked < limit), labels.filter(picked < limit), text
    ).select("toxic", "text").repartition(PARTS)
    part = part.persist()
    field, schema = crf.Crf.blank(K, 2), "n long, parameters array<double>"
    for _ in range(ROUNDS):
        rows_ = part.mapInArrow(_trained(table, field), schema).collect()
        field = crf.mixed(field, [(r["n"], r["parameters"]) for r in rows_])
    fits = [r for r in part.mapInArrow(_calibrated(table, field), schema).collect() if r["n"]]
    part.unpersist()
    total = sum(r["n"] for r in fits)
    judge = sum(r["n"] * np.asarray(r["parameters"]) for r in fits) / total if total else np.array([-5.0, 0, 0, 0, 0])
    return Model(table.value, field, judge)


def score_column(spark: SparkSession, model: Model | None, text: Column) -> Column:
    """Score of a text column, 0 to 1."""
    if model is None:
        return F.lit(0.0)
    table = spark.sparkContext.broadcast(model.evidence)
    field, judge = model.field, model.judge

    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(_logistic(summary(column, table.value, field) @ judge))

    scores.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scores, "double")(text)


def score(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, text, key)
    return docs.select(
        F.col(key).alias("doc_id"),
        (crc_bucket(F.col(key), FOLDS) == HELD_OUT).alias("held_out"),
        score_column(docs.sparkSession, model, F.col(text)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def spans(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", least: float = 0.5) -> DataFrame:
    """Offending words: doc_id, start, end (code points, end exclusive), marginal."""
    table, field = docs.sparkSession.sparkContext.broadcast(model.evidence), model.field
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = flat(batch["text"])
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
            for piece, each in _tagged(batch["text"], table.value, field):
                at = np.flatnonzero(each >= least)
                doc = piece.doc[at]
                base = chars[places[doc]]
                start, end = chars[piece.start[at] + piece.offset] - base, chars[piece.end[at] + piece.offset] - base
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(doc)), pa.array(start), pa.array(end), pa.array(each[at])],
                    ["doc_id", "start", "end", "marginal"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, end long, marginal double")


def reject(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents whose score stays below the cut."""
    model = fit(docs, labels, text, key)
    return docs.filter(score_column(docs.sparkSession, model, F.col(text)) < CUT)
