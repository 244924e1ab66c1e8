"""Token counts of whole texts by a public tokenizer, in Arrow functions returning lengths.

Texts are cut at places where no token can span (a space that is not beside other white
space, which starts a new word for a byte-level tokenizer). Each task keeps the counts of up to
``HELD`` short words, so that the library encodes a word again only if they overflow; what is
new is encoded in batches of about equal bytes, so that neither one long text nor a row count
decides a batch's memory.
Null and empty texts have 0 tokens; repeated rows are counted one by one. The vocabulary file
is a parameter and is opened on each worker by its installed package; it is never copied.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.json"
PART_CHARS = 1 << 16
BATCH_BYTES = 1 << 18
LIMIT = 512
HELD, HELD_CHARS = 1 << 18, 64  # words whose counts a task keeps, and their longest length
_SAFE = re.compile(r"(?<=[^\W_]) (?=[^\W_])")
_WIDE = re.compile(r"\s\s")
_ALONE = re.compile(r" (?<!\s )(?!\s)")


def split(text: str) -> list[str]:
    """A text cut at spaces, which are left out, that are not beside other white space."""
    return text.split(" ") if _WIDE.search(text) is None else _ALONE.split(text)


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Consecutive parts of a text, cut at safe boundaries at least ``size`` characters apart."""
    at = 0
    while len(text) - at > size:
        found = _SAFE.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def batches(texts: list[str], size: int = BATCH_BYTES) -> Iterator[tuple[list[int], list[str]]]:
    """Parts with their text's number, grouped up to about ``size`` bytes."""
    owners, group, held = [], [], 0
    for i, text in enumerate(texts):
        for part in parts(text):
            owners.append(i)
            group.append(part)
            held += len(part.encode())
            if held >= size:
                yield owners, group
                owners, group, held = [], [], 0
    if group:
        yield owners, group


class Words(dict):
    """Token counts of short words that came more than once, each with the space before it.

    ``encoded`` has the library count texts. Words that were not seen before are counted
    together, as single words cost the library more than their share of a text.
    """

    def __init__(self, encoded):
        super().__init__()
        self.encoded, self.once = encoded, set()

    def others(self, words: list[str]) -> tuple[int, list[str]]:
        """Tokens of the words held or now held, and all other words."""
        new = [w for w in words if w not in self]
        again = list(self.once.intersection(new))
        if again:
            if len(self) + len(again) > HELD:
                self.clear()
            self.update(zip(again, self.encoded([" " + w for w in again]).tolist()))
            self.once.difference_update(again)
        left = [w for w in words if w not in self] if again else new
        if len(self.once) > HELD:
            self.once.clear()
        self.once.update(w for w in left if len(w) <= HELD_CHARS)
        return sum(self[w] for w in words if w in self), left

    def counts(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        owners, whole = [], []
        for i, text in enumerate(texts):
            for part in parts(text):
                head, *rest = split(part)
                try:
                    out[i] += sum(map(self.__getitem__, rest))
                except KeyError:
                    n, left = self.others(rest)
                    out[i] += n
                    head = " ".join([head, *left])
                owners.append(i)
                whole.append(head)
        np.add.at(out, owners, self.encoded(whole))
        return out


def token_counts(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text column, special tokens inside texts handled as the library does."""

    def lengths(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def encoded(texts: list[str]) -> np.ndarray:
            counts = np.zeros(len(texts), np.int64)
            for owners, group in batches(texts):
                found = tokenizer.encode_batch_fast(group, add_special_tokens=False)
                np.add.at(counts, owners, [len(e) for e in found])
            return counts

        words = Words(encoded)
        for column in columns:
            yield pa.array(words.counts(column.fill_null("").to_pylist()))

    lengths.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(lengths, "long")(text)


def count(docs: DataFrame, text: str = "text", key: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    return docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        token_counts(F.col(text)).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
