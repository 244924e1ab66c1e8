"""Language identification of code-switched text by a linear-chain conditional random field.

Every word gets a distribution over languages by forward-backward; a document's language is
the one with the largest mean over its words, which is also its score. A word's features are
log-likelihoods per language of its whole form (lexicon), its first and last three bytes
(affixes) and its byte trigrams (n-grams), each from hashed counts over all training rows.
The field's weights and transitions are learned on a sample of about ``SAMPLE`` training rows,
spliced into one run so that language changes occur.

``words`` labels code-switched text: runs of words of one language, with their places.

Training rows have a language and crc32(id as text) mod 5 other than 0. Null texts and texts
without a letter are ``und`` with score 0; so is everything if there is no training row.
Repeated rows are predicted alike, one by one; extra columns are ignored; of languages that are
equally likely the first by name is taken; an empty table gives an empty result; a very long
text is read in pieces, and its words go through the field as one sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import crf
from touchline.llm.common import crc_bucket
from touchline.llm.words import LETTERS, Piece, flat, pieces

FOLDS, HELD_OUT = 5, 0
SAMPLE = 2000
PARTS, ROUNDS = 4, 2
UNKNOWN = "und"
# Hash bits of each feature's table: word, first bytes, last bytes, trigrams.
BITS = (16, 13, 13, 14)
PLACES = np.concatenate([[0], np.cumsum([1 << b for b in BITS])])
AFFIX = 3
SMOOTHING = 0.5


def _slots(piece: Piece) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Table slots of each word's word and affix features; slots of the piece's trigrams and
    which of them lie inside one word."""
    start, end = piece.start, piece.end
    spans = [(start, end), (start, np.minimum(start + AFFIX, end)), (np.maximum(end - AFFIX, start), end)]
    words = [
        (piece.hashes(a, b) >> np.uint64(64 - bits)).astype(np.int64) + place
        for (a, b), bits, place in zip(spans, BITS, PLACES)
    ]
    code = piece.code.astype(np.int64)
    if len(code) < 3:
        return words, np.zeros(0, np.int64), np.zeros(0, bool)
    a, b, c = code[:-2], code[1:-1], code[2:]
    grams = (((a * 31 + b) * 31 + c) * 40503 & 0xFFFFFF) >> (24 - BITS[3])
    crosses = np.zeros(len(code) + 1, bool)
    crosses[start] = True  # a word begins: the trigram must not run into it from the left
    whole = (a > 0) & (b > 0) & (c > 0) & ~crosses[1 : len(b) + 1] & ~crosses[2 : len(c) + 2]
    return words, grams + PLACES[3], whole


def _counted(labels: dict[str, int]):
    """(lang, text) -> (slot, label, n) of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, width = np.zeros(int(PLACES[-1]) * len(labels), np.int64), len(labels)
        for batch in batches:
            own = np.array([labels[x] for x in batch["lang"].to_pylist()], np.int64)
            for piece in pieces(batch["text"], LETTERS):
                if not len(piece.start):
                    continue
                words, grams, whole = _slots(piece)
                label = own[piece.doc]
                for slots in words:
                    total += np.bincount(slots * width + label, minlength=len(total))
                at = np.flatnonzero(whole)
                word = np.searchsorted(piece.start, at, "right") - 1
                total += np.bincount(grams[at] * width + label[word], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array((seen // width).astype(np.int32)), pa.array((seen % width).astype(np.int32)), pa.array(total[seen])],
            ["slot", "label", "n"],
        )

    return run


def lexicon(counts: np.ndarray) -> np.ndarray:
    """Counts (slots x labels) -> centred log-likelihoods; an unseen slot is neutral."""
    out = np.zeros(counts.shape, np.float32)
    for a, b in zip(PLACES[:-1], PLACES[1:]):
        part = counts[a:b].astype(float)
        share = np.maximum(part.sum(0), 1)
        smooth = SMOOTHING * share / share.mean()
        logs = np.log((part + smooth) / share)
        out[a:b] = logs - logs.mean(axis=1, keepdims=True)
    return out


def features(piece: Piece, table: np.ndarray) -> np.ndarray:
    """words x 4 x labels."""
    words, grams, whole = _slots(piece)
    out = np.empty((len(piece.start), 4, table.shape[1]), np.float32)
    for k, slots in enumerate(words):
        out[:, k] = table[slots]
    sums = np.zeros((len(piece.code) + 1, table.shape[1]), np.float64)
    seen = np.zeros(len(piece.code) + 1)
    if len(grams):
        np.cumsum(table[grams] * whole[:, None], axis=0, out=sums[1 : len(grams) + 1])
        np.cumsum(whole, out=seen[1 : len(grams) + 1])
        sums[len(grams) + 1 :], seen[len(grams) + 1 :] = sums[len(grams)], seen[len(grams)]
    n = seen[piece.end] - seen[piece.start]
    out[:, 3] = (sums[piece.end] - sums[piece.start]) / np.maximum(n, 1)[:, None]
    return out


def _trained(table, model: crf.Crf, labels: dict[str, int]):
    """(lang, text) of a partition of the sample -> one row of parameters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, gold = [], []
        for batch in batches:
            own = np.array([labels[x] for x in batch["lang"].to_pylist()], np.int64)
            for piece in pieces(batch["text"], LETTERS):
                if len(piece.start):
                    found.append(features(piece, table.value))
                    gold.append(own[piece.doc])
        n, values = 0, model.flat()
        if found:
            x, y = np.concatenate(found).astype(float), np.concatenate(gold)
            begins = np.zeros(len(y), bool)
            begins[0] = True
            n, values = len(y), crf.train(model, x, y, begins).flat()
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([values.tolist()])], ["n", "parameters"])

    return run


def _predicted(table, model: crf.Crf, names: list[str]):
    """(doc_id, held_out, letters, text) -> (doc_id, held_out, lang_pred, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, words = np.zeros((batch.num_rows, max(len(names), 1))), np.zeros(batch.num_rows)
            scores, docs = [], []
            for piece in pieces(batch["text"], LETTERS):
                if len(piece.start):
                    scores.append(model.scores(features(piece, table.value)))
                    docs.append(piece.doc)
            if docs:
                doc = np.concatenate(docs)
                begins = np.concatenate([[True], doc[1:] != doc[:-1]])
                each = crf.marginals(model, np.concatenate(scores), begins)
                words = np.bincount(doc, minlength=batch.num_rows)
                for label in range(len(names)):
                    total[:, label] = np.bincount(doc, each[:, label], batch.num_rows)
            mean = total / np.maximum(words, 1)[:, None]
            known = batch["letters"].to_numpy(zero_copy_only=False).astype(bool) & (words > 0) & bool(names)
            best = mean.argmax(axis=1)
            language = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
            score = np.where(known, mean[np.arange(len(best)), best], 0.0).clip(0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(language, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def fit(rows: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, crf.Crf, list[str]]:
    """(doc_id, lang, text) training rows -> likelihood table, field, languages."""
    per_language = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    names = sorted(per_language)
    labels = {name: i for i, name in enumerate(names)}
    counts = np.zeros((int(PLACES[-1]), max(len(names), 1)), np.int64)
    model = crf.Crf.blank(len(BITS), max(len(names), 1))
    if not names:
        return lexicon(counts), model, names
    spark = rows.sparkSession
    found = rows.select("lang", "text").mapInArrow(_counted(labels), "slot int, label int, n long")
    summed = found.groupBy("slot", "label").agg(F.sum("n").alias("n")).toArrow()  # at most slots x labels rows
    counts[summed["slot"].to_numpy(), summed["label"].to_numpy()] = summed["n"].to_numpy()
    table = spark.sparkContext.broadcast(lexicon(counts))
    keep = min(1.0, sample / max(1, sum(per_language.values())))
    picked = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < int(keep * (1 << 30))
    part = rows.filter(picked).select("lang", "text").repartition(PARTS)
    for _ in range(ROUNDS):
        trained = part.mapInArrow(_trained(table, model, labels), "n long, parameters array<double>").collect()
        model = crf.mixed(model, [(r["n"], r["parameters"]) for r in trained])
    return table.value, model, names


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    fold = crc_bucket(F.col(key), FOLDS)
    rows = docs.filter((fold != HELD_OUT) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    table, model, names = fit(rows)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    seen = docs.select(
        F.col(key).alias("doc_id"),
        (fold == HELD_OUT).alias("held_out"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        F.col(text).alias("text"),
    )
    kind = seen.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    return seen.mapInArrow(_predicted(shared, model, names), schema)


def words(
    docs: DataFrame, model: tuple[np.ndarray, crf.Crf, list[str]], text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Runs of neighbouring words of one language: doc_id, start, end (code points, end exclusive),
    lang, n_words and marginal, the mean over the run's words.

    ``model`` is what ``fit`` gives. The words' distributions are those whose mean ``identify``
    takes. Texts without a letter have no run, nor has any text if no language was learned.
    """
    table, field, names = docs.sparkSession.sparkContext.broadcast(model[0]), model[1], model[2]
    lettered = F.when(F.col(text).rlike(r"\p{L}"), F.col(text))
    rows = docs.select(F.col(key).alias("doc_id"), lettered.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for piece in pieces(batch["text"], LETTERS) if names else ():
                if len(piece.start):
                    scores = field.scores(features(piece, table.value))
                    found.append((piece.doc, piece.start + piece.offset, piece.end + piece.offset, scores))
            if not found:
                continue
            doc, start, end, scores = (np.concatenate(x) for x in zip(*found))
            each = crf.marginals(field, scores, np.concatenate([[True], doc[1:] != doc[:-1]]))
            best = each.argmax(axis=1)
            fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (best[1:] != best[:-1])])
            first = np.flatnonzero(fresh)
            last = np.append(first[1:], len(doc)) - 1
            n = last - first + 1
            data, places = flat(batch["text"])
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
            base = chars[places[doc[first]]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(doc[first])),
                    pa.array(chars[start[first]] - base),
                    pa.array(chars[end[last]] - base),
                    pa.array([names[b] for b in best[first]], pa.string()),
                    pa.array(n),
                    pa.array(np.add.reduceat(each[np.arange(len(best)), best], first) / n),
                ],
                ["doc_id", "start", "end", "lang", "n_words", "marginal"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, end long, lang string, n_words long, marginal double")
