"""Benchmark decontamination by latent semantic retrieval.

Texts and benchmark items are cut into passages of ``2 * STEP`` words, moved by ``STEP``.
Passages are TF-IDF vectors over the benchmark's words (document frequencies cover the whole
corpus); a randomised SVD of all item passages and all corpus passages, whose corpus part is a
distributed matrix product over every whole text, gives the latent space. The corpus weighs as
much as ``CORPUS_DOCS`` documents of average length, however many it has. Every passage of every
whole text is projected, and passages whose latent vector
has a cosine of at least ``least_cosine`` with an item passage are candidates. Words that the
benchmark does not have weigh nothing, so scores do not fall as the corpus grows. A candidate is
checked on the words around it: the longest common subsequence with the whole item must cover
``LCS`` of the item, and the item's answer (its ``answer`` column, or else its last quarter)
must be covered by ``ANSWER``; a paraphrase that covers ``NEARLY`` all of the item needs no
answer check. No candidate is capped.

The benchmark is the stated query set. It is read in blocks of about ``BLOCK_BYTES`` of text,
each block being one index that every task receives; the corpus never leaves its tasks. Null
and empty texts hit nothing, nor do items without words; repeated rows are searched one by
one, repeated items are hit together; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.words import LETTERS, Once, pieces, slices, word_column

STEP = 12
RANK, SPARE = 128, 10
SLACK = 0.5
LCS, ANSWER, NEARLY = 0.6, 0.5, 0.8
CORPUS_DOCS = 500
SUM_PARTS = 8
ITEM_WEIGHT = 16.0  # item passages weigh more, or the space would describe the corpus alone
BLOCK_BYTES = 1 << 20
SLOT_BITS = 16  # at least
ROWS = 4096  # passages compared with the items at a time
ITEMS, MARGIN = 256, 64  # items screened at a time, runs around a round that are read for it
COMMON = 8  # regions that have a word as often as the item, if it is not rare
BLOCK = 1024  # sums made at a time, so that they stay in a core's cache


@dataclass
class Vocabulary:
    """The benchmark's distinct word hashes, sorted, with the first word of each slot, which is a
    hash's first ``bits`` bits, and the most words that a slot has."""

    words: np.ndarray
    first: np.ndarray
    bits: int
    deepest: int

    @staticmethod
    def of(words: np.ndarray) -> Vocabulary:
        words = np.unique(words)
        bits = max(SLOT_BITS, (16 * len(words)).bit_length())
        slot, at, size = np.unique(words >> np.uint64(64 - bits), return_index=True, return_counts=True)
        first = np.zeros(1 << bits, np.int32)  # of an empty slot: any word, as it differs
        first[slot] = at
        return Vocabulary(words, first, bits, int(size.max(initial=0)))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Column of each word, -1 for words the benchmark does not have."""
        if not len(self.words):
            return np.full(len(hashes), -1, np.int32)
        place = self.first[(hashes >> np.uint64(64 - self.bits)).view(np.int64)]
        out = np.where(self.words[place] == hashes, place, np.int32(-1))
        for k in range(1, self.deepest):
            at = np.flatnonzero(out < 0)
            other = np.minimum(place[at] + k, len(self.words) - 1)
            same = self.words[other] == hashes[at]
            out[at[same]] = other[same]
        return out


def segments(doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins of runs of STEP words within each text, and each run's text."""
    first = np.searchsorted(doc, np.arange(n + 1))
    runs = -(-np.diff(first) // STEP)
    owner = np.repeat(np.arange(n), runs)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    return first[owner] + STEP * within, owner


def run_sums(number: np.ndarray, begin: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Sum of the word vectors of each run; unknown words (-1) add nothing."""
    known = number >= 0
    first = np.append(0, np.cumsum(known))[np.append(begin, len(number))]
    return group_sums(number[known].astype(np.int64), first[:-1], np.diff(first), vectors)


def group_sums(picked: np.ndarray, first: np.ndarray, size: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of ``rows[picked]`` over groups of ``size`` from ``first``, at most STEP each.

    Rows are added one place at a time for all groups of a block. Larger groups come first, so
    those that have a place are neighbours and need not be gathered.
    """
    order = np.argsort(STEP - size.astype(np.int8), kind="stable")
    first, size = first[order], size[order]
    out = np.empty((len(order), rows.shape[1]), rows.dtype)
    sums, row = (np.empty((min(len(order), BLOCK), rows.shape[1]), rows.dtype) for _ in range(2))
    for low in range(0, len(order), BLOCK):
        at, held = first[low : low + BLOCK], size[low : low + BLOCK]
        sums[:] = 0
        for k in range(held[0]):
            n = np.searchsorted(-held, -k)  # groups of more than k rows
            np.take(rows, picked[at[:n] + k], axis=0, out=row[:n], mode="clip")
            sums[:n] += row[:n]
        out[order[low : low + BLOCK]] = sums[: len(at)]
    return out


def passages(runs: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over passages from sums over runs, and the run each passage starts with.

    A passage is two neighbouring runs of a text; a text of one run is one passage.
    """
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    alone = np.ones(len(runs), bool)
    alone[pair], alone[pair + 1] = False, False
    single = np.flatnonzero(alone)
    sums = (runs[:-1] + runs[1:])[pair]
    if not len(single):
        return sums, pair
    return np.concatenate([sums, runs[single]]), np.concatenate([pair, single])


@dataclass
class Index:
    """A benchmark block: item numbers and words, item passages in latent space."""

    ids: list
    items: list[np.ndarray]  # word hashes
    numbers: list[np.ndarray]  # their distinct words' numbers in the vocabulary
    answers: list[np.ndarray]
    pairs: np.ndarray  # item, distinct word of it and how often it has it, in three rows
    vocabulary: Vocabulary
    weights: np.ndarray  # idf of each word of the vocabulary, and 0 for all other words
    vectors: np.ndarray  # words x RANK, with their idf weights, and a row for all other words
    latent: np.ndarray  # item passages x RANK, scaled so that an equal passage scores 1
    owner: np.ndarray  # item of each item passage
    offset: np.ndarray  # word of the item at which it begins
    least: np.ndarray  # cosine that makes a candidate


def _counted(vocabulary):
    """(text) -> (word, n): documents having the word, and under -1 all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        n, rows = np.zeros(len(known.words), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            once = Once(len(n))
            for piece in pieces(batch["text"], LETTERS):
                number = known.numbers(piece.word_hashes())
                at = np.flatnonzero(number >= 0)
                _, word = once.fresh(piece.doc[at], number[at])
                n += np.bincount(word, minlength=len(n))
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(n[seen], rows))], ["word", "n"]
        )

    return run


def rounds(begin: np.ndarray, owner: np.ndarray, words: int) -> Iterator[tuple]:
    """Runs of a column in rounds of ROWS: (first run, first and end word, begins, texts)."""
    for low in range(0, len(begin), ROWS):
        # One run more, so that the last passage is whole; and it starts the next round.
        high = min(len(begin), low + ROWS + 1)
        a, b = begin[low], begin[high] if high < len(begin) else words
        yield low, a, b, begin[low:high] - a, owner[low:high]


def fresh(at: np.ndarray, low: int, own: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which passages of a round, by their first runs, belong to it and not to its neighbours.

    The first run alone is none if it only ends the text of the round before, nor is the one
    run more.
    """
    out = at < ROWS
    if low and own[0] == owner[low - 1] and not (len(own) > 1 and own[1] == own[0]):
        out &= at > 0
    return out


def _add_product(texts: pa.Array, known: Vocabulary, squares: np.ndarray, vectors: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out`` the column's share of A'A: A's rows are the passages' TF-IDF vectors of
    length 1, ``vectors`` are the weighted rows of the right side, with a last row of zeros, and
    ``out`` lacks the weights of its rows. Each run's words are gathered and scattered once."""
    hashes, doc = word_column(texts, LETTERS)
    numbers = known.numbers(hashes)
    begin, owner = segments(doc, len(texts))
    for low, a, b, runs, own in rounds(begin, owner, len(doc)):
        number = numbers[a:b]
        sums, at = passages(run_sums(number, runs, vectors), own)
        mass, _ = passages(np.add.reduceat(squares[number], runs), own)
        mine = np.flatnonzero(fresh(at, low, own, owner) & (mass > 0))
        part, at = sums[mine] / mass[mine, None], at[mine]
        back = np.zeros((len(runs), vectors.shape[1]), np.float32)
        back[at] = part
        two = np.flatnonzero(own[np.minimum(at + 1, len(own) - 1)] == own[at])
        two = two[at[two] + 1 < len(own)]
        back[at[two] + 1] += part[two]
        has = np.flatnonzero(number >= 0)
        if not len(has):
            continue
        word, run = number[has], np.repeat(np.arange(len(runs)), np.diff(np.append(runs, b - a)))[has]
        # Sixteen bits are sorted by radix.
        order = np.argsort(word.astype(np.uint16) if len(out) < 1 << 16 else word, kind="stable")
        _scatter(word[order], run[order], back, out)


def _scatter(word: np.ndarray, run: np.ndarray, back: np.ndarray, out: np.ndarray) -> None:
    """Add ``back[run]`` to ``out[word]``; words are sorted. Neighbours of a word are first added
    up STEP at a time, one place for all groups, as that is faster than one sum after another."""
    new = np.concatenate([[True], word[1:] != word[:-1]])
    within = np.arange(len(word)) - np.maximum.accumulate(np.where(new, np.arange(len(word)), 0))
    group = np.flatnonzero(within % STEP == 0)
    sums = group_sums(run, group, np.diff(np.append(group, len(word))), back)
    first = np.flatnonzero(new[group])
    out[word[group[first]]] += np.add.reduceat(sums, first, axis=0)


def _sparse_rows(out: np.ndarray, used: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows ``used`` of a matrix as (word, values)."""
    for low in range(0, len(used), ROWS):
        word = used[low : low + ROWS]
        flat = pa.array(out[word].ravel())
        ends = pa.array(np.arange(len(word) + 1) * out.shape[1], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.int32()), pa.ListArray.from_arrays(ends, flat)], ["word", "values"])


def _products(vocabulary, squares, vectors):
    """(text) -> (word, values): the task's share of the corpus product."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = vectors.value
        out = np.zeros((len(right) - 1, right.shape[1]))
        for batch in batches:
            for _, part in slices(batch["text"]):
                _add_product(part, vocabulary.value, squares.value, right, out)
        yield from _sparse_rows(out, np.flatnonzero(out.any(axis=1)))

    return run


def _added(words: int, width: int):
    """(word, values) -> (word, values): sums over equal words of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((words, width))
        for batch in batches:
            np.add.at(out, batch["word"].to_numpy(), batch["values"].flatten().to_numpy().reshape(-1, width))
        yield from _sparse_rows(out, np.flatnonzero(out.any(axis=1)))

    return run


def latent_basis(texts: DataFrame, items: pa.Array, vocabulary, weights: np.ndarray, share: float) -> np.ndarray:
    """Right singular vectors (words x rank) of the TF-IDF passages of all items and, weighing
    ``share``, of all texts: power steps over the items give a probe, one product with the whole
    matrix its image, and the Nystroem approximation the singular vectors."""
    spark, words = texts.sparkSession, len(weights)
    width = min(words, RANK + SPARE)
    squares = np.append(weights**2, 0)
    random = np.random.default_rng(13).standard_normal((words, width))

    def sided(right: np.ndarray) -> np.ndarray:
        return np.concatenate([right * weights[:, None], np.zeros((1, width))]).astype(np.float32)

    def of_items(right: np.ndarray) -> np.ndarray:
        out = np.zeros((words, width))
        _add_product(items, vocabulary.value, squares, sided(right), out)
        return ITEM_WEIGHT**2 * out * weights[:, None]

    probe = random
    for _ in range(2):
        probe, _ = np.linalg.qr(of_items(probe))
    values, turn = np.linalg.eigh(probe.T @ of_items(probe))
    held = probe @ turn[:, values > 1e-6 * values.max()]
    # Fewer item passages than the probe is wide leave room for directions of the corpus alone.
    probe, _ = np.linalg.qr(np.concatenate([held, random[:, held.shape[1] :]], axis=1))
    context = spark.sparkContext
    task = _products(vocabulary, context.broadcast(squares), context.broadcast(sided(probe)))
    schema = "word int, values array<double>"
    summed = texts.mapInArrow(task, schema).repartition(SUM_PARTS, "word").mapInArrow(_added(words, width), schema)
    rows = summed.toArrow()
    image = of_items(probe)
    if len(rows):
        word, values = rows["word"].to_numpy(), rows["values"].combine_chunks().flatten().to_numpy()
        image[word] += share * values.reshape(-1, width) * weights[word, None]
    values, turn = np.linalg.eigh(probe.T @ image)
    turn = turn[:, kept := values > 1e-6 * values.max()] / np.sqrt(values[kept])
    return np.linalg.svd(image @ turn, full_matrices=False)[0][:, :RANK]


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[pa.Table]:
    columns = [F.col(item).alias("item_id"), F.col(text).alias("text")]
    if "answer" in benchmark.columns:
        columns.append(F.col("answer").cast("string").alias("answer"))
    rows = benchmark.select(*columns).filter(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / BLOCK_BYTES))
    for block in range(count if size else 0):
        yield rows.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == block).toArrow()


def build(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> list[Index]:
    """One index per block of the benchmark."""
    spark, out = docs.sparkSession, []
    texts = docs.select(F.col(text).alias("text")).filter(F.col("text").isNotNull())
    for block in _blocks(benchmark, item, "text"):
        hashes, doc = word_column(block["text"].combine_chunks(), LETTERS)
        if not len(hashes):
            continue
        known = Vocabulary.of(hashes)
        shared = spark.sparkContext.broadcast(known)
        counts = texts.mapInArrow(_counted(shared), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
        n = dict(zip(counts["word"].to_pylist(), counts["n"].to_pylist()))
        rows = n.pop(-1, 0)
        frequency = np.zeros(len(known.words))
        for word, times in n.items():
            frequency[word] = times
        weights = np.log((rows + 2) / (frequency + 1))
        share = min(1.0, CORPUS_DOCS / max(1, rows))
        basis = latent_basis(texts, block["text"].combine_chunks(), shared, weights, share)
        vectors = (basis * weights[:, None]).astype(np.float32)
        vectors = np.concatenate([vectors, np.zeros((1, vectors.shape[1]), np.float32)])
        begin, owner = segments(doc, block.num_rows)
        number = known.numbers(hashes)
        sums, at = passages(run_sums(number, begin, vectors), owner)
        mass, _ = passages(np.add.reduceat((weights**2)[number], begin), owner)
        size, _ = passages(np.diff(np.append(begin, len(doc))), owner)
        first = np.searchsorted(doc, np.arange(block.num_rows))
        captured = (sums**2).sum(axis=1)
        mass = np.maximum(mass, captured)
        good = np.flatnonzero(captured > 0)
        latent = (sums * (np.sqrt(mass) / np.maximum(captured, 1e-12))[:, None])[good]
        words = [hashes[a:b] for a, b in zip(first, np.append(first[1:], len(doc)))]
        given = block["answer"].to_pylist() if "answer" in block.column_names else [None] * block.num_rows
        answers = [
            word_column(pa.array([a]), LETTERS)[0] if a else w[-max(1, len(w) // 4) :] for a, w in zip(given, words)
        ]
        pairs, times = np.unique(np.stack([doc, number]), axis=1, return_counts=True)
        out.append(
            Index(
                block["item_id"].to_pylist(), words, [np.unique(known.numbers(w)) for w in words], answers,
                np.concatenate([pairs, times[None]]), known,
                np.append(weights, 0).astype(np.float32), vectors, latent.astype(np.float32), owner[at[good]],
                begin[at[good]] - first[owner[at[good]]], least_cosine(size[good]),
            )
        )
    return out


def least_cosine(words: np.ndarray) -> np.ndarray:
    """Cosine that makes a candidate, for item passages of so many words.

    Of such a passage some text passage holds ``words``, or half of ``words + STEP`` if that is
    less, wherever the text's runs begin; ``LCS`` of these are the item's. With words of equal
    weight, none of the others being shared, the cosine is at least that; ``SLACK`` of it leaves
    room for unequal weights and for what the latent space loses.
    """
    shared = LCS * np.minimum(words, (words + STEP) / 2)
    return (SLACK * shared / np.sqrt(2 * STEP * words)).astype(np.float32)


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel steps over ``b``."""
    where: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        where[w] = where.get(w, 0) | (1 << i)
    row, mask = (1 << len(a)) - 1, (1 << len(a)) - 1
    for w in b.tolist():
        hit = where.get(w)
        if hit:
            shared = row & hit
            row = ((row + shared) | (row - shared)) & mask
    return len(a) - row.bit_count()


def search(texts: pa.Array, index: Index) -> list[tuple[int, int, float, float, float]]:
    """Confirmed hits in a column: (text number, item number, cosine, item and answer share)."""
    kept_words, kept_docs = [], []
    for piece in pieces(texts, LETTERS):
        kept_words.append(piece.word_hashes())
        kept_docs.append(piece.doc)
    if not kept_docs:
        return []
    hashes, doc = np.concatenate(kept_words), np.concatenate(kept_docs)
    begin, owner = segments(doc, len(texts))
    if not len(begin):
        return []
    numbers = index.vocabulary.numbers(hashes)
    screen = Screen(index, numbers, begin)
    spots: list[tuple[np.ndarray, ...]] = []  # run, item passage, cosine
    for low, a, b, runs, own in rounds(begin, owner, len(doc)):
        number = numbers[a:b]
        sums, at = passages(run_sums(number, runs, index.vectors), own)
        mass, _ = passages(np.add.reduceat(index.weights[number] ** 2, runs), own)
        mine = fresh(at, low, own, owner)
        sums, mass, at = sums[mine], mass[mine], at[mine]
        # Squared idf summed over words is short of a repeated word's share, but never of all.
        mass = np.maximum(mass, (sums**2).sum(axis=1))
        cosine = (sums / np.sqrt(np.maximum(mass, 1e-12))[:, None]) @ index.latent.T
        near = np.flatnonzero(cosine >= index.least)
        r, p = np.divmod(near, len(index.least))
        run = low + at[r]
        held = np.flatnonzero(screen.passed(low, run, p))
        spots.append((run[held], p[held], cosine.ravel()[near[held]]))
    run, p, cosine = (np.concatenate(x) for x in zip(*spots))
    if not len(run):
        return []
    item, text, place = index.owner[p], owner[run], begin[run] - index.offset[p]
    # Passages of a text that point to the same place of the item are one candidate.
    key = (item * len(texts) + text) * (int(place.max() - place.min()) + 1) + place - place.min()
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) > 0]))
    once, cosine = order[new], np.maximum.reduceat(cosine[order], new)
    item, text, place = item[once], text[once], place[once]
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    borders = np.flatnonzero(np.concatenate([[True], np.diff(item) > 0, [True]]))
    out, views = [], {}
    for k, to in zip(borders[:-1], borders[1:]):
        each = int(item[k])
        words, answer = index.items[each], index.answers[each]
        begins = np.maximum(first[text[k:to]], place[k:to] - 2 * STEP)
        ends = np.minimum(first[text[k:to] + 1], place[k:to] + len(words) + 2 * STEP)
        left = _enough(numbers, begins, len(words), index.numbers[each], len(index.weights), views)
        confirmed: set[int] = set()
        for at in left[np.argsort(-cosine[k + left], kind="stable")].tolist():
            if (whose := int(text[k + at])) in confirmed:
                continue
            region = hashes[begins[at] : ends[at]]
            share = common_words(words, region) / len(words)
            if share < LCS:
                continue
            answered = common_words(answer, region) / max(1, len(answer))
            if share >= NEARLY or answered >= ANSWER:
                out.append((whose, each, float(cosine[k + at]), share, answered))
                confirmed.add(whose)
    return out


class Screen:
    """Whether candidates have enough of the item's rare words in the runs that their regions touch.

    A common subsequence has no word more often than the item has it. All of the item's common
    words may be in it, so the rest of it must be rare ones, whichever words are held for common:
    here those that a few regions of these texts have as often. Regions longer than MARGIN runs
    need none.
    """

    def __init__(self, index: Index, numbers: np.ndarray, begin: np.ndarray):
        self.index, self.numbers, self.begin = index, numbers, begin
        item, word, times = index.pairs
        size = np.array([len(w) for w in index.items])
        frequency = np.bincount(numbers[numbers >= 0], minlength=len(index.weights)) / max(1, len(numbers))
        common = COMMON * frequency[word] * (size + 4 * STEP)[item] >= times
        self.item, self.word = item[~common], word[~common]
        need = np.ceil(LCS * size - 1e-6 - np.bincount(item[common], times[common], len(size)))
        width = -(-size // STEP) + 4  # runs of a region: the item's, and two on each side
        near = width <= MARGIN
        self.width = np.where(near, width, 0)
        self.need = np.where(near, need, 0).astype(np.int16)[index.owner]
        self.before = np.where(near[index.owner], index.offset // STEP + 2, 0)

    def passed(self, low: int, run: np.ndarray, p: np.ndarray) -> np.ndarray:
        """For candidates (run of a text, item passage) of the round that begins with run ``low``."""
        out, owner = np.zeros(len(run), bool), self.index.owner
        a, z = max(0, low - MARGIN), min(len(self.begin), low + ROWS + MARGIN)
        number = self.numbers[self.begin[a] : self.begin[z] if z < len(self.begin) else len(self.numbers)]
        first = run - a + MARGIN - self.before[p]
        for start in range(0, len(self.width), ITEMS):
            width = self.width[start : start + ITEMS]
            column = np.empty(len(width), np.int64)  # the widest come first
            column[np.argsort(-width, kind="stable")] = np.arange(len(width))
            mine = slice(*np.searchsorted(self.item, [start, start + ITEMS]))
            member = np.zeros((len(self.index.weights), len(width)), np.uint8)
            member[self.word[mine], column[self.item[mine] - start]] = 1
            used = np.zeros(len(member), bool)  # its last place is that of unknown words
            used[self.word[mine]] = True
            counts = run_sums(np.where(used[number], number, -1), self.begin[a:z] - self.begin[a], member)
            total = np.zeros((MARGIN + len(counts), len(width)), np.int16)  # by a region's first run
            for k in range(width.max()):
                wide = np.count_nonzero(width > k)
                total[MARGIN - k : MARGIN - k + len(counts), :wide] += counts[:, :wide]
            here = (owner >= start) & (owner < start + ITEMS)
            at = slice(None) if here.all() else np.flatnonzero(here[p])
            out[at] = total[first[at], column[owner[p[at]] - start]] >= self.need[p[at]]
        return out


def _enough(numbers: np.ndarray, begins: np.ndarray, words: int, distinct: np.ndarray, size: int, views: dict) -> np.ndarray:
    """Which regions hold enough of an item's words for a common subsequence of the wanted
    length, by places and then by distinct words; a text's last regions are read beyond its end.
    ``views`` keeps the words' windows by width."""
    n, most = len(distinct), (1 - LCS) * words + 1e-9
    place = np.full(size, n, np.uint8 if n < 256 else np.int32)  # n for words the item does not have
    place[distinct] = np.arange(n)
    width = min(words + 4 * STEP, len(numbers))
    if width not in views:
        views[width] = np.lib.stride_tricks.sliding_window_view(numbers, width)
    rows = views[width]
    chunk = max(1, (1 << 19) // (width + n))
    left = []
    for low in range(0, len(begins), chunk):
        held = place[rows[np.minimum(begins[low : low + chunk], len(rows) - 1)]]
        some = np.flatnonzero(np.count_nonzero(held < n, axis=1) >= words - most)
        seen = np.zeros((len(some), n + 1), bool)
        seen[np.arange(len(some))[:, None], held[some]] = True
        left.append(low + some[np.count_nonzero(seen[:, :n], axis=1) >= n - most])
    return np.concatenate(left)


HITS = ["doc_id", "item_id", "cosine", "lcs_share", "answer_share"]


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Confirmed leaks: doc_id, item_id, cosine, lcs_share, answer_share; one row per pair."""
    spark = docs.sparkSession
    kind, item = (x.simpleString() for x in (docs.schema[key].dataType, benchmark.schema["item_id"].dataType))
    schema = f"doc_id {kind}, item_id {item}, cosine double, lcs_share double, answer_share double"
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    out = spark.createDataFrame([], schema)
    for index in build(docs, benchmark, text):
        out = out.unionByName(rows.mapInArrow(_hits(spark.sparkContext.broadcast(index)), schema))
    return out


def _hits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, column in slices(batch["text"]):
                found = search(column, shared.value)
                if found:
                    doc, number, *figures = (list(c) for c in zip(*found))
                    ids = pa.array([shared.value.ids[i] for i in number])
                    whose = batch["doc_id"].slice(at).take(pa.array(doc))
                    yield pa.RecordBatch.from_arrays([whose, ids, *map(pa.array, figures)], HITS)

    return run


def leaked(spark: SparkSession, indexes: list[Index], text: Column) -> Column:
    """Whether a text column holds any item."""
    out = F.lit(False)
    for index in indexes:
        out = out | F.arrow_udf(_flags(spark.sparkContext.broadcast(index)), "boolean")(text)
    return out


def _flags(shared):
    def flags(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            hit = np.zeros(len(column), bool)
            for at, part in slices(column):
                for found in search(part, shared.value):
                    hit[at + found[0]] = True
            yield pa.array(hit)

    flags.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return flags


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no benchmark item."""
    indexes = build(docs, benchmark, text)
    return docs.filter(~leaked(docs.sparkSession, indexes, F.col(text)))
