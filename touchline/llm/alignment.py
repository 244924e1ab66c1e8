"""Cross-tokenizer alignment of whole texts by merge-path partitioning.

Each text, with a space before it, is encoded by a byte-level tokenizer (A) and by a piece
tokenizer that adds that space itself (B). Both give a rising sequence of byte offsets at which
tokens end. All texts of a batch are laid end to end, so that their ends form two long sorted
sequences; the path by which these merge is cut on equally spaced diagonals, each found by a
binary search. A piece between two cuts holds the same number of ends whether it lies inside
one long text or covers many short ones. It reports the offsets that both sequences have. A
cut can part the two ends of one offset; such borders are stitched afterwards, and the offsets
then bound the groups.

A link is a token of A and a token of B that end at the same offset. The shorter of the two is
a suffix of the longer one, so two vocabularies admit at most ``pair_bound`` different pairs
(about one for each byte of their entries), whatever the corpus: the corpus-wide table of pair
counts is that small, and is sent to every task.

Texts that are null or empty, or whose tokens of either kind do not spell the text with its
space, have no tokens. Long texts are encoded in parts cut where no token of either kind can
span. Repeated rows are aligned one by one and count as often as they stand. A null id is an id
like any other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import staged
from touchline.llm.tokens import parts

BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
WORK = 1 << 15  # ends of a piece
CHUNK_BYTES = 1 << 20  # text encoded and merged at a time
PAIR_BITS = 32  # of the A id above the B id, in a pair's number


@dataclass
class Entries:
    """A vocabulary's entries as bytes, laid end to end."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, entries: list[bytes]) -> Entries:
        size = np.array([len(e) for e in entries], np.int64)
        return cls(np.frombuffer(b"".join(entries), np.uint8), np.cumsum(size) - size, size)

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        """The joined bytes of tokens."""
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.start[ids] - (ends - size), size)
        return self.data[at + np.arange(len(at))]


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others, in order, for the code points from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@cache
def byte_tokenizer(vocabulary: str) -> tuple[Callable[[str], np.ndarray], Entries]:
    """The encoder of a byte-level vocabulary file, and its entries.

    Ids of such a file are in the order of its merges, which makes them merge ranks.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as file:
        model = json.load(file)
    added = {t["content"] for t in model["added_tokens"]}
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in added}
    encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    entries = [b""] * (max(ranks.values()) + 1)
    for entry, i in ranks.items():
        entries[i] = entry
    return lambda text: np.array(encoding.encode_ordinary(text), np.int64), Entries.of(entries)


@cache
def piece_tokenizer(vocabulary: str) -> tuple[Callable[[list[str]], list[list[int]]], Entries]:
    """The encoder of a piece vocabulary file, and its entries."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))

    def entry(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return lambda texts: model.encode(texts, num_threads=1), Entries.of([entry(i) for i in range(model.get_piece_size())])


def pair_bound(a: Entries, b: Entries) -> int:
    """How many pairs of entries can end together: for each entry, as many entries of the other
    vocabulary as it has suffixes, times the most entries that share their bytes."""

    def most_alike(e: Entries) -> int:
        whole = e.data.tobytes()
        seen: dict[bytes, int] = {}
        for s, n in zip(e.start.tolist(), e.size.tolist()):
            seen[whole[s : s + n]] = seen.get(whole[s : s + n], 0) + 1
        return max(seen.values())

    return int(a.size.sum()) * most_alike(b) + int(b.size.sum()) * most_alike(a)


def cuts(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two rising sequences crosses its diagonals: how many elements of each
    are among the first ``work``, 2 ``work``, ... merged ones (of equal ones, A's come first)."""
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    searched = np.flatnonzero(low < high)
    while len(searched):
        middle = (low[searched] + high[searched]) // 2
        further = a[middle] <= b[diagonal[searched] - 1 - middle]
        low[searched] = np.where(further, middle + 1, low[searched])
        high[searched] = np.where(further, high[searched], middle)
        searched = searched[low[searched] < high[searched]]
    return low, diagonal - low


def shared_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Positions in two strictly rising sequences at which they hold the same value."""
    i, j = cuts(a, b, work)
    found = []
    for k in range(len(i) - 1):
        mine, other = a[i[k] : i[k + 1]], b[j[k] : j[k + 1]]
        if k and i[k] and j[k] < len(b) and a[i[k] - 1] == b[j[k]]:  # parted by the cut before
            found.append((i[k] - 1 + np.zeros(1, np.int64), j[k] + np.zeros(1, np.int64)))
        if len(mine) and len(other):
            at = np.minimum(np.searchsorted(other, mine), len(other) - 1)
            same = np.flatnonzero(other[at] == mine)
            found.append((i[k] + same, j[k] + at[same]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def chunks(texts: list[str | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[list[str]]]]:
    """Consecutive texts of about ``size`` characters, each as its parts with a space before it;
    null and empty texts have no part."""
    first, group, held = 0, [], 0
    for k, text in enumerate(texts):
        group.append(list(parts(" " + text)) if text else [])
        held += len(text or "")
        if held >= size:
            yield first, group
            first, group, held = k + 1, [], 0
    if group:
        yield first, group


@dataclass
class Alignment:
    """Tokens of some texts, where each text's begin, and the token pairs that end together."""

    a: np.ndarray
    b: np.ndarray
    a_places: np.ndarray
    b_places: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray

    @property
    def link_places(self) -> np.ndarray:
        """Where each text's links begin."""
        return np.searchsorted(self.at_a, self.a_places)


def align(group: list[list[str]], byte_file: str, piece_file: str, work: int = WORK) -> Alignment:
    encode_a, entries_a = byte_tokenizer(byte_file)
    encode_b, entries_b = piece_tokenizer(piece_file)
    flat = [part for text in group for part in text]
    many = np.array([len(text) for text in group])
    first = np.cumsum(many) - many
    nothing = np.zeros(0, np.int64)

    def laid(encoded: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens in a row, and how many each text has."""
        size = np.append(np.cumsum([0] + [len(e) for e in encoded])[first], sum(len(e) for e in encoded))
        return np.concatenate([nothing, *encoded]), np.diff(size)

    a, n_a = laid([encode_a(part) for part in flat])
    b, n_b = laid([np.array(e, np.int64) for e in encode_b([part[1:] for part in flat])])
    whole = ["".join(text).encode() for text in group]
    size = np.array([len(t) for t in whole])
    kept = np.ones(len(group), bool)
    for tokens, counts, entries in ((a, n_a, entries_a), (b, n_b, entries_b)):
        kept &= _spells(tokens, counts, entries, whole, size)
    if not kept.all():
        a, b = a[np.repeat(kept, n_a)], b[np.repeat(kept, n_b)]
        n_a, n_b = n_a * kept, n_b * kept
    at_a, at_b = shared_ends(np.cumsum(entries_a.size[a]), np.cumsum(entries_b.size[b]), work)
    return Alignment(a, b, np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b)), at_a, at_b)


def _spells(tokens: np.ndarray, counts: np.ndarray, entries: Entries, whole: list[bytes], size: np.ndarray) -> np.ndarray:
    """Which texts their tokens spell."""
    ends = np.append(0, np.cumsum(entries.size[tokens]))
    places = np.append(0, np.cumsum(counts))
    lengths = ends[places[1:]] - ends[places[:-1]]
    right = lengths == size
    spelt, text = entries.spelt(tokens), np.frombuffer(b"".join(whole), np.uint8)
    if right.all():
        wrong = np.flatnonzero(spelt != text)
        right[np.searchsorted(np.cumsum(size), wrong, "right")] = False
    else:
        for k in np.flatnonzero(right):
            right[k] = spelt[ends[places[k]] : ends[places[k + 1]]].tobytes() == whole[k]
    return right


@cache
def _shown(n: int, ends: str) -> np.ndarray:
    """Decimal ids followed by a comma, or by the mark that ends a group."""
    return np.array([f"{i}{mark}" for i in range(n) for mark in ("," + ends)], object)


def written(found: Alignment) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``: ids of A, then of B, group by group."""
    n_a, n_b = len(found.a), len(found.b)
    last_a, last_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    last_a[found.at_a] = last_b[found.at_b] = 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    out = np.empty(n_a + n_b, object)
    # A token stands after the tokens of its own kind before it, and after the other kind's of
    # all groups before its own; a group's tokens of A stand before those of B.
    past_a, past_b = np.append(0, found.at_a + 1), np.append(0, found.at_b + 1)
    out[np.arange(n_a) + past_b[group_a]] = _shown(int(found.a.max(initial=0)) + 1, "|")[2 * found.a + last_a]
    out[np.arange(n_b) + past_a[group_b + 1]] = _shown(int(found.b.max(initial=0)) + 1, ";")[2 * found.b + last_b]
    places = (found.a_places + found.b_places).tolist()
    shown = out.tolist()
    return ["".join(shown[p:q])[:-1] for p, q in zip(places, places[1:])]


def _aligned(byte_file: str, piece_file: str):
    """(doc_id, text) -> an alignment per chunk, with the chunk's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Alignment]]:
        for batch in batches:
            for first, group in chunks(batch["text"].to_pylist()):
                yield batch["doc_id"].slice(first, len(group)), align(group, byte_file, piece_file)

    return run


def _rows(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def _lists(places: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(values.astype(np.int32)))


def tokens_of(
    docs: DataFrame, text: str = "text", key: str = "doc_id", byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE
) -> DataFrame:
    """One row per document: its tokens, and the tokens (from 0) at which its groups end.

    doc_id, a, b, ends_a, ends_b; group g holds A's tokens after ends_a[g - 1] up to ends_a[g].
    """
    rows, kind = _rows(docs, text, key)
    read = _aligned(byte_file, piece_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in read(batches):
            links = found.link_places
            which = np.repeat(np.arange(len(ids)), np.diff(links))
            columns = [ids, _lists(found.a_places, found.a), _lists(found.b_places, found.b)]
            columns += [_lists(links, found.at_a - found.a_places[which]), _lists(links, found.at_b - found.b_places[which])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a", "b", "ends_a", "ends_b"])

    return rows.mapInArrow(run, f"doc_id {kind}, a array<int>, b array<int>, ends_a array<int>, ends_b array<int>")


def _digested(byte_file: str, piece_file: str):
    """(doc_id, text) -> counts, the groups' hash, and the pairs of the text's links."""
    read = _aligned(byte_file, piece_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in read(batches):
            places = found.link_places
            pairs = (found.a[found.at_a] << PAIR_BITS) | found.b[found.at_b]
            shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in written(found)]
            counts = [np.diff(found.a_places), np.diff(found.b_places), np.diff(places)]
            columns = [ids, *(pa.array(c) for c in counts), pa.array(shas, pa.string())]
            columns.append(pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(pairs)))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pairs) -> (pair, n), each pair once a task: the vocabularies bound what is held."""
    pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        fresh, times = np.unique(batch["pairs"].flatten().to_numpy(), return_counts=True)
        both, where = np.unique(np.concatenate([pair, fresh]), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, where, np.concatenate([n, times]))
        pair, n = both, total
    if len(pair):
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])


def pair_counts(links: DataFrame) -> DataFrame:
    """Links' pairs -> a_id, b_id, n, and the highest n of the B id."""
    counted = links.select("pairs").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    ids = counted.select(
        F.shiftright("pair", PAIR_BITS).alias("a_id"), F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1).alias("b_id"), "n"
    )
    return ids.join(ids.groupBy("b_id").agg(F.max("n").alias("highest")), "b_id").select("a_id", "b_id", "n", "highest")


def digest(
    docs: DataFrame, text: str = "text", key: str = "doc_id", byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is among the best if its pair stands as often in the corpus as any pair of its B id.
    """
    rows, kind = _rows(docs, text, key)
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>"
    links = staged(rows.mapInArrow(_digested(byte_file, piece_file), schema))
    counts = pair_counts(links).toArrow()  # at most pair_bound rows
    pair = (counts["a_id"].to_numpy() << PAIR_BITS) | counts["b_id"].to_numpy()
    order = np.argsort(pair)
    n, best = counts["n"].to_numpy()[order], (counts["n"].to_numpy() == counts["highest"].to_numpy())[order]
    table = docs.sparkSession.sparkContext.broadcast((pair[order], n, best))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = table.value
        for batch in batches:
            places = batch["pairs"].offsets.to_numpy()
            at = np.searchsorted(pair, batch["pairs"].flatten().to_numpy())
            n_best, count_sum = (np.diff(np.append(0, np.cumsum(x[at], dtype=np.int64))[places - places[0]]) for x in (best, n))
            names = ["doc_id", "n_a", "n_b", "n_groups"]
            columns = [*(batch[c] for c in names), pa.array(np.diff(places).astype(np.int64))]
            columns += [pa.array(n_best), pa.array(count_sum), batch["groups_sha256"]]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_links", "n_best", "count_sum", "groups_sha256"])

    result = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return links.mapInArrow(weighed, result)
