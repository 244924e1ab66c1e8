"""Words of Arrow text columns as 64-bit hashes, computed by whole-array numpy steps.

A word's hash is a polynomial over its bytes modulo 2**64, read off prefix sums, so neither
words nor characters become Python objects. Texts are cut at separators into pieces of about
a quarter of a megabyte, as a byte takes tens of bytes here and workers keep what they had:
memory does not depend on a text's length unless one word is longer than that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, PIECE + (1 << 16))
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE, np.uint64)]))
        _inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _INVERSE, np.uint64)]))


def byte_table(blank: set[int] | None = None) -> np.ndarray:
    """Maps a byte to its lower-case form, or to 0 where it separates words.

    Without ``blank`` every ASCII byte but letters and digits separates.
    """
    out = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        keep = b not in blank if blank is not None else (b > 127 or chr(b).isalnum())
        out[b] = (low or 1) if keep else 0  # byte 0 can be part of a word of the first kind
    return out


WHITE = byte_table({0x20, *range(0x09, 0x0E)})
LETTERS = byte_table()


def _fold_latin(code: np.ndarray) -> None:
    """Lower-case the Latin-1 letters of UTF-8 bytes in place; lengths do not change."""
    second = np.flatnonzero(code[:-1] == 0xC3) + 1
    byte = code[second]
    code[second[(byte >= 0x80) & (byte <= 0x9E) & (byte != 0x97)]] += 0x20


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Piece:
    """Words of one piece. ``start``/``end`` index ``code``; ``offset`` is the piece's place."""

    code: np.ndarray
    sums: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    offset: int

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes from ``start`` to ``end``, wherever they stand."""
        return mix64((self.sums[end] - self.sums[start]) * _inverses[start] + (end - start).astype(np.uint64))

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.start, self.end)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the n + 1 places where texts begin; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[places[0] : places[-1]], places - places[0]


def pieces(texts: pa.Array, table: np.ndarray) -> Iterator[Piece]:
    """Pieces of a text column in order; a word never spans two pieces or two texts."""
    data, places = flat(texts)
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + PIECE)
        code = np.take(table, data[at:to], mode="clip")
        if to < n:
            gaps = np.flatnonzero(code == 0)
            k = np.searchsorted(places, to, "right") - 1
            cut = max(int(gaps[-1]) + 1 + at if len(gaps) else at, int(places[k]))
            while cut <= at:  # a word longer than the piece: go on to its end
                more = min(n, to + PIECE)
                rest = table[data[to:more]]
                gaps = np.flatnonzero(rest == 0)
                nearest = int(places[min(np.searchsorted(places, to, "right"), len(places) - 1)])
                stop = to + int(gaps[0]) + 1 if len(gaps) else more
                stop = min(stop, nearest) if nearest > to else stop
                to = stop
                if len(gaps) or stop == nearest or to == n:
                    cut = to
            code = code[: cut - at] if cut <= at + len(code) else np.take(table, data[at:cut], mode="clip")
            to = cut
        if table is LETTERS:
            _fold_latin(code)
        yield _piece(code, at, places)
        at = to


def _piece(code: np.ndarray, at: int, places: np.ndarray) -> Piece:
    size = len(code)
    _grow(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(code.astype(np.uint64) * _powers[:size], out=sums[1:])
    inside = np.zeros(size + 2, bool)
    inside[1:-1] = code > 0
    border = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = border[::2], border[1::2]
    low, high = np.searchsorted(places, at, "right") - 1, np.searchsorted(places, at + size)
    own = places[low + 1 : high] - at
    joined = np.unique(own[(code[own] > 0) & (code[own - 1] > 0)])  # a word ends where a text does
    start = np.insert(start, np.searchsorted(start, joined), joined)
    end = np.insert(end, np.searchsorted(end, joined), joined)
    words = np.diff(np.concatenate([[0], np.searchsorted(start, own), [len(start)]]))
    return Piece(code, sums, start, end, np.repeat(np.arange(low, high), words), at)


def slices(column: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of about ``most`` bytes, with their first row."""
    sizes = np.cumsum(np.asarray(pa.compute.binary_length(column.fill_null(""))))
    at = 0
    while at < len(column):
        base = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + most, "right")))
        yield at, column.slice(at, to - at)
        at = to


class Once:
    """Distinct pairs of a text and one of ``size`` slots, over a column's pieces in order.

    Pieces share at most one text: the slots of a piece's last text are held for the next one.
    """

    def __init__(self, size: int):
        self.bits, self.doc, self.held = size.bit_length(), -1, np.zeros(size, bool)

    def fresh(self, doc: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs not returned before."""
        pairs = np.unique((doc << self.bits) | slot)
        if not len(pairs):
            return doc, slot
        doc, slot = pairs >> self.bits, pairs & ((1 << self.bits) - 1)
        new = (doc != self.doc) | ~self.held[slot]
        if doc[-1] != self.doc:
            self.doc = doc[-1]
            self.held[:] = False
        self.held[slot[np.searchsorted(doc, self.doc) :]] = True
        return doc[new], slot[new]


def word_column(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of a column."""
    found = [(p.word_hashes(), p.doc) for p in pieces(texts, table)]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([h for h, _ in found]), np.concatenate([d for _, d in found])
