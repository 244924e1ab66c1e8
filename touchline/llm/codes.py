"""Vector code compression: product quantisation by active-entry Lloyd rounds on integers.

Components x become floor(256 x); a vector is cut into ``PARTS`` equal consecutive parts, and
each part position has a codebook, started with that part of the first ``ENTRIES`` vectors by
id. A round assigns every part to its nearest entry (squared distance, ties to the lower index)
and replaces each entry by the floored mean of its parts; unused entries stay.

From the first round on, a part's exact distance to its entry is stored beside its code. Where
that entry did not move in the update, the stored distance still holds and no other unmoved
entry can have come nearer, so only the moved entries are compared with it, a tie going to the
lower index. Parts whose entry moved are compared with all entries. All arithmetic is exact: in
doubles where they hold every intermediate integer, in 64-bit integers otherwise.

Rows are never shuffled: a round reads the state of the round before from the shared folder,
writes its own, and sends one sum and count per part and entry, whose number is fixed.

Rows whose vector is null, empty, or holds null or non-finite components are dropped, as are
vectors not as long as the first one. Lengths that ``PARTS`` does not divide are filled up with
zeros. Components beyond ``limit`` are cut to it, so that sums of squares fit a long. Of equal
ids the smaller vector comes first; null ids come last; repeated rows are kept. Fewer vectors
than entries make a smaller codebook; an empty table gives an empty result. Errors of a label
whose sum exceeds a long are null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import staged, unstaged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
SLICE = 4096  # vectors compared at a time
EXACT = 1 << 53  # below it, doubles hold every integer


def limit(length: int) -> int:
    """The largest power of two for which ``length`` squared differences sum up within a long."""
    return 1 << ((60 - (length - 1).bit_length()) // 2)


def finite(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, x: rows whose vector has finite components."""
    rows = vectors.select(
        F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x")
    )
    # A NaN is greater than infinity.
    fine = F.forall("x", lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    return rows.filter((F.size("x") > 0) & fine)


def scaled(x: np.ndarray, parts: int) -> np.ndarray:
    """Vectors (n, length) of floats -> whole components (n, parts, width)."""
    n, length = x.shape
    most = limit(length)
    cells = np.zeros((n, -(-length // parts) * parts), np.int64)
    cells[:, :length] = np.clip(np.floor(x * SCALE), -most, most)
    return cells.reshape(n, parts, -1)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows (n, width) to entries (k, width)."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most * most * max(x.shape[1], 1) < EXACT:
        a, b = x.astype(float), entries.astype(float)
        cross = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
        return cross.astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - entries[None, :, j]) ** 2
    return out


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and distances (n, parts) of parts (n, parts, width), comparing all entries."""
    code, held = np.empty((2, *x.shape[:2]), np.int64)
    for p in range(x.shape[1]):
        found = distances(x[:, p], books[p])
        code[:, p] = found.argmin(axis=1)
        held[:, p] = found[np.arange(len(x)), code[:, p]]
    return code, held


def renewed(
    x: np.ndarray, code: np.ndarray, held: np.ndarray, books: np.ndarray, moved: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes and distances after an update of the books, and how many distances were computed.

    ``moved`` (parts, entries) marks the entries that changed.
    """
    code, held, computed = code.copy(), held.copy(), 0
    for p in range(x.shape[1]):
        active = np.flatnonzero(moved[p])
        if not len(active):
            continue
        stale = moved[p][code[:, p]]
        again = np.flatnonzero(stale)
        found = distances(x[again, p], books[p])
        code[again, p] = found.argmin(axis=1)
        held[again, p] = found.min(axis=1)
        fixed = np.flatnonzero(~stale)
        rivals = distances(x[fixed, p], books[p][active])
        best = rivals.argmin(axis=1)
        rival, at = active[best], rivals[np.arange(len(fixed)), best]
        mine, least = code[fixed, p], held[fixed, p]
        wins = (at < least) | ((at == least) & (rival < mine))
        code[fixed, p] = np.where(wins, rival, mine)
        held[fixed, p] = np.where(wins, at, least)
        computed += found.size + rivals.size
    return code, held, computed


def _grid(column: pa.Array, shape: tuple[int, ...]) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), *shape)


def _array(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1), kind), rows[0].size).cast(pa.list_(kind))


STATE = {"x": pa.int32(), "code": pa.int32(), "held": pa.int64()}


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE):
            yield batch.slice(begin, SLICE)


def _first(books: np.ndarray):
    """(vec_id, label, x floats) -> the state after comparing all entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = scaled(_grid(batch["x"], (-1,)), books.shape[0])
            columns = [_array(a, kind) for a, kind in zip((x, *nearest(x, books)), STATE.values())]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], *columns], ["vec_id", "label", *STATE])

    return run


def _next(books: np.ndarray, moved: np.ndarray):
    """The state of a round -> that of the next one."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x, code, held = (_grid(batch[c], s) for c, s in zip(STATE, ((parts, width), (parts,), (parts,))))
            code, held, _ = renewed(x.astype(np.int64), code, held, books, moved)
            columns = [batch["x"], _array(code, STATE["code"]), _array(held, STATE["held"])]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], *columns], ["vec_id", "label", *STATE])

    return run


def _summed(shape: tuple[int, int, int]):
    """State -> (cell, total): component sums of every part and entry, and counts after them."""
    parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in _slices(batches):
            x, code = _grid(batch["x"], (parts, width)), _grid(batch["code"], (parts,))
            for p in range(parts):
                counts[p] += np.bincount(code[:, p], minlength=entries)
                for j in range(width):  # a slice's sums are small enough for doubles
                    sums[p, :, j] += np.bincount(code[:, p], x[:, p, j], entries).astype(np.int64)
        totals = np.concatenate([sums.reshape(-1), counts.reshape(-1)])
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["cell", "total"])

    return run


def updated(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floored mean of its parts; unused entries stay."""
    found = state.select("x", "code").mapInArrow(_summed(books.shape), "cell long, total long")
    table = found.groupBy("cell").agg(F.sum("total").alias("total")).toArrow()  # as many as the books have numbers
    totals = np.zeros(books.size + books.shape[0] * books.shape[1], np.int64)
    totals[table["cell"].to_numpy()] = table["total"].to_numpy()
    sums, counts = totals[: books.size].reshape(books.shape), totals[books.size :].reshape(books.shape[:2])
    used = counts > 0
    out = books.copy()
    out[used] = sums[used] // counts[used][:, None]
    return out


@dataclass
class Coded:
    """Rows (vec_id, label, x, code, held) with whole components, codes and squared distances,
    and the codebooks (parts, entries, width); ``rows`` is None without any vector."""

    rows: DataFrame | None
    books: np.ndarray


def encode(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> Coded:
    """Codes of vectors after ``rounds`` updates of the codebooks."""
    rows = finite(vectors, key, vector, label)
    order = (F.asc_nulls_last("vec_id"), "x")
    start = rows.orderBy(*order).limit(entries).select("x").collect()
    if not start:
        return Coded(None, np.zeros((parts, 0, 0), np.int64))
    length = len(start[0]["x"])
    rows = rows.filter(F.size("x") == length)
    if any(len(r["x"]) != length for r in start):
        start = rows.orderBy(*order).limit(entries).select("x").collect()
    books = scaled(np.array([r["x"] for r in start]), parts).transpose(1, 0, 2).copy()
    id_kind, label_kind = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    schema = f"vec_id {id_kind}, label {label_kind}, x array<int>, code array<int>, held array<long>"
    state = staged(rows.mapInArrow(_first(books), schema))
    for _ in range(rounds):
        before, books = books, updated(state, books)
        moved = (books != before).any(axis=2)
        following = staged(state.mapInArrow(_next(books, moved), schema))
        unstaged(state)
        state = following
    return Coded(state, books)


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def digest(vectors: DataFrame, **names) -> DataFrame:
    """vec_id, code (hex), error, label_error, codebooks_sha256."""
    coded = encode(vectors, **names)
    if coded.rows is None:
        kind = finite(vectors, **({"key": "vec_id", "vector": "embedding", "label": "label"} | names)).schema["vec_id"]
        schema = f"vec_id {kind.dataType.simpleString()}, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)
    shown = F.lower(F.concat_ws("", F.transform("code", lambda c: F.lpad(F.hex(c), 2, "0"))))
    error = F.aggregate("held", F.lit(0).cast("long"), lambda total, d: total + d)
    rows = coded.rows.select("vec_id", "label", shown.alias("code"), error.alias("error"))
    total = F.sum(F.col("error").cast("decimal(19,0)")).try_cast("long")
    labels = rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books_sha256(coded.books)).alias("codebooks_sha256")
    )
