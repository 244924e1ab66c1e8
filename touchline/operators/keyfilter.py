"""A Bloom filter of keys, as a small table: it drops rows of a large side before they are shuffled.

A key is hashed to one of ``slots`` words of 64 bits and to ``HASHES`` bits in it, so making the
filter is one ``bit_or`` per slot, combined before the shuffle, and asking it is one join and one
mask. It has at most ``slots`` rows of two numbers, whatever the number of keys, so it may be sent
to all tasks. A row whose key was put in always passes; others pass by chance, the more the fuller
the words are. Whoever needs exact results joins what is left. Null keys never pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 4
SLOTS = 1 << 17  # two megabytes
MAX_SLOTS = 1 << 19  # eight megabytes, below Spark's own size threshold for sending a side


def _hashed(keys: list[str], slots: int) -> tuple[Column, Column]:
    """Slot of a key, and its bits there."""
    columns = [F.col(k) for k in keys]
    bits = F.xxhash64(F.lit(2), *columns)
    places = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(HASHES)]
    each = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return F.pmod(F.xxhash64(F.lit(1), *columns), F.lit(slots)), reduce(Column.bitwiseOR, each)


def _known(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))


def key_filter(rows: DataFrame, keys: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, bits) of all keys without a null."""
    if not 1 <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must lie between 1 and {MAX_SLOTS}")
    slot, mask = _hashed(keys, slots)
    hashed = _known(rows, keys).select(slot.alias("slot"), mask.alias("mask"))
    return hashed.groupBy("slot").agg(F.bit_or("mask").alias("bits"))


def passing(rows: DataFrame, keys: list[str], found: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The rows whose key may be in the filter ``found``, made with as many ``slots``."""
    slot, mask = _hashed(keys, slots)
    words = found.select(F.col("slot").alias("_slot"), F.col("bits").alias("_bits"))
    return (
        _known(rows, keys)
        .join(F.broadcast(words), (slot == F.col("_slot")) & (F.col("_bits").bitwiseAND(mask) == mask))
        .select(*[F.col(f"`{c}`") for c in rows.columns])
    )
