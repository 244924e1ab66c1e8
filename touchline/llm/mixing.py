"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions.

Every source gets a target number of words; no target exceeds ``repeat`` times the source's
words, and what is cut off is shared again by weight until no source is above its cap. A
source's documents stand in a fixed pseudo-random order, and the mix takes that sequence of
words again and again until the target is met, so its taken words equal the rounded target
and a document is taken at most ``repeat`` times. Each source also has a weight schedule over
training time; its integral is the share of the source's target used up by then, and
inverting that integral at a document's cumulative demand gives the document's position in
training. ``mix`` range-sorts the taken copies by position.

Null sources form one source, last in order. Empty or null texts have size 0 and are never
taken. Repeated rows are separate documents. An empty table gives an empty result. Running
totals are formed in two levels, over blocks of a source and within a block: a source with a
third of all rows is spread over ``16 ** PREFIX`` tasks' worth of groups. The only window
without a partition runs over one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import fresh, staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEAT = 2
# Weights at equally spaced times of training, linear between them; sources take them in turn.
SCHEDULES = ((3.0, 2.0, 1.0), (1.0, 1.0, 1.0), (1.0, 2.0, 3.0))
PREFIX = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cycle(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeat: int = REPEAT
) -> DataFrame:
    """(source_key, source_size) -> the same with rank and target; one row per source.

    With sources ordered by cap per weight, the level at which the first i sources are full is
    (demand - their caps) / (weight of the rest). It rises while sources still fill up and
    falls afterwards, so the water level is its maximum.
    """
    everything = Window.partitionBy()
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy("source_key")) - 1)
    weighted = ranked.withColumn("weight", _cycle(weights, F.col("rank")).cast("double")).withColumn(
        "cap", F.col("source_size") * F.lit(repeat)
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    demand = F.sum("source_size").over(everything) * F.lit(float(share))
    levels = weighted.withColumn("level", (demand - before) / rest)
    return levels.select(
        "source_key",
        "rank",
        "source_size",
        F.least(F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight")).alias("target"),
    )


def _integral(schedule: tuple[float, ...]) -> list[float]:
    """Share of the schedule's area used up at each knot."""
    areas = [(a + b) / 2 for a, b in zip(schedule, schedule[1:])]
    total, used = sum(areas), [0.0]
    for area in areas:
        used.append(used[-1] + area / total)
    return used


def _inverse(schedule: tuple[float, ...], used: Column) -> Column:
    """Time at which the share ``used`` of the schedule's area is used up."""
    steps, knots = len(schedule) - 1, _integral(schedule)
    area = sum((a + b) / 2 for a, b in zip(schedule, schedule[1:]))
    time = F.lit(1.0)
    for i in reversed(range(steps)):
        left, slope = schedule[i], schedule[i + 1] - schedule[i]
        rest = (used - F.lit(knots[i])) * F.lit(area)  # left * x + slope * x * x / 2 == rest
        if slope:
            x = (F.sqrt(F.greatest(F.lit(left * left) + 2 * slope * rest, F.lit(0.0))) - left) / slope
        else:
            x = rest / left
        time = F.when(used <= F.lit(knots[i + 1]), (x + i) / steps).otherwise(time)
    return time


def position(rank: Column, used: Column, schedules=SCHEDULES) -> Column:
    out = _inverse(schedules[0], used)
    for i, schedule in enumerate(schedules[1:], 1):
        out = F.when(rank % len(schedules) == i, _inverse(schedule, used)).otherwise(out)
    return out


def assign(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    carry: tuple[str, ...] = (),
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeat: int = REPEAT,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and the copies taken
    (number, words, position) as an array; ``carry`` columns come along in a struct."""
    name = F.col(source).cast("string")
    carried = [F.struct(*carry).alias("carry")] if carry else []
    sized = docs.select(
        F.col(key).alias("doc_id"),
        F.when(name.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), name)).alias("source_key"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("shuffled"),
        word_count(F.col(text)).alias("size"),
        *([F.xxhash64(F.col(text)).alias("tie")] if carry else [F.lit(0).cast("long").alias("tie")]),
        *carried,
    ).withColumn("block", F.substring("shuffled", 1, PREFIX))
    sized = staged(sized)  # words are counted once; the later scans read the narrow columns
    keys = ["source_key", "block"]
    blocks = sized.groupBy(*keys).agg(F.sum("size").alias("words"))
    wanted = targets(blocks.groupBy("source_key").agg(F.sum("words").alias("source_size")), weights, share, repeat)
    earlier = Window.partitionBy("source_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        blocks.withColumn("before_block", F.coalesce(F.sum("words").over(earlier), F.lit(0).cast("long")))
        .drop("words")
        .join(wanted, "source_key")
    )
    inside = Window.partitionBy(*keys).orderBy("shuffled", "doc_id", "size", "tie")
    begins = (
        F.col("before_block") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    )
    rows = sized.join(placed, keys).withColumn("begins", begins)
    whole = F.round("target").cast("long")

    def copy(k: Column) -> Column:
        start = F.col("begins") + (k - 1) * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), whole - start))
        used = (start + words / F.lit(2)) / F.greatest(whole, F.lit(1).cast("long"))
        return F.struct(k.alias("copy"), words.alias("words"), position(F.col("rank"), used).alias("position"))

    copies = F.transform(F.sequence(F.lit(1), F.lit(repeat)), copy)
    rows = rows.withColumn("copies", F.filter(copies, lambda c: c["words"] > 0))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, c: total + c["words"])
    return rows.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), "copies", *(["carry"] if carry else [])
    )


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The training sequence: every taken copy with all columns of its document, its number,
    the words taken of it and its position, range-sorted by position."""
    carry = tuple(docs.columns)
    extra = {"copy": "mix_copy", "words": "mix_words", "position": "mix_position"}
    rows = assign(docs, text, source, key, carry).select("carry", F.explode("copies").alias("one"))
    named = {c: fresh(name, carry) for c, name in extra.items()}
    out = rows.select("carry.*", *[F.col(f"one.{c}").alias(name) for c, name in named.items()])
    return out.orderBy(named["position"], key, named["copy"])
