"""Position history that goes on from stored rounds instead of starting at the first one.

Matches are kept by league and block of ``BLOCK`` rounds, and so is the history: the last round of a
block is the state that the next one starts from. When a match changes, only its league's history
from that block on differs. It is computed from the block before and the matches since; earlier
ones are not read. Which blocks have changed is told by the names of parts.

A league whose clubs have changed starts anew, as every club stands in every round. A league that
is gone loses its rounds. Matches without a round take no part. Names and badges are joined when
the history is read, so a new badge rewrites nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.operators import LEAGUE
from touchline.operators.history import MEASURES, resumed_rows
from touchline.operators.participants import team_match_results
from touchline.schemas import FACT_MATCH
from touchline.session import scratch_folder
from touchline.sources.commits import Commit, Store, key_value, part_of
from touchline.sources.tables import read_table, write_table

BLOCK = 8  # rounds
PART = [*LEAGUE, "block"]
MATCHES, HISTORY = "fact_match", "history"
MATCH_ROW = f"{FACT_MATCH}, block int"
HISTORY_ROW = (
    "competition_code string, season_id bigint, matchday int, team_id bigint, derived_position int, "
    "played bigint, points bigint, goals_for bigint, goals_against bigint, goal_difference bigint, block int"
)


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows with the block of their round."""
    return rows.withColumn("block", F.floor((F.col("matchday") - 1) / BLOCK).cast("int"))


def round_store(spark: SparkSession, root: str) -> Store:
    """Matches by league and block, as ``in_blocks`` gives them."""
    return Store(spark, root, {MATCHES: (MATCH_ROW, PART)})


def history_store(spark: SparkSession, root: str) -> Store:
    """The history by league and block."""
    return Store(spark, root, {HISTORY: (HISTORY_ROW, PART)})


def _league(part: Column) -> Column:
    return F.substring_index(part, "/", 2)


def _blocks(parts: DataFrame) -> DataFrame:
    """Parts with their league and block; rounds that are not known have none."""
    named = parts.withColumns({"league": _league(F.col("part")), "block": key_value(F.col("part"), 2).cast("int")})
    return named.filter("block IS NOT NULL")


def _clubs(rows: DataFrame) -> DataFrame:
    return rows.select(*LEAGUE, "team_id").distinct()


def resume_points(
    base: Store, before: Commit | None, after: Commit, history: Store, last: Commit | None, current: DataFrame
) -> DataFrame:
    """(league, start, seed) of every league to compute: the first block to compute (NULL: all) and
    the stored block to go on from (NULL: none).

    The last stored block may be unfinished, so it is computed again; the ones before are whole.
    """
    first = _blocks(base.changed(before, after)).groupBy("league").agg(F.min("block").alias("first"))
    stored = _blocks(history.parts(HISTORY, last)).select("league", "block")
    newest = stored.groupBy("league").agg(F.max("block").alias("newest"))
    start = F.when(F.col("newest").isNotNull(), F.least("first", "newest"))
    starts = first.join(newest, "league", "left").select("league", start.alias("start"))
    seeds = starts.join(stored, "league", "left").groupBy("league", "start").agg(
        F.max(F.when(F.col("block") < F.col("start"), F.col("block"))).alias("seed")
    )
    if last is None:
        return seeds
    # Every block of a league holds all its clubs; the first one tells them.
    parts = _blocks(history.parts(HISTORY, last))
    opening = parts.groupBy("league").agg(F.min_by("part", "block").alias("part")).select("part")
    known = _clubs(history.read(HISTORY, last, parts.join(opening, "part", "left_semi").select("part", "attempt")))
    named = _clubs(current)
    # A league without a stored block starts anew anyway.
    kept = known.select(*LEAGUE).distinct()
    other = known.exceptAll(named).unionByName(named.join(kept, LEAGUE, "left_semi").exceptAll(known))
    anew = other.select(part_of(LEAGUE).alias("league")).distinct()
    return seeds.join(anew, "league", "left_anti").unionByName(
        anew.select("league", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("seed"))
    )


def refresh_history(spark: SparkSession, base: Store, root: str, current: DataFrame, version: str) -> Commit:
    """Bring the stored history up to the newest matches and the clubs of the current table."""
    after = base.newest()
    if after is None:
        raise FileNotFoundError(f"nothing committed under {base.root}")
    history = history_store(spark, root)
    last = history.newest()
    before = base.commit_of(last.base) if last else None
    folder = scratch_folder(spark)
    write_table(resume_points(base, before, after, history, last, current), f"{folder}/points")
    points = read_table(spark, f"{folder}/points", "league string, start int, seed int")

    from_start = F.col("start").isNull() | (F.col("block") >= F.col("start"))
    new = _blocks(base.parts(MATCHES, after)).join(points, "league").filter(from_start)
    played = base.read(MATCHES, after, new.select("part", "attempt"))
    stored = _blocks(history.parts(HISTORY, last)).join(points, "league")
    seeds = spark.createDataFrame([], HISTORY_ROW)
    if last:
        closing = F.max("matchday").over(Window.partitionBy(*LEAGUE))
        block = history.read(HISTORY, last, stored.filter("block = seed").select("part", "attempt"))
        seeds = block.withColumn("closing", closing).filter("matchday = closing").drop("closing")
    rows = resumed_rows(_clubs(current), seeds, played, team_match_results(played))
    rows = in_blocks(rows).select(
        *LEAGUE, "matchday", "team_id", "derived_position", *MEASURES, "goal_difference", "block"
    )
    gone = stored.filter(from_start).select(F.lit(HISTORY).alias("table_name"), "part")
    return history.commit({HISTORY: rows}, version, seen=last, replaced=gone, base=after.number)


def stored_history(spark: SparkSession, root: str, current: DataFrame, commit: Commit | None = None) -> DataFrame:
    """The history as ``operators.history.position_history`` gives it, from the stored rounds."""
    names = current.select(*LEAGUE, "team_id", "short_name", "tla", "sportsdb_badge_url")
    return history_store(spark, root).read(HISTORY, commit).join(names, [*LEAGUE, "team_id"]).select(
        *LEAGUE, "matchday", "team_id", "short_name", "tla", "sportsdb_badge_url", "derived_position", *MEASURES, "goal_difference"
    )
