"""League position after every completed round, rebuilt from match results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.functions.numbers import clamp
from touchline.operators import LEAGUE
from touchline.operators.rounds import completed_rounds, round_status
from touchline.operators.standings import races_of

MEASURES = ["played", "points", "goals_for", "goals_against"]


def round_totals(results: DataFrame) -> DataFrame:
    """Played, points and goals of every team in every round (a team may play twice)."""
    return (
        results.filter(F.col("matchday").isNotNull())
        .groupBy(*LEAGUE, "team_id", "matchday")
        .agg(
            F.count("match_id").alias("played"),
            F.sum("points_earned").alias("points"),
            F.sum("goals_for").alias("goals_for"),
            F.sum("goals_against").alias("goals_against"),
        )
    )


def running_totals(rows: DataFrame, keys: list[str], order: str, measures: list[str]) -> DataFrame:
    """Replace measures by their running sums; a missing value adds nothing."""
    so_far = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    sums = {m: F.sum(F.coalesce(F.col(m), F.lit(0))).over(so_far) for m in measures}
    return rows.withColumns(sums)


def history_rows(current: DataFrame, matches: DataFrame, results: DataFrame) -> DataFrame:
    """Cumulative table of each completed round, with each club's official position and the
    table size.

    Match rows are reduced to one row per team and round before anything is joined or
    windowed. Every club of the current table appears at every checkpoint of its league,
    also before its first result; that dense grid is the requested output itself, built by
    an equi join on the league. Running windows then replace a range join: all rounds up to
    a checkpoint are checkpoints themselves, because the completed prefix is contiguous.
    """
    clubs = current.select(
        *LEAGUE, "team_id", "short_name", "tla", "sportsdb_badge_url",
        F.col("position").alias("official_position"),
    )
    checkpoints = completed_rounds(round_status(matches)).select(*LEAGUE, "matchday")
    grid = clubs.join(checkpoints, LEAGUE)
    dense = grid.join(round_totals(results), [*LEAGUE, "team_id", "matchday"], "left")
    return ranked(running_totals(dense, [*LEAGUE, "team_id"], "matchday", MEASURES))


def resumed_rows(clubs: DataFrame, seeds: DataFrame, matches: DataFrame, results: DataFrame) -> DataFrame:
    """The rounds after a known one: ``seeds`` holds the totals each club had there, ``matches`` and
    ``results`` the rounds since. Leagues without a seed start from nothing."""
    checkpoints = completed_rounds(round_status(matches)).select(*LEAGUE, "matchday")
    dense = clubs.join(checkpoints, LEAGUE).join(round_totals(results), [*LEAGUE, "team_id", "matchday"], "left")
    columns = [*LEAGUE, "team_id", "matchday", *MEASURES]
    known = seeds.select(*columns).withColumn("seed", F.lit(True))
    rows = dense.select(*columns).withColumn("seed", F.lit(False)).unionByName(known)
    return ranked(running_totals(rows, [*LEAGUE, "team_id"], "matchday", MEASURES).filter(~F.col("seed")).drop("seed"))


def ranked(totals: DataFrame) -> DataFrame:
    """Running totals with goal difference, position and table size at each checkpoint."""
    table = totals.withColumn("goal_difference", F.col("goals_for") - F.col("goals_against"))
    checkpoint = W.partitionBy(*LEAGUE, "matchday")
    best_first = checkpoint.orderBy(
        F.col("points").desc(), F.col("goal_difference").desc(), F.col("goals_for").desc()
    )
    return table.withColumns(
        {
            "derived_position": F.rank().over(best_first),
            "clubs": F.count(F.lit(1)).over(checkpoint),
        }
    )


def position_history(current: DataFrame, matches: DataFrame, results: DataFrame) -> DataFrame:
    """League position after each completed round, by points, goal difference and goals."""
    return history_rows(current, matches, results).select(
        *LEAGUE, "matchday", "team_id", "short_name", "tla", "sportsdb_badge_url",
        "derived_position", *MEASURES, "goal_difference",
    )


def history_order(history: DataFrame) -> DataFrame:
    return history.orderBy(
        *LEAGUE, "matchday", "derived_position", F.col("short_name").asc_nulls_last(), "team_id"
    )


def race_history(rows: DataFrame) -> DataFrame:
    """History of the clubs in each race preset, by their current official position.

    The presets overlap, so a club may appear in two races.
    """
    return rows.withColumn("race", F.explode(races_of(F.col("official_position")))).select(
        *LEAGUE, "race", "matchday", "team_id", "short_name", "derived_position",
        *MEASURES, "goal_difference",
    )


def club_history(history: DataFrame, short_names: list[str]) -> DataFrame:
    """Position history of freely chosen clubs."""
    return history.filter(F.col("short_name").isin(short_names))


def race_bounds(rows: DataFrame) -> DataFrame:
    """Chart range per race: min and max position, padded by one, within the table size."""
    spans = (
        rows.withColumn("race", F.explode(races_of(F.col("official_position"))))
        .groupBy(*LEAGUE, "race")
        .agg(
            F.min("derived_position").alias("best_position"),
            F.max("derived_position").alias("worst_position"),
            F.max("clubs").cast("int").alias("clubs"),
        )
    )
    one, clubs = F.lit(1), F.col("clubs")
    return spans.select(
        *LEAGUE,
        "race",
        "best_position",
        "worst_position",
        clamp(F.col("best_position") - 1, one, clubs).alias("chart_top"),
        clamp(F.col("worst_position") + 1, one, clubs).alias("chart_bottom"),
    )


def history_rounds(history: DataFrame) -> DataFrame:
    """Per league: number of checkpoints and the newest one."""
    return history.groupBy(*LEAGUE).agg(
        F.countDistinct("matchday").alias("completed_rounds"),
        F.max("matchday").alias("latest_derived_round"),
    )

