"""Season totals per team, aggregated before any join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.numbers import count_where, ratio, round_to
from touchline.functions.text import surrogate_key
from touchline.operators import LEAGUE


def _sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def derived_totals(results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Played, W/D/L, points and goals reconstructed from match results."""
    outcome = F.col("team_result")
    return results.groupBy(*(keys or LEAGUE + ["team_id"])).agg(
        F.count(F.lit(1)).alias("played"),
        count_where(outcome == "W").alias("won"),
        count_where(outcome == "D").alias("drawn"),
        count_where(outcome == "L").alias("lost"),
        F.sum("points_earned").alias("points"),
        F.sum("goals_for").alias("goals_for"),
        F.sum("goals_against").alias("goals_against"),
    )


SUMS = ["played", "won", "drawn", "lost", "points", "goals_for", "goals_against"]


def round_sums(results: DataFrame) -> DataFrame:
    """Derived totals of each club and round: as many rows of a club as it has rounds, however
    many matches there are. Matches without a round are one more."""
    return derived_totals(results, [*LEAGUE, "team_id", "matchday"])


def totals_of_rounds(rounds: DataFrame) -> DataFrame:
    """``derived_totals`` from the sums of rounds."""
    return rounds.groupBy(*LEAGUE, "team_id").agg(*[F.sum(name).alias(name) for name in SUMS])


def team_performance(results: DataFrame, teams: DataFrame) -> DataFrame:
    """Fifteen season measures per club.

    The match rows collapse to one row per club in the map-side combine, so the club
    dimension joins a few aggregated rows, never the match rows.
    """
    home, away = F.col("venue") == "HOME", F.col("venue") == "AWAY"
    outcome, points = F.col("team_result"), F.col("points_earned")
    totals = results.groupBy("competition_id", *LEAGUE, "team_id").agg(
        F.count(F.lit(1)).alias("played"),
        count_where(outcome == "W").alias("won"),
        count_where(outcome == "D").alias("drawn"),
        count_where(outcome == "L").alias("lost"),
        F.sum(points).alias("points"),
        F.sum("goals_for").alias("goals_for"),
        F.sum("goals_against").alias("goals_against"),
        (F.sum("goals_for") - F.sum("goals_against")).alias("goal_difference"),
        round_to(ratio(F.sum(points), F.count(F.lit(1))), 3).alias("points_per_game"),
        round_to(F.avg("goals_for"), 3).alias("goals_for_per_game"),
        round_to(F.avg("goals_against"), 3).alias("goals_against_per_game"),
        count_where(home).alias("home_played"),
        _sum_if(home, points).alias("home_points"),
        count_where(away).alias("away_played"),
        _sum_if(away, points).alias("away_points"),
    )
    clubs = teams.select("competition_code", "team_id", "team_name", "short_name", "tla")
    key = surrogate_key(F.col("competition_code"), F.col("season_id"), F.col("team_id"))
    return totals.join(clubs, ["competition_code", "team_id"]).select(
        key.alias("team_performance_key"),
        "competition_id", *LEAGUE, "team_id", "team_name", "short_name", "tla",
        "played", "won", "drawn", "lost", "points", "goals_for", "goals_against",
        "goal_difference", "points_per_game", "goals_for_per_game", "goals_against_per_game",
        "home_played", "home_points", "away_played", "away_points",
    )


def performance_order(performance: DataFrame) -> DataFrame:
    """Best clubs first: points, goal difference, goals scored."""
    return performance.orderBy(
        F.col("points").desc_nulls_last(),
        F.col("goal_difference").desc_nulls_last(),
        F.col("goals_for").desc_nulls_last(),
        "team_performance_key",
    )


def home_vs_away(performance: DataFrame) -> DataFrame:
    """Points by venue, one row per club and venue."""
    return performance.select(*LEAGUE, "team_id", "short_name", "home_points", "away_points").unpivot(
        [*LEAGUE, "team_id", "short_name"],
        [F.col("home_points").alias("Home"), F.col("away_points").alias("Away")],
        "venue",
        "points",
    )
