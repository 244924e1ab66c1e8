"""Rounds (matchdays): status, completed prefix, default round, navigation, goals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.functions.numbers import count_where, ratio
from touchline.functions.outcomes import FINISHED, match_state
from touchline.operators import LEAGUE


def round_status(matches: DataFrame) -> DataFrame:
    """Total and finished matches per round; matches without a round are left out."""
    return (
        matches.filter(F.col("matchday").isNotNull())
        .groupBy(*LEAGUE, "matchday")
        .agg(
            F.count(F.lit(1)).alias("total_matches"),
            count_where(F.col("status") == FINISHED).alias("finished_matches"),
        )
    )


def completed_rounds(status: DataFrame) -> DataFrame:
    """Contiguous fully finished rounds from the start of each season.

    A running sum of unfinished rounds stays 0 exactly until the first gap. It runs on one
    row per round, so a league's window is a few dozen rows whatever the match count.
    """
    unfinished = (F.col("total_matches") != F.col("finished_matches")).cast("int")
    so_far = W.partitionBy(*LEAGUE).orderBy("matchday").rowsBetween(W.unboundedPreceding, 0)
    return (
        status.withColumn("_gaps", F.sum(unfinished).over(so_far))
        .filter(F.col("_gaps") == 0)
        .drop("_gaps")
    )


def latest_finished_round(status: DataFrame) -> DataFrame:
    """Highest round with every match finished, contiguous or not (NULL if there is none)."""
    done = F.col("total_matches") == F.col("finished_matches")
    return status.groupBy(*LEAGUE).agg(
        F.max(F.when(done, F.col("matchday"))).alias("latest_completed_round")
    )


def _rounds_by_state(matches: DataFrame) -> DataFrame:
    state = match_state(F.col("status"))
    return (
        matches.filter(F.col("matchday").isNotNull())
        .groupBy(*LEAGUE, "matchday")
        .agg(
            F.max(state == "Live").alias("has_live"),
            F.max(state == "Finished").alias("has_finished"),
            F.max(state == "Upcoming").alias("has_upcoming"),
        )
    )


def _default_round():
    """Earliest live, else latest finished, else earliest upcoming round."""
    matchday = F.col("matchday")
    return [
        F.min(F.when(F.col("has_live"), matchday)),
        F.max(F.when(F.col("has_finished"), matchday)),
        F.min(F.when(F.col("has_upcoming"), matchday)),
    ]


def default_round(matches: DataFrame) -> DataFrame:
    """Round a page opens on, per league; "All" when no match has a usable state."""
    chosen = F.coalesce(*_default_round())
    return (
        _rounds_by_state(matches)
        .groupBy(*LEAGUE)
        .agg(chosen.alias("default_matchday"))
        .withColumn("default_label", F.coalesce(F.col("default_matchday").cast("string"), F.lit("All")))
    )


def _numbered_rounds(matches: DataFrame) -> DataFrame:
    league = W.partitionBy(*LEAGUE)
    ordered = league.orderBy("matchday")
    return _rounds_by_state(matches).select(
        *LEAGUE,
        "matchday",
        F.row_number().over(ordered).alias("round_no"),
        F.count(F.lit(1)).over(league).alias("rounds"),
        F.lag("matchday").over(ordered).alias("previous_matchday"),
        F.lead("matchday").over(ordered).alias("next_matchday"),
        F.coalesce(*[value.over(league) for value in _default_round()]).alias("default_matchday"),
    )


def round_neighbours(matches: DataFrame) -> DataFrame:
    """Previous and next existing round of every round."""
    return _numbered_rounds(matches).select(
        *LEAGUE, "matchday", "previous_matchday", "next_matchday"
    )


def round_window(matches: DataFrame, selected: int | None = None, size: int = 7) -> DataFrame:
    """The ``size`` rounds around the anchor, clamped to the season's first and last round.

    Anchor: the selected round if it exists, else the default round, else the first round.
    """
    league = W.partitionBy(*LEAGUE)

    def position_of(matchday):
        return F.max(F.when(F.col("matchday") == matchday, F.col("round_no"))).over(league)

    anchor = F.coalesce(
        position_of(F.lit(selected).cast("int")), position_of(F.col("default_matchday")), F.lit(1)
    )
    centred = F.greatest(F.lit(1), F.col("anchor_no") - F.lit(size // 2))
    first = F.least(centred, F.greatest(F.lit(1), F.col("rounds") - F.lit(size) + 1))
    return (
        _numbered_rounds(matches)
        .withColumn("anchor_no", anchor)
        .withColumn("first_no", first)
        .filter(F.col("round_no").between(F.col("first_no"), F.col("first_no") + size - 1))
        .select(
            *LEAGUE,
            "matchday",
            (F.col("round_no") - F.col("first_no") + 1).cast("int").alias("slot"),
            (F.col("round_no") == F.col("anchor_no")).alias("is_anchor"),
        )
    )


def goals_by_round(matches: DataFrame) -> DataFrame:
    """Finished matches, goals and goals per match for every round."""
    goals = F.coalesce(F.sum(F.col("home_score") + F.col("away_score")), F.lit(0))
    played = F.count("match_id")
    return (
        matches.filter((F.col("status") == FINISHED) & F.col("matchday").isNotNull())
        .groupBy(*LEAGUE, "matchday")
        .agg(
            played.alias("matches"),
            goals.cast("bigint").alias("goals"),
            ratio(goals, played).alias("goals_per_match"),
        )
    )
