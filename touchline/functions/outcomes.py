"""Match outcome rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source feed and of the published models.
WINNER_CODES = {"HOME_TEAM": "H", "AWAY_TEAM": "A", "DRAW": "D"}
FINISHED = "FINISHED"
LIVE_STATUSES = ["IN_PLAY", "PAUSED"]
UPCOMING_STATUSES = ["SCHEDULED", "TIMED"]
MATCH_STATES = ["Finished", "Live", "Upcoming", "Other"]
POINTS = {"W": 3, "D": 1, "L": 0}
SCORE_SEPARATOR = " – "
NO_SCORE = "–"


def lookup(value: Column, table: dict, kind: str) -> Column:
    """Small fixed dictionary as a CASE; unknown and NULL give NULL."""
    chain = F.lit(None).cast(kind)
    for key, result in reversed(table.items()):
        chain = F.when(value == key, F.lit(result)).otherwise(chain)
    return chain


def winner_code(winner: Column) -> Column:
    return lookup(winner, WINNER_CODES, "string")


def side_result(result: Column, won: str, lost: str) -> Column:
    """W/D/L for the side that wins on code ``won`` and loses on code ``lost``."""
    return lookup(result, {won: "W", "D": "D", lost: "L"}, "string")


def points_for(team_result: Column) -> Column:
    return lookup(team_result, POINTS, "int")


def score_result(goals_for: Column, goals_against: Column) -> Column:
    """W/D/L by goals; NULL while a score is missing."""
    return (
        F.when(goals_for > goals_against, F.lit("W"))
        .when(goals_for < goals_against, F.lit("L"))
        .when(goals_for == goals_against, F.lit("D"))
    )


def match_state(status: Column) -> Column:
    return (
        F.when(status == FINISHED, F.lit("Finished"))
        .when(status.isin(LIVE_STATUSES), F.lit("Live"))
        .when(status.isin(UPCOMING_STATUSES), F.lit("Upcoming"))
        .otherwise(F.lit("Other"))
    )


def scoreline(status: Column, home: Column, away: Column) -> Column:
    """Finished: the score, NULL if incomplete; live: the score if complete; else a dash."""
    text = F.concat(home.cast("string"), F.lit(SCORE_SEPARATOR), away.cast("string"))
    return (
        F.when(status == FINISHED, text)
        .when(status.isin(LIVE_STATUSES) & home.isNotNull() & away.isNotNull(), text)
        .otherwise(F.lit(NO_SCORE))
    )
