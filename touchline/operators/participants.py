"""One match -> two team rows, from a single scan and without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.outcomes import FINISHED, points_for, side_result
from touchline.functions.text import surrogate_key

RESULT_COLUMNS = [
    "team_match_key", "match_id", "competition_id", "competition_code", "season_id",
    "matchday", "utc_date", "team_id", "opponent_team_id", "venue", "goals_for",
    "goals_against", "team_result", "points_earned", "source_snapshot_date", "loaded_at",
]


# The two views of a match; ``stack`` emits both rows from one generated loop.
_SIDES = """stack(2,
  'HOME', home_team_id, away_team_id, home_score, away_score,
  'AWAY', away_team_id, home_team_id, away_score, home_score
) AS (venue, team_id, opponent_team_id, goals_for, goals_against)"""


def both_sides(matches: DataFrame) -> DataFrame:
    """Every match twice, with ``team_id``/``opponent_team_id``/goals seen from each side."""
    return matches.selectExpr("*", _SIDES)


def team_match_results(matches: DataFrame) -> DataFrame:
    """Team-centric results: one row per team per finished match."""
    rows = both_sides(matches.filter(F.col("status") == FINISHED))
    outcome = F.when(F.col("venue") == "HOME", side_result(F.col("result"), "H", "A")).otherwise(
        side_result(F.col("result"), "A", "H")
    )
    return (
        rows.withColumn("team_result", outcome)
        .withColumns(
            {
                "points_earned": points_for(F.col("team_result")),
                "team_match_key": surrogate_key(F.col("match_id"), F.col("team_id")),
            }
        )
        .select(*RESULT_COLUMNS)
    )


def clubs_of(matches: DataFrame) -> DataFrame:
    """Distinct clubs appearing on either side, per competition and season."""
    teams = F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")
    return (
        matches.select("competition_code", "season_id", teams)
        .filter(F.col("team_id").isNotNull())
        .distinct()
    )
