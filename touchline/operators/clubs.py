"""Club views for all clubs at once: form, fixtures, season strip, record, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.clock import kickoff_label, local_date
from touchline.functions.numbers import fixed, record, signed
from touchline.functions.outcomes import (
    FINISHED,
    UPCOMING_STATUSES,
    match_state,
    score_result,
    scoreline,
)
from touchline.functions.text import MISSING_TEXT, text_or
from touchline.operators import LEAGUE
from touchline.operators.matches import with_clubs
from touchline.operators.participants import both_sides
from touchline.operators.standings import first_n

CLUB = [*LEAGUE, "team_id"]


def _names(teams: DataFrame, team_column: str, name: str) -> DataFrame:
    return teams.select(
        "competition_code", F.col("team_id").alias(team_column), F.col("short_name").alias(name)
    )


def with_club_names(rows: DataFrame, teams: DataFrame) -> DataFrame:
    """Add ``club`` and ``opponent`` short names to participant rows."""
    return rows.join(
        _names(teams, "team_id", "club"), ["competition_code", "team_id"]
    ).join(
        _names(teams, "opponent_team_id", "opponent"), ["competition_code", "opponent_team_id"]
    )


def _venue() -> Column:
    return F.when(F.col("venue") == "HOME", F.lit("Home")).otherwise(F.lit("Away"))


def _newest_first() -> list[Column]:
    return [F.col("utc_date").desc_nulls_last(), F.col("match_id").desc()]


def form_matches(matches: DataFrame, teams: DataFrame, n: int = 5) -> DataFrame:
    """Last n finished matches of every club, numbered oldest to newest for display.

    The n newest rows per club are kept before club names are joined.
    """
    finished = both_sides(matches.filter(F.col("status") == FINISHED)).select(
        *CLUB, "opponent_team_id", "venue", "matchday", "utc_date", "match_id",
        "goals_for", "goals_against",
    )
    newest = first_n(finished, CLUB, _newest_first(), n, "recency")
    return with_club_names(newest, teams).select(
        *CLUB, "club", "recency", "match_id", "matchday",
        score_result(F.col("goals_for"), F.col("goals_against")).alias("result"),
        F.concat(
            F.col("goals_for").cast("string"), F.lit("–"), F.col("goals_against").cast("string")
        ).alias("score"),
        "opponent",
        F.concat(_venue(), F.lit(" • MD"), F.col("matchday").cast("string")).alias("context"),
    )


def form_strip(form: DataFrame) -> DataFrame:
    """One line per club, oldest to newest, e.g. ``W D L W W`` (at most n items per club)."""
    items = F.sort_array(
        F.collect_list(F.struct((-F.col("recency")).alias("age"), text_or(F.col("result"), "?").alias("r")))
    )
    return form.groupBy(*CLUB, "club").agg(
        F.concat_ws(" ", F.transform(items, lambda i: i["r"])).alias("form"),
        F.count(F.lit(1)).alias("matches"),
    )


def _match_line(rows: DataFrame, teams: DataFrame) -> DataFrame:
    """Participant rows with home and away names in display order."""
    named = with_club_names(rows, teams)
    home = F.when(F.col("venue") == "HOME", F.col("club")).otherwise(F.col("opponent"))
    away = F.when(F.col("venue") == "HOME", F.col("opponent")).otherwise(F.col("club"))
    return named.withColumn("home_team", home).withColumn("away_team", away)


def recent_fixtures(matches: DataFrame, teams: DataFrame, n: int = 8) -> DataFrame:
    """Last n finished matches of every club with local date, score and result."""
    finished = both_sides(matches.filter(F.col("status") == FINISHED)).select(
        *CLUB, "opponent_team_id", "venue", "matchday", "utc_date", "match_id", "status",
        "home_score", "away_score", "goals_for", "goals_against",
    )
    newest = first_n(finished, CLUB, _newest_first(), n, "row_no")
    return _match_line(newest, teams).select(
        *CLUB, "club", "row_no", "match_id", "matchday",
        local_date(F.col("utc_date")).alias("date"),
        "home_team",
        scoreline(F.col("status"), F.col("home_score"), F.col("away_score")).alias("score"),
        "away_team",
        score_result(F.col("goals_for"), F.col("goals_against")).alias("result"),
    )


def upcoming_fixtures(matches: DataFrame, teams: DataFrame, n: int = 5) -> DataFrame:
    """Next n scheduled matches of every club with the local kick-off."""
    scheduled = both_sides(matches.filter(F.col("status").isin(UPCOMING_STATUSES))).select(
        *CLUB, "opponent_team_id", "venue", "matchday", "utc_date", "match_id", "status"
    )
    order = [F.col("utc_date").asc_nulls_last(), F.col("match_id")]
    return _match_line(first_n(scheduled, CLUB, order, n, "row_no"), teams).select(
        *CLUB, "club", "row_no", "match_id", "matchday",
        kickoff_label(F.col("utc_date")).alias("date"),
        "home_team", "away_team", "status",
    )


def season_strip(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Every match of every club: opponent, venue, W/D/L/Upcoming and score."""
    rows = both_sides(
        matches.select(
            *LEAGUE, "match_id", "matchday", "utc_date", "status", "home_team_id", "away_team_id",
            "home_score", "away_score",
        )
    )
    status = F.col("status")
    finished = match_state(status) == "Finished"
    return with_club_names(rows, teams).select(
        *CLUB, "club", "match_id", "matchday", "utc_date", "opponent",
        _venue().alias("venue"),
        F.when(finished, score_result(F.col("goals_for"), F.col("goals_against")))
        .otherwise(F.lit("Upcoming"))
        .alias("result"),
        F.when(finished, scoreline(status, F.col("home_score"), F.col("away_score")))
        .otherwise(F.lit(MISSING_TEXT))
        .alias("score"),
    )


def strip_of(strip: DataFrame, club: str) -> DataFrame:
    """One club's strip in playing order."""
    return strip.filter(F.col("club") == club).orderBy(
        *LEAGUE, F.col("matchday").asc_nulls_last(), F.col("utc_date").asc_nulls_last(), "match_id"
    )


def club_record(current: DataFrame, performance: DataFrame) -> DataFrame:
    """Official table row of every club next to its derived measures, which may be missing."""
    derived = performance.select(
        *CLUB,
        F.col("played").alias("derived_played"),
        F.col("points_per_game").alias("points_per_game"),
        F.col("goal_difference").alias("derived_goal_difference"),
        F.col("won").alias("derived_won"),
        F.col("drawn").alias("derived_drawn"),
        F.col("lost").alias("derived_lost"),
        "goals_for_per_game",
        "goals_against_per_game",
    )
    return current.join(derived, CLUB, "left").select(
        *CLUB, "team_name", "short_name", "tla", "position", "played", "points", "is_reconciled",
        "derived_played",
        text_or(fixed(F.col("points_per_game"), 2), "N/A").alias("ppg_text"),
        text_or(signed(F.col("derived_goal_difference")), "N/A").alias("goal_difference_text"),
        record(F.col("derived_won"), F.col("derived_drawn"), F.col("derived_lost")).alias("wdl"),
        fixed(F.col("goals_for_per_game"), 2).alias("goals_per_match_text"),
        fixed(F.col("goals_against_per_game"), 2).alias("conceded_per_match_text"),
    )


def club_options(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Distinct club names on either side of a match, sorted, per league.

    Matches collapse to distinct pairings before the names are joined.
    """
    pairings = matches.select(*LEAGUE, "home_team_id", "away_team_id").distinct()
    names = F.explode(F.array("home_team", "away_team")).alias("club")
    return (
        with_clubs(pairings, teams)
        .select(*LEAGUE, names)
        .filter(F.col("club").isNotNull())
        .distinct()
        .orderBy(*LEAGUE, "club")
    )


def official_vs_derived(current: DataFrame, performance: DataFrame) -> DataFrame:
    """Official and derived totals as metric rows with their difference, per club."""
    measures = {
        "Played": "played",
        "Points": "points",
        "Goals For": "goals_for",
        "Goals Against": "goals_against",
    }
    derived = performance.select(
        *CLUB, *[F.col(c).alias(f"derived_{c}") for c in measures.values()]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(label).alias("metric"),
                F.col(c).cast("bigint").alias("official_standings"),
                F.col(f"derived_{c}").cast("bigint").alias("finished_matches"),
            )
            for label, c in measures.items()
        ]
    )
    return (
        current.join(derived, CLUB)
        .select(*CLUB, "short_name", F.explode(lines).alias("line"))
        .select(*CLUB, "short_name", "line.*")
        .withColumn("difference", F.col("official_standings") - F.col("finished_matches"))
    )
