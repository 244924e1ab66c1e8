"""Match explorer and match-level reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.clock import kickoff_label
from touchline.functions.numbers import count_where, percentage
from touchline.functions.outcomes import (
    FINISHED,
    LIVE_STATUSES,
    UPCOMING_STATUSES,
    match_state,
    scoreline,
)
from touchline.operators import LEAGUE
from touchline.operators.standings import first_n


def _club_columns(teams: DataFrame, side: str) -> DataFrame:
    """The club dimension in one role. Spark broadcasts it below its size threshold and
    shuffles (with skew splitting) above it."""
    return teams.select(
        "competition_code",
        F.col("team_id").alias(f"{side}_team_id"),
        F.col("team_name").alias(f"{side}_team_name"),
        F.col("short_name").alias(f"{side}_team"),
        F.col("tla").alias(f"{side}_tla"),
        F.col("sportsdb_badge_url").alias(f"{side}_badge_url"),
    )


def with_clubs(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Matches with home and away club columns (inner on both sides)."""
    for side in ("home", "away"):
        matches = matches.join(
            _club_columns(teams, side), ["competition_code", f"{side}_team_id"]
        )
    return matches


def match_explorer(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """One row per match with both clubs, score text and match state."""
    status = F.col("status")
    return with_clubs(matches, teams).select(
        "match_id", "competition_id", *LEAGUE, "matchday", "stage", "utc_date", "status",
        "home_team_id", "home_team_name", "home_team", "home_tla", "home_badge_url",
        "away_team_id", "away_team_name", "away_team", "away_tla", "away_badge_url",
        "home_score", "away_score", "result",
        scoreline(status, F.col("home_score"), F.col("away_score")).alias("scoreline"),
        match_state(status).alias("match_state"),
        "source_last_updated", "source_snapshot_date", "loaded_at",
    )


def explorer_order(explorer: DataFrame) -> DataFrame:
    """Full match list by time, then round."""
    return explorer.orderBy(
        F.col("utc_date").asc_nulls_last(), F.col("matchday").asc_nulls_last(), "match_id"
    )


def filter_matches(
    explorer: DataFrame,
    competition: str | None = None,
    season: int | None = None,
    matchday: int | None = None,
    club: str | None = None,
    state: str | None = None,
) -> DataFrame:
    """Explorer rows under optional choices; a club matches on either side."""
    choices: list[Column] = []
    if competition is not None:
        choices.append(F.col("competition_code") == competition)
    if season is not None:
        choices.append(F.col("season_id") == season)
    if matchday is not None:
        choices.append(F.col("matchday") == matchday)
    if club is not None:
        choices.append((F.col("home_team") == club) | (F.col("away_team") == club))
    if state is not None:
        choices.append(F.col("match_state") == state)
    for choice in choices:
        explorer = explorer.filter(choice)
    return explorer


def of_named_club(matches: DataFrame, teams: DataFrame, club: str) -> DataFrame:
    """Matches of the clubs with a short name, on either side, picked by id from the club table, so
    that only these meet the club columns. A competition's few clubs of that name are the small side."""
    named = teams.filter(F.col("short_name") == club).select(
        F.col("competition_code").alias("code"), F.col("team_id").alias("club_id")
    )
    plays = (F.col("home_team_id") == F.col("club_id")) | (F.col("away_team_id") == F.col("club_id"))
    return matches.join(named, (F.col("competition_code") == F.col("code")) & plays, "left_semi")


def fixtures_of(explorer: DataFrame, team_id: int) -> DataFrame:
    """All matches of one club, home or away."""
    return explorer.filter((F.col("home_team_id") == team_id) | (F.col("away_team_id") == team_id))


def recent_matches(matches: DataFrame, teams: DataFrame, limit: int = 8) -> DataFrame:
    """Each league's newest finished matches, picked before the club names are joined."""
    finished = matches.filter(F.col("status") == FINISHED)
    order = [F.col("utc_date").desc_nulls_last(), F.col("match_id").desc()]
    return (
        with_clubs(first_n(finished, LEAGUE, order, limit, "row_no"), teams)
        .select(
            *LEAGUE, "match_id", "matchday", "utc_date", "home_team", "home_badge_url",
            "away_team", "away_badge_url", "home_score", "away_score",
        )
        .orderBy(*LEAGUE, *order)
    )


def upcoming_matches(matches: DataFrame, teams: DataFrame, limit: int = 8) -> DataFrame:
    """Each league's next scheduled matches."""
    scheduled = matches.filter(F.col("status").isin(UPCOMING_STATUSES))
    order = [F.col("utc_date").asc_nulls_last(), F.col("match_id")]
    return (
        with_clubs(first_n(scheduled, LEAGUE, order, limit, "row_no"), teams)
        .select(
            *LEAGUE, "match_id", "matchday", "utc_date", "home_team", "home_badge_url",
            "away_team", "away_badge_url", "status",
        )
        .orderBy(*LEAGUE, *order)
    )


def status_summary(matches: DataFrame) -> DataFrame:
    """Matches per source status, most frequent first."""
    return (
        matches.groupBy("status")
        .agg(F.count(F.lit(1)).alias("match_count"))
        .orderBy(F.col("match_count").desc(), "status")
    )


def state_summary(explorer: DataFrame) -> DataFrame:
    """Matches per league and match state."""
    return explorer.groupBy(*LEAGUE, "match_state").agg(F.count(F.lit(1)).alias("matches"))


def match_kpis(matches: DataFrame) -> DataFrame:
    """Totals per league by kind of status, in one pass; the rest is "other"."""
    status = F.col("status")
    total = F.count(F.lit(1))
    finished = count_where(status == FINISHED)
    live = count_where(status.isin(LIVE_STATUSES))
    upcoming = count_where(status.isin(UPCOMING_STATUSES))
    return matches.groupBy(*LEAGUE).agg(
        total.alias("total_matches"),
        finished.alias("finished_matches"),
        live.alias("live_matches"),
        upcoming.alias("upcoming_matches"),
        (total - finished - live - upcoming).alias("other_matches"),
    )


def season_completion(matches: DataFrame) -> DataFrame:
    """Finished, upcoming and total matches and the share finished, per league."""
    kpis = match_kpis(matches)
    return kpis.select(
        *LEAGUE, "finished_matches", "upcoming_matches", "total_matches",
        percentage(F.col("finished_matches"), F.col("total_matches")).alias("completion_rate"),
    )


def kickoff_labels(explorer: DataFrame) -> DataFrame:
    """Local kick-off text of every match."""
    return explorer.select(
        *LEAGUE, "match_id", "home_team", "away_team",
        kickoff_label(F.col("utc_date")).alias("kickoff"),
        kickoff_label(F.col("utc_date"), year=False).alias("kickoff_short"),
    )
