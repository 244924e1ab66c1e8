"""Explicit schemas: raw documents, processed tables and the run-event log.

Raw JSON is never inferred. A field absent from a document reads as NULL and is
reported by the data contracts instead of failing the scan.
"""

from __future__ import annotations

# --- raw documents -------------------------------------------------------------

TEAMS_DOCUMENT = """
  teams array<struct<
    id: bigint, name: string, shortName: string, tla: string,
    area: struct<name: string>,
    venue: string, founded: int, clubColors: string, crest: string>>
"""

MATCHES_DOCUMENT = """
  matches array<struct<
    id: bigint,
    competition: struct<id: bigint>,
    season: struct<id: bigint>,
    matchday: int, stage: string, utcDate: string, status: string,
    homeTeam: struct<id: bigint>,
    awayTeam: struct<id: bigint>,
    score: struct<winner: string, fullTime: struct<home: int, away: int>>,
    lastUpdated: string>>
"""

STANDINGS_DOCUMENT = """
  competition struct<id: bigint>,
  season struct<id: bigint, currentMatchday: int>,
  standings array<struct<
    type: string,
    table: array<struct<
      team: struct<id: bigint>,
      position: int, playedGames: int, form: string,
      won: int, draw: int, lost: int, points: int,
      goalsFor: int, goalsAgainst: int, goalDifference: int>>>>
"""

REFERENCE_DOCUMENT = """
  competition_code string, source_snapshot_date string, refreshed_at string,
  team_count int, badge_count int,
  teams array<struct<
    football_data_team_id: string, football_data_team_name: string,
    sportsdb_team_id: string, sportsdb_team_name: string,
    sportsdb_badge_url: string, sportsdb_source: string,
    sportsdb_resolution_method: string, sportsdb_fetched_at: string>>
"""

DOCUMENTS = {
    "teams": TEAMS_DOCUMENT,
    "matches": MATCHES_DOCUMENT,
    "standings": STANDINGS_DOCUMENT,
}

# --- processed tables ----------------------------------------------------------

DIM_TEAM = """
  team_id bigint, team_name string, short_name string, tla string, country string,
  venue_name string, founded int, club_colors string, crest_url string,
  sportsdb_team_id string, sportsdb_team_name string, sportsdb_badge_url string,
  sportsdb_source string, sportsdb_resolution_method string,
  sportsdb_fetched_at timestamp, competition_code string, loaded_at timestamp
"""

FACT_MATCH = """
  match_id bigint, competition_id bigint, competition_code string, season_id bigint,
  matchday int, stage string, utc_date timestamp, status string,
  home_team_id bigint, away_team_id bigint, home_score int, away_score int,
  result string, source_last_updated timestamp, source_snapshot_date string,
  loaded_at timestamp
"""

FACT_STANDING_SNAPSHOT = """
  competition_id bigint, competition_code string, season_id bigint,
  snapshot_matchday int, snapshot_date string, team_id bigint,
  position int, played int, won int, drawn int, lost int,
  goals_for int, goals_against int, goal_difference int, points int,
  form string, loaded_at timestamp
"""

RUN_EVENT = """
  run_id string, event_id bigint, event_ts timestamp, event string,
  competition_code string, stage string, error_message string
"""

MANIFEST = "version string, folder string, published_at timestamp"


def column_names(ddl: str) -> list[str]:
    """Column names of a flat DDL schema, in order."""
    return [part.split()[0] for part in ddl.replace("\n", " ").split(",")]
