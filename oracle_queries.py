"""Reference answers in SQL over the generic test tables (see FIXTURES.md).

Written independently of the Spark operators and in the direct form: two-branch unions
instead of one exploded scan, range joins instead of running windows, NOT EXISTS instead of
a completed prefix, scalar comparisons instead of dictionaries.
"""

from __future__ import annotations

LOADED = "TIMESTAMP '2001-07-01 06:00:00'"

TABLES = f"""
WITH stg_matches0 AS (
  SELECT o_orderkey AS match_id,
    o_custkey % 3 AS competition_id,
    'L' || CAST(o_custkey % 3 AS VARCHAR) AS competition_code,
    CAST(year(o_orderdate) AS BIGINT) AS season_id,
    CAST(floor((dayofyear(o_orderdate) - 1) / 10) AS INTEGER) + 1 AS matchday,
    'REGULAR_SEASON' AS stage,
    o_orderdate AS utc_date,
    CASE WHEN o_orderdate < TIMESTAMP '2001-06-01' THEN 'FINISHED'
         WHEN o_orderdate < TIMESTAMP '2001-06-21' THEN
           CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'IN_PLAY' ELSE 'POSTPONED' END
         WHEN o_orderstatus = 'F' THEN 'SCHEDULED' ELSE 'TIMED' END AS status,
    o_custkey % 25 AS home_team_id,
    (o_custkey % 25 + 1 + o_orderkey % 24) % 25 AS away_team_id,
    CAST(floor(o_totalprice) AS BIGINT) % 5 AS hs,
    (o_orderkey * 7 + o_custkey) % 4 AS aws
  FROM orders
), stg_matches AS (
  SELECT match_id, competition_id, competition_code, season_id, matchday, stage, utc_date, status,
    home_team_id, away_team_id,
    CASE WHEN status IN ('FINISHED', 'IN_PLAY') THEN CAST(hs AS INTEGER) END AS home_score,
    CASE WHEN status IN ('FINISHED', 'IN_PLAY') THEN CAST(aws AS INTEGER) END AS away_score,
    CASE WHEN status = 'FINISHED' AND match_id % 997 <> 0 THEN
      CASE WHEN hs > aws THEN 'H' WHEN hs < aws THEN 'A' ELSE 'D' END END AS result,
    utc_date AS source_last_updated,
    '2001-07-01' AS source_snapshot_date,
    {LOADED} AS loaded_at
  FROM stg_matches0
), stg_teams AS (
  SELECT CAST(n_nationkey AS BIGINT) AS team_id,
    n_name AS team_name,
    'Nation ' || CAST(n_nationkey AS VARCHAR) AS short_name,
    'T' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS tla,
    r_name AS country,
    n_name || ' Arena' AS venue_name,
    CAST(n_nationkey + 1900 AS INTEGER) AS founded,
    'Red / White' AS club_colors,
    'https://crests.example/' || CAST(n_nationkey AS VARCHAR) || '.png' AS crest_url,
    CAST(n_nationkey + 133700 AS VARCHAR) AS sportsdb_team_id,
    upper(left(n_name, 1)) || lower(substr(n_name, 2)) AS sportsdb_team_name,
    'https://badges.example/' || CAST(n_nationkey + 133700 AS VARCHAR) || '.png' AS sportsdb_badge_url,
    'TheSportsDB' AS sportsdb_source,
    CASE WHEN n_nationkey < 20 THEN 'ID_OVERRIDE' ELSE 'NAME_SEARCH' END AS sportsdb_resolution_method,
    {LOADED} AS sportsdb_fetched_at,
    l.competition_code,
    {LOADED} AS loaded_at
  FROM nation JOIN region ON n_regionkey = r_regionkey
  CROSS JOIN (VALUES ('L0'), ('L1'), ('L2')) l(competition_code)
), sides(venue) AS (VALUES ('HOME'), ('AWAY')
), verdicts(venue, result, team_result, points_earned) AS (
  VALUES ('HOME', 'H', 'W', 3), ('HOME', 'D', 'D', 1), ('HOME', 'A', 'L', 0),
    ('AWAY', 'A', 'W', 3), ('AWAY', 'D', 'D', 1), ('AWAY', 'H', 'L', 0)
), appearances AS (
  SELECT m.*, venue, if(venue = 'HOME', home_team_id, away_team_id) AS team_id,
    home_team_id + away_team_id - if(venue = 'HOME', home_team_id, away_team_id) AS opponent_team_id,
    if(venue = 'HOME', home_score, away_score) AS goals_for, if(venue = 'HOME', away_score, home_score) AS goals_against
  FROM stg_matches m CROSS JOIN sides WHERE status = 'FINISHED'
), int_team_match_results AS (
  SELECT concat_ws('-', match_id, team_id) AS team_match_key, match_id, competition_id, competition_code, season_id,
    matchday, utc_date, team_id, opponent_team_id, a.venue, goals_for, goals_against, v.team_result, v.points_earned,
    source_snapshot_date, loaded_at
  FROM appearances a LEFT JOIN verdicts v ON a.venue = v.venue AND a.result = v.result
), snapshot_dates AS (
  SELECT DISTINCT season_id,
    CASE WHEN season_id < 2001 THEN CAST(season_id AS VARCHAR) || '-12-31' ELSE '2001-05-31' END AS snapshot_date
  FROM stg_matches
  UNION ALL SELECT DISTINCT season_id, '2001-07-01' FROM stg_matches WHERE season_id >= 2001
), snapshot_totals AS (
  SELECT r.competition_id, r.competition_code, r.season_id, d.snapshot_date, r.team_id,
    CASE WHEN d.snapshot_date = '2001-07-01' AND r.team_id % 7 = 0 THEN 1 ELSE 0 END AS ahead,
    count(*) AS played,
    count(*) FILTER (WHERE team_result = 'W') AS won,
    count(*) FILTER (WHERE team_result = 'D') AS drawn,
    count(*) FILTER (WHERE team_result = 'L') AS lost,
    sum(goals_for) AS goals_for,
    sum(goals_against) AS goals_against,
    sum(points_earned) AS points
  FROM int_team_match_results r
  JOIN snapshot_dates d ON d.season_id = r.season_id AND r.utc_date < CAST(d.snapshot_date AS TIMESTAMP)
  GROUP BY ALL
), stg_standings AS (
  SELECT competition_id, competition_code, season_id,
    CAST(floor((dayofyear(CAST(snapshot_date AS DATE)) - 1) / 10) AS INTEGER) + 1 AS snapshot_matchday,
    snapshot_date, team_id,
    CAST(rank() OVER (PARTITION BY competition_code, season_id, snapshot_date
      ORDER BY points + 3 * ahead DESC, goals_for + ahead - goals_against DESC, goals_for + ahead DESC)
      AS INTEGER) AS position,
    CAST(played + ahead AS INTEGER) AS played,
    CAST(won + ahead AS INTEGER) AS won,
    CAST(drawn AS INTEGER) AS drawn,
    CAST(lost AS INTEGER) AS lost,
    CAST(goals_for + ahead AS INTEGER) AS goals_for,
    CAST(goals_against AS INTEGER) AS goals_against,
    CAST(goals_for + ahead - goals_against AS INTEGER) AS goal_difference,
    CAST(points + 3 * ahead AS INTEGER) AS points,
    CAST(NULL AS VARCHAR) AS form,
    {LOADED} AS loaded_at
  FROM snapshot_totals
), latest AS (
  SELECT s.* FROM stg_standings s
  WHERE snapshot_date = (SELECT max(x.snapshot_date) FROM stg_standings x
    WHERE x.competition_code = s.competition_code AND x.season_id = s.season_id)
), tallies AS (
  SELECT competition_code, season_id, team_id, count(*) AS matches, count(*) FILTER (WHERE team_result = 'W') AS wins,
    count(*) FILTER (WHERE team_result = 'D') AS draws, count(*) FILTER (WHERE team_result = 'L') AS losses,
    CAST(sum(points_earned) AS BIGINT) AS gained, CAST(sum(goals_for) AS BIGINT) AS scored,
    CAST(sum(goals_against) AS BIGINT) AS conceded
  FROM int_team_match_results GROUP BY competition_code, season_id, team_id
), compared AS (
  SELECT latest.*, coalesce(matches, 0) AS matches, coalesce(wins, 0) AS wins, coalesce(draws, 0) AS draws,
    coalesce(losses, 0) AS losses, coalesce(gained, 0) AS gained, coalesce(scored, 0) AS scored,
    coalesce(conceded, 0) AS conceded
  FROM latest LEFT JOIN tallies USING (competition_code, season_id, team_id)
), int_standings_reconciliation AS (
  SELECT competition_id, competition_code, season_id, snapshot_date, snapshot_matchday, team_id,
    played AS official_played, won AS official_won, drawn AS official_drawn, lost AS official_lost,
    points AS official_points, goals_for AS official_goals_for, goals_against AS official_goals_against,
    matches AS derived_played, wins AS derived_won, draws AS derived_drawn, losses AS derived_lost,
    gained AS derived_points, scored AS derived_goals_for, conceded AS derived_goals_against,
    played - matches AS played_delta, points - gained AS points_delta,
    goals_for - scored AS goals_for_delta, goals_against - conceded AS goals_against_delta,
    coalesce(played = matches AND points = gained AND goals_for = scored AND goals_against = conceded, false) AS is_reconciled
  FROM compared
), mart_current_standings AS (
  SELECT s.competition_code || '-' || CAST(s.season_id AS VARCHAR) || '-' || CAST(s.team_id AS VARCHAR)
      || '-' || s.snapshot_date AS standings_key,
    s.competition_id, s.competition_code, s.season_id, s.snapshot_date, s.snapshot_matchday, s.team_id,
    t.team_name, t.short_name, t.tla, t.sportsdb_badge_url,
    s.position, s.played, s.won, s.drawn, s.lost, s.goals_for, s.goals_against, s.goal_difference,
    s.points, s.form, r.is_reconciled, r.played_delta, r.points_delta, r.goals_for_delta, r.goals_against_delta
  FROM latest s
  JOIN stg_teams t ON s.competition_code = t.competition_code AND s.team_id = t.team_id
  LEFT JOIN int_standings_reconciliation r ON s.competition_code = r.competition_code
    AND s.season_id = r.season_id AND s.team_id = r.team_id AND s.snapshot_date = r.snapshot_date
), performance0 AS (
  SELECT competition_id, competition_code, season_id, team_id, count(*) AS played,
    count(*) FILTER (WHERE team_result = 'W') AS won, count(*) FILTER (WHERE team_result = 'D') AS drawn,
    count(*) FILTER (WHERE team_result = 'L') AS lost, CAST(sum(points_earned) AS BIGINT) AS points,
    CAST(sum(goals_for) AS BIGINT) AS goals_for, CAST(sum(goals_against) AS BIGINT) AS goals_against,
    CAST(sum(goals_for) - sum(goals_against) AS BIGINT) AS goal_difference,
    round(CAST(sum(points_earned) AS DOUBLE) / count(*), 3) AS points_per_game,
    round(CAST(sum(goals_for) AS DOUBLE) / count(goals_for), 3) AS goals_for_per_game,
    round(CAST(sum(goals_against) AS DOUBLE) / count(goals_against), 3) AS goals_against_per_game,
    count(*) FILTER (WHERE venue = 'HOME') AS home_played, count(*) FILTER (WHERE venue = 'AWAY') AS away_played,
    CAST(coalesce(sum(points_earned) FILTER (WHERE venue = 'HOME'), 0) AS BIGINT) AS home_points,
    CAST(coalesce(sum(points_earned) FILTER (WHERE venue = 'AWAY'), 0) AS BIGINT) AS away_points
  FROM int_team_match_results GROUP BY competition_id, competition_code, season_id, team_id
), mart_team_performance AS (
  SELECT a.competition_code || '-' || CAST(a.season_id AS VARCHAR) || '-' || CAST(a.team_id AS VARCHAR)
      AS team_performance_key,
    a.competition_id, a.competition_code, a.season_id, a.team_id, t.team_name, t.short_name, t.tla,
    a.played, a.won, a.drawn, a.lost, a.points, a.goals_for, a.goals_against, a.goal_difference,
    a.points_per_game, a.goals_for_per_game, a.goals_against_per_game,
    a.home_played, a.home_points, a.away_played, a.away_points
  FROM performance0 a JOIN stg_teams t
    ON a.team_id = t.team_id AND a.competition_code = t.competition_code
), mart_match_explorer AS (
  SELECT m.match_id, m.competition_id, m.competition_code, m.season_id, m.matchday, m.stage, m.utc_date, m.status,
    m.home_team_id, h.team_name AS home_team_name, h.short_name AS home_team, h.tla AS home_tla,
    h.sportsdb_badge_url AS home_badge_url,
    m.away_team_id, a.team_name AS away_team_name, a.short_name AS away_team, a.tla AS away_tla,
    a.sportsdb_badge_url AS away_badge_url,
    m.home_score, m.away_score, m.result,
    CASE WHEN m.status = 'FINISHED'
        THEN CAST(m.home_score AS VARCHAR) || ' – ' || CAST(m.away_score AS VARCHAR)
      WHEN m.status IN ('IN_PLAY', 'PAUSED') AND m.home_score IS NOT NULL AND m.away_score IS NOT NULL
        THEN CAST(m.home_score AS VARCHAR) || ' – ' || CAST(m.away_score AS VARCHAR)
      ELSE '–' END AS scoreline,
    CASE WHEN m.status = 'FINISHED' THEN 'Finished' WHEN m.status IN ('IN_PLAY', 'PAUSED') THEN 'Live'
      WHEN m.status IN ('TIMED', 'SCHEDULED') THEN 'Upcoming' ELSE 'Other' END AS match_state,
    m.source_last_updated, m.source_snapshot_date, m.loaded_at
  FROM stg_matches m
  JOIN stg_teams h ON m.home_team_id = h.team_id AND m.competition_code = h.competition_code
  JOIN stg_teams a ON m.away_team_id = a.team_id AND m.competition_code = a.competition_code
), matchday_status AS (
  SELECT competition_code, season_id, matchday, count(*) AS total_matches,
    CAST(sum(CASE WHEN status = 'FINISHED' THEN 1 ELSE 0 END) AS BIGINT) AS finished_matches
  FROM stg_matches WHERE matchday IS NOT NULL GROUP BY ALL
), completed_matchdays AS (
  SELECT * EXCLUDE (barrier) FROM (
    SELECT *, min(matchday) FILTER (finished_matches < total_matches)
      OVER (PARTITION BY competition_code, season_id) AS barrier FROM matchday_status)
  WHERE barrier IS NULL OR matchday < barrier
), round_totals AS (
  SELECT competition_code, season_id, team_id, matchday, count(*) AS n, sum(points_earned) AS pts,
    sum(goals_for) AS f, sum(goals_against) AS a FROM int_team_match_results GROUP BY ALL
), cumulative AS (
  SELECT competition_code, season_id, matchday, team_id, short_name, tla, sportsdb_badge_url,
    CAST(coalesce(sum(n) OVER so_far, 0) AS BIGINT) AS played,
    CAST(coalesce(sum(pts) OVER so_far, 0) AS BIGINT) AS points,
    CAST(coalesce(sum(f) OVER so_far, 0) AS BIGINT) AS goals_for,
    CAST(coalesce(sum(a) OVER so_far, 0) AS BIGINT) AS goals_against
  FROM completed_matchdays
  JOIN mart_current_standings USING (competition_code, season_id)
  LEFT JOIN round_totals USING (competition_code, season_id, team_id, matchday)
  WINDOW so_far AS (PARTITION BY competition_code, season_id, team_id ORDER BY matchday)
), position_history AS (
  SELECT competition_code, season_id, matchday, team_id, short_name, tla, sportsdb_badge_url,
    CAST(rank() OVER (PARTITION BY competition_code, season_id, matchday
      ORDER BY points DESC, goals_for - goals_against DESC, goals_for DESC) AS INTEGER) AS derived_position,
    played, points, goals_for, goals_against, goals_for - goals_against AS goal_difference
  FROM cumulative
), races AS (
  SELECT * FROM (VALUES ('Title Race', 1, 4), ('European Race', 4, 8), ('Relegation Battle', 16, 20))
    p(race, first_position, last_position)
), race_history AS (
  SELECT h.competition_code, h.season_id, p.race, h.matchday, h.team_id, h.short_name, h.derived_position,
    h.played, h.points, h.goals_for, h.goals_against, h.goal_difference
  FROM position_history h
  JOIN mart_current_standings s ON s.competition_code = h.competition_code AND s.season_id = h.season_id
    AND s.team_id = h.team_id
  JOIN races p ON s.position BETWEEN p.first_position AND p.last_position
), club_rows AS (
  SELECT competition_code, season_id, match_id, matchday, utc_date, status, match_state, scoreline,
    home_team, away_team, home_team_id AS team_id, home_team AS club, away_team AS opponent, 'Home' AS venue,
    home_score AS gf, away_score AS ga
  FROM mart_match_explorer
  UNION ALL
  SELECT competition_code, season_id, match_id, matchday, utc_date, status, match_state, scoreline,
    home_team, away_team, away_team_id, away_team, home_team, 'Away', away_score, home_score
  FROM mart_match_explorer
), club_results AS (
  SELECT *, CASE WHEN gf > ga THEN 'W' WHEN gf < ga THEN 'L' WHEN gf = ga THEN 'D' END AS wdl FROM club_rows
), finished_rows AS (
  SELECT *, row_number() OVER (PARTITION BY competition_code, season_id, team_id
    ORDER BY utc_date DESC, match_id DESC) AS n
  FROM club_results WHERE match_state = 'Finished'
), state_rounds AS (
  SELECT competition_code, season_id, matchday,
    bool_or(match_state = 'Live') AS live, bool_or(match_state = 'Finished') AS finished,
    bool_or(match_state = 'Upcoming') AS upcoming,
    CAST(row_number() OVER (PARTITION BY competition_code, season_id ORDER BY matchday) AS INTEGER) AS i,
    count(*) OVER (PARTITION BY competition_code, season_id) AS n
  FROM mart_match_explorer WHERE matchday IS NOT NULL GROUP BY competition_code, season_id, matchday
), default_rounds AS (
  SELECT competition_code, season_id,
    coalesce(min(matchday) FILTER (WHERE live), max(matchday) FILTER (WHERE finished),
      min(matchday) FILTER (WHERE upcoming)) AS default_matchday
  FROM state_rounds GROUP BY ALL
)
"""

LOCAL = "timezone('Europe/Madrid', utc_date AT TIME ZONE 'UTC')"
ZONE = (
    f"CASE WHEN date_diff('minute', utc_date, {LOCAL}) = 120 THEN 'CEST' "
    f"WHEN date_diff('minute', utc_date, {LOCAL}) = 60 THEN 'CET' END"
)

RUNS = """
WITH ev AS (
  SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS run_id, event_id, ts,
    CASE event_type WHEN 'signup' THEN 'START' WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED'
      ELSE 'STAGE' END AS event,
    'L' || CAST(user_id % 3 AS VARCHAR) AS competition_code,
    CASE event_id % 4 WHEN 0 THEN 'API_INGESTION' WHEN 1 THEN 'TRANSFORMATION' WHEN 2 THEN 'WAREHOUSE_LOAD'
      ELSE 'DBT_BUILD' END AS stage,
    'stage failed at event ' || CAST(event_id AS VARCHAR) AS message
  FROM events
), starts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS n
    FROM ev WHERE event = 'START') WHERE n = 1
), later AS (
  SELECT e.*, s.ts AS started_at FROM ev e JOIN starts s ON e.run_id = s.run_id
  WHERE e.event <> 'START' AND (e.ts > s.ts OR (e.ts = s.ts AND e.event_id > s.event_id))
), steps AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, event_id DESC) AS n
    FROM later) WHERE n = 1
), ends AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, event_id DESC) AS n
    FROM later WHERE event IN ('SUCCESS', 'FAILED')) WHERE n = 1
), fails AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, event_id DESC) AS n
    FROM later WHERE event = 'FAILED') WHERE n = 1
), runs AS (
  SELECT s.run_id, s.competition_code, s.ts AS started_at, e.ts AS finished_at,
    coalesce(e.event, 'RUNNING') AS status,
    CASE WHEN p.event IS NULL THEN 'STARTING' WHEN p.event = 'SUCCESS' THEN 'COMPLETE'
      WHEN p.event = 'FAILED' THEN 'FAILED' ELSE p.stage END AS current_stage,
    f.stage AS failed_stage,
    date_diff('microsecond', s.ts, e.ts) / 1000000.0::DOUBLE AS duration_seconds,
    f.message AS error_message
  FROM starts s
  LEFT JOIN steps p ON s.run_id = p.run_id
  LEFT JOIN ends e ON s.run_id = e.run_id
  LEFT JOIN fails f ON s.run_id = f.run_id
)
"""

RESOLUTION = """
WITH clubs AS (
  SELECT l.competition_code, CAST(n_nationkey AS BIGINT) AS team_id, n_name AS team_name, r_name AS preferred,
    n_name AS search_name
  FROM nation n JOIN region ON n_regionkey = r_regionkey
  CROSS JOIN (VALUES ('L0'), ('L1'), ('L2')) l(competition_code)
), candidates AS (
  SELECT s_suppkey AS no, CAST(s_suppkey AS VARCHAR) AS id,
    upper(left(n_name, 1)) || lower(substr(n_name, 2)) AS name,
    CASE WHEN s_suppkey % 5 = 0 THEN 'Rugby' ELSE 'Soccer' END AS sport,
    r_name AS country,
    CASE WHEN s_suppkey % 11 <> 0 THEN 'https://badges.example/' || CAST(s_suppkey AS VARCHAR) END AS badge
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON r_regionkey = CASE WHEN s_suppkey % 2 = 0 THEN n_regionkey ELSE s_suppkey % 5 END
), overrides AS (
  SELECT s_suppkey // 3 AS team_id, CAST(s_suppkey AS VARCHAR) AS known_id
  FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey < 30
), picked AS (
  SELECT c.competition_code, c.team_id, c.team_name, o.known_id,
    coalesce((SELECT k.no FROM candidates k WHERE k.id = o.known_id),
      CASE WHEN o.known_id IS NULL THEN coalesce(
        (SELECT min(k.no) FROM candidates k WHERE lower(k.name) = lower(c.search_name) AND k.sport = 'Soccer'
          AND lower(k.country) = lower(c.preferred)),
        (SELECT min(k.no) FROM candidates k WHERE lower(k.name) = lower(c.search_name) AND k.sport = 'Soccer'))
      END) AS no
  FROM clubs c LEFT JOIN overrides o ON c.team_id = o.team_id
), resolved AS (
  SELECT p.competition_code, p.team_id, p.team_name,
    CASE WHEN k.sport = 'Soccer' THEN k.id END AS sportsdb_team_id,
    CASE WHEN k.sport = 'Soccer' THEN k.name END AS sportsdb_team_name,
    CASE WHEN k.sport = 'Soccer' THEN k.badge END AS sportsdb_badge_url,
    'TheSportsDB' AS sportsdb_source,
    CASE WHEN p.known_id IS NOT NULL THEN 'ID_OVERRIDE' ELSE 'NAME_SEARCH' END AS sportsdb_resolution_method,
    CASE WHEN k.no IS NULL THEN 'NOT_FOUND' WHEN k.sport <> 'Soccer' THEN 'REJECTED_SPORT'
      WHEN k.badge IS NULL THEN 'NO_BADGE' ELSE 'RESOLVED' END AS status
  FROM picked p LEFT JOIN candidates k ON p.no = k.no
)
"""

ALIASED_RESOLUTION = RESOLUTION.replace(
    "n_name AS search_name",
    """coalesce((SELECT x.n_name FROM nation x
      WHERE n.n_nationkey % 5 = 4 AND x.n_nationkey = n.n_nationkey - 1), n_name) AS search_name""",
)

LEAGUE_ORDER = "competition_code, season_id"


def _rows(table: str) -> str:
    return f"{TABLES} SELECT * FROM {table}"


# The 62 declared checks, one table a line, independent of the library's rule lists.
NOT_NULL = """
stg_teams: team_id team_name competition_code sportsdb_team_id sportsdb_badge_url sportsdb_source
stg_teams: sportsdb_resolution_method
stg_matches: match_id home_team_id away_team_id status
stg_standings: team_id position snapshot_date points
int_team_match_results: team_match_key match_id team_id opponent_team_id
int_standings_reconciliation: team_id snapshot_date is_reconciled
mart_current_standings: standings_key team_id position points snapshot_date is_reconciled
mart_team_performance: team_performance_key team_id played points points_per_game
mart_match_explorer: match_id matchday home_team_id away_team_id status
"""
UNIQUE = """
stg_teams: team_id within competition_code
stg_matches: match_id
int_team_match_results: team_match_key
int_standings_reconciliation: team_id within competition_code season_id
mart_current_standings: standings_key
mart_team_performance: team_performance_key
mart_match_explorer: match_id
"""
ACCEPTED = """
stg_teams: sportsdb_source TheSportsDB
stg_teams: sportsdb_resolution_method ID_OVERRIDE NAME_SEARCH
stg_matches: competition_code L0 L1
int_team_match_results: venue HOME AWAY
int_team_match_results: team_result W D L
int_team_match_results: points_earned 0 1 3
mart_match_explorer: match_state Finished Live Upcoming Other
"""
REFERENCES = """
stg_matches: home_team_id away_team_id
stg_standings: team_id
int_team_match_results: team_id opponent_team_id
int_standings_reconciliation: team_id
mart_current_standings: team_id
mart_team_performance: team_id
mart_match_explorer: home_team_id away_team_id
"""


def _listed(text: str) -> list[tuple[str, list[str]]]:
    lines = [line.split(": ") for line in text.strip().splitlines()]
    return [(model, words.split()) for model, words in lines]


def _check(model: str, column: str, rule: str, count: str, source: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{rule}' AS rule, "
        f"CAST({count} AS BIGINT) AS failures FROM {source}"
    )


def _twice(table: str, keys: str) -> str:
    return f"(SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1) d"


def _orphans(table: str, column: str) -> str:
    return (
        f"{table} c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_teams t "
        f"WHERE t.competition_code = c.competition_code AND t.team_id = c.{column})"
    )


def _checks(kind: str) -> str:
    parts = []
    if kind == "not_null":
        for model, columns in _listed(NOT_NULL):
            parts += [_check(model, c, kind, f"count(*) - count({c})", model) for c in columns]
    elif kind == "unique":
        for model, (column, *within) in _listed(UNIQUE):
            parts.append(_check(model, column, kind, "count(*)", _twice(model, ", ".join([*within[1:], column]))))
    elif kind == "accepted_values":
        for model, (column, *values) in _listed(ACCEPTED):
            known = ", ".join(map(repr, values))
            count = f"count(*) FILTER (WHERE CAST({column} AS VARCHAR) NOT IN ({known}))"
            parts.append(_check(model, column, kind, count, model))
    else:
        for model, columns in _listed(REFERENCES):
            parts += [_check(model, c, kind, "count(*)", _orphans(model, c)) for c in columns]
    return TABLES + " UNION ALL ".join(parts)


def _load_gate() -> str:
    base = {"dim_team": "stg_teams", "fact_match": "stg_matches", "fact_standing_snapshot": "stg_standings"}
    ids = {"dim_team": "team_id", "fact_match": "match_id", "fact_standing_snapshot": "team_id"}
    keys = {
        "dim_team": "competition_code, team_id",
        "fact_match": "match_id",
        "fact_standing_snapshot": "competition_code, season_id, snapshot_date, team_id",
    }
    parts = []
    for name, table in base.items():
        parts.append(_check(name, "*", "not_empty", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", table))
        parts.append(_check(name, ids[name], "not_null", f"count(*) - count({ids[name]})", table))
        parts.append(_check(name, ids[name], "unique", "count(*)", _twice(table, keys[name])))
        served = f"SELECT * FROM (VALUES ('L0'), ('L1'), ('L2'), ('L9')) v(c) EXCEPT SELECT competition_code FROM {table}"
        parts.append(_check(name, "competition_code", "covers", "count(*)", f"({served}) missing"))
    for column in ("home_team_id", "away_team_id"):
        parts.append(_check("fact_match", column, "relationships", "count(*)", _orphans("stg_matches", column)))
    parts.append(
        _check("fact_standing_snapshot", "team_id", "relationships", "count(*)", _orphans("stg_standings", "team_id"))
    )
    wrong = {
        "home_team_id <> away_team_id": ("fact_match", "home_team_id", "home_team_id = away_team_id"),
        "played = won + drawn + lost": ("fact_standing_snapshot", "played", "won + drawn + lost <> played"),
        "goal_difference = goals_for - goals_against": (
            "fact_standing_snapshot", "goal_difference", "goals_for - goals_against <> goal_difference",
        ),
    }
    for rule, (name, column, bad) in wrong.items():
        parts.append(_check(name, column, rule, f"count(*) FILTER (WHERE {bad})", base[name]))
    return TABLES + " UNION ALL ".join(parts)


CURRENT_CLUBS = """current_clubs AS (
  SELECT competition_code, home_team_id AS team_id FROM stg_matches
  UNION SELECT competition_code, away_team_id FROM stg_matches
)"""


def _reference_checks() -> str:
    reference = """reference AS (
      SELECT * REPLACE (CASE WHEN team_id = 3 THEN 99 ELSE team_id END AS team_id) FROM stg_teams)"""
    none = "CASE WHEN count({}) = 0 THEN 1 ELSE 0 END"
    present = [
        "team_id", "team_name", "sportsdb_team_id", "sportsdb_team_name", "sportsdb_badge_url", "sportsdb_source",
        "sportsdb_resolution_method", "sportsdb_fetched_at",
    ]
    parts = [
        _check("reference", "*", "not_empty", none.format("*"), "reference"),
        *[_check("reference", c, "present", none.format(c), "reference") for c in present],
        _check("reference", "team_id", "not_null", "count(*) - count(team_id)", "reference"),
        _check("reference", "team_id", "unique", "count(*)", _twice("reference", "competition_code, team_id")),
        _check(
            "reference", "competition_code", "accepted_values",
            "count(*) FILTER (WHERE competition_code NOT IN ('L0', 'L1'))", "reference",
        ),
    ]
    return f"{TABLES}, {reference} " + " UNION ALL ".join(parts)


def _source_checks() -> str:
    parts = [
        _check("clubs", "*", "not_empty", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "current_clubs"),
        _check("clubs", "team_id", "not_null", "count(*) - count(team_id)", "current_clubs"),
        _check("clubs", "team_id", "unique", "count(*)", _twice("current_clubs", "competition_code, team_id")),
    ]
    return f"{TABLES}, {CURRENT_CLUBS} " + " UNION ALL ".join(parts)


def _inventory() -> str:
    models = [
        (1, "Warehouse", "dim_team", "stg_teams"),
        (1, "Warehouse", "fact_match", "stg_matches"),
        (1, "Warehouse", "fact_standing_snapshot", "stg_standings"),
        (2, "Staging", "stg_teams", "stg_teams"),
        (2, "Staging", "stg_matches", "stg_matches"),
        (2, "Staging", "stg_standings", "stg_standings"),
        (3, "Intermediate", "int_team_match_results", "int_team_match_results"),
        (3, "Intermediate", "int_standings_reconciliation", "int_standings_reconciliation"),
        (4, "Mart", "mart_current_standings", "mart_current_standings"),
        (4, "Mart", "mart_team_performance", "mart_team_performance"),
        (4, "Mart", "mart_match_explorer", "mart_match_explorer"),
    ]
    return TABLES + " UNION ALL ".join(
        f"SELECT {n} AS layer_no, '{layer}' AS layer, '{name}' AS model, count(*) AS rows FROM {table}"
        for n, layer, name, table in models
    )


def _matrix_wide() -> str:
    cells = ", ".join(
        f"CASE WHEN s.tla = 'T{n:02d}' AND max(CASE WHEN c.away_tla = 'T{n:02d}' THEN c.cell END) IS NULL THEN '—' "
        f"ELSE coalesce(max(CASE WHEN c.away_tla = 'T{n:02d}' THEN c.cell END), '·') END AS \"T{n:02d}\""
        for n in range(25)
    )
    return f"""{TABLES}, cells AS ({_MATRIX})
    SELECT s.competition_code, s.season_id, s.team_id AS home_team_id, s.short_name AS home_team, {cells}
    FROM mart_current_standings s LEFT JOIN cells c ON c.competition_code = s.competition_code
      AND c.season_id = s.season_id AND c.home_team_id = s.team_id
    GROUP BY s.competition_code, s.season_id, s.team_id, s.short_name, s.tla"""


_MATRIX = """
  SELECT m.competition_code, m.season_id, m.home_team_id, m.away_team_id, m.home_team, m.home_tla, m.away_team,
    m.away_tla, m.match_id,
    CASE WHEN m.match_state = 'Finished' THEN CAST(home_score AS VARCHAR) || '–' || CAST(away_score AS VARCHAR)
      WHEN m.match_state = 'Live' THEN CAST(home_score AS VARCHAR) || '–' || CAST(away_score AS VARCHAR) || '*'
      ELSE '·' END AS cell,
    CASE WHEN m.match_state NOT IN ('Finished', 'Live') THEN 'blank' WHEN home_score > away_score THEN 'home win'
      WHEN home_score < away_score THEN 'away win' ELSE 'draw' END AS outcome
  FROM (SELECT *, row_number() OVER (PARTITION BY competition_code, season_id, home_team_id, away_team_id
      ORDER BY utc_date DESC, match_id DESC) AS n FROM mart_match_explorer) m
  WHERE n = 1
    AND EXISTS (SELECT 1 FROM mart_current_standings s WHERE s.competition_code = m.competition_code
      AND s.season_id = m.season_id AND s.team_id = m.home_team_id)
    AND EXISTS (SELECT 1 FROM mart_current_standings s WHERE s.competition_code = m.competition_code
      AND s.season_id = m.season_id AND s.team_id = m.away_team_id)
"""

MATCH_LIST = f"""{TABLES} SELECT match_id, competition_code, season_id, matchday, utc_date, status, match_state,
    home_team_id, home_team, home_tla, home_badge_url, away_team_id, away_team, away_tla, away_badge_url,
    home_score, away_score, scoreline, result FROM mart_match_explorer"""

ORACLE: dict[str, str] = {
    "stg_matches": _rows("stg_matches"),
    "stg_teams": _rows("stg_teams"),
    "stg_standings": _rows("stg_standings"),
    "team_match_results": _rows("int_team_match_results"),
    "team_performance": _rows("mart_team_performance"),
    "match_explorer": _rows("mart_match_explorer"),
    "match_list": MATCH_LIST,
    "match_explorer_filtered": f"""{MATCH_LIST}
      WHERE match_state = 'Finished' AND (home_team = 'Nation 7' OR away_team = 'Nation 7')""",
    "club_fixtures": f"{MATCH_LIST} WHERE home_team_id = 7 OR away_team_id = 7",
    "chosen_history": f"{TABLES} SELECT * FROM position_history WHERE short_name IN ('Nation 3', 'Nation 7')",
    "club_options": f"""{TABLES} SELECT competition_code, season_id, home_team AS club FROM mart_match_explorer
      UNION SELECT competition_code, season_id, away_team FROM mart_match_explorer""",
    "recent_matches": f"""{TABLES} SELECT competition_code, season_id, match_id, matchday, utc_date, home_team,
      home_badge_url, away_team, away_badge_url, home_score, away_score FROM mart_match_explorer
      WHERE status = 'FINISHED' QUALIFY row_number() OVER (PARTITION BY competition_code, season_id
        ORDER BY utc_date DESC NULLS LAST, match_id DESC) <= 8""",
    "upcoming_matches": f"""{TABLES} SELECT competition_code, season_id, match_id, matchday, utc_date, home_team,
      home_badge_url, away_team, away_badge_url, status FROM mart_match_explorer
      WHERE status IN ('SCHEDULED', 'TIMED') QUALIFY row_number() OVER (PARTITION BY competition_code, season_id
        ORDER BY utc_date NULLS LAST, match_id) <= 8""",
    "match_status_summary": f"{TABLES} SELECT status, count(*) AS match_count FROM stg_matches GROUP BY status",
    "match_state_summary": f"""{TABLES} SELECT competition_code, season_id, match_state, count(*) AS matches
      FROM mart_match_explorer GROUP BY ALL""",
    "match_kpis": f"""{TABLES} SELECT competition_code, season_id, count(*) AS total_matches,
      count(*) FILTER (WHERE match_state = 'Finished') AS finished_matches,
      count(*) FILTER (WHERE match_state = 'Live') AS live_matches,
      count(*) FILTER (WHERE match_state = 'Upcoming') AS upcoming_matches,
      count(*) FILTER (WHERE match_state = 'Other') AS other_matches
      FROM mart_match_explorer GROUP BY ALL""",
    "season_completion": f"""{TABLES} SELECT competition_code, season_id,
      count(*) FILTER (WHERE match_state = 'Finished') AS finished_matches,
      count(*) FILTER (WHERE match_state = 'Upcoming') AS upcoming_matches, count(*) AS total_matches,
      CAST(count(*) FILTER (WHERE match_state = 'Finished') AS DOUBLE) / count(*) * 100 AS completion_rate
      FROM mart_match_explorer GROUP BY ALL""",
    "kickoff_labels": f"""{TABLES} SELECT competition_code, season_id, match_id, home_team, away_team,
      strftime({LOCAL}, '%d %b %Y • %H:%M ') || {ZONE} AS kickoff,
      strftime({LOCAL}, '%d %b • %H:%M ') || {ZONE} AS kickoff_short FROM mart_match_explorer""",
    "goals_by_matchday": f"""{TABLES} SELECT competition_code, season_id, matchday, count(match_id) AS matches,
      CAST(sum(home_score + away_score) AS BIGINT) AS goals,
      CAST(sum(home_score + away_score) AS DOUBLE) / count(match_id) AS goals_per_match
      FROM stg_matches WHERE status = 'FINISHED' AND matchday IS NOT NULL GROUP BY ALL""",
    "default_matchday": f"""{TABLES} SELECT *, coalesce(CAST(default_matchday AS VARCHAR), 'All') AS default_label
      FROM default_rounds""",
    "latest_completed_round": f"""{TABLES} SELECT competition_code, season_id,
      max(CASE WHEN total_matches = finished_matches THEN matchday END) AS latest_completed_round
      FROM matchday_status GROUP BY ALL""",
    "matchday_window": f"""{TABLES}, anchored AS (
        SELECT r.*, coalesce((SELECT x.i FROM state_rounds x WHERE x.competition_code = r.competition_code
          AND x.season_id = r.season_id AND x.matchday = d.default_matchday), 1) AS a
        FROM state_rounds r JOIN default_rounds d ON r.competition_code = d.competition_code
          AND r.season_id = d.season_id
      ), started AS (SELECT *, least(greatest(1, a - 3), greatest(1, n - 6)) AS s FROM anchored)
      SELECT competition_code, season_id, matchday, CAST(i - s + 1 AS INTEGER) AS slot, i = a AS is_anchor
      FROM started WHERE i >= s AND i < s + 7""",
    "matchday_neighbours": f"""{TABLES} SELECT r.competition_code, r.season_id, r.matchday,
      (SELECT max(x.matchday) FROM state_rounds x WHERE x.competition_code = r.competition_code
        AND x.season_id = r.season_id AND x.matchday < r.matchday) AS previous_matchday,
      (SELECT min(x.matchday) FROM state_rounds x WHERE x.competition_code = r.competition_code
        AND x.season_id = r.season_id AND x.matchday > r.matchday) AS next_matchday
      FROM state_rounds r""",
    "latest_standings": _rows("latest"),
    "snapshot_freshness": f"""{TABLES} SELECT competition_code, season_id,
      count(DISTINCT snapshot_date) AS snapshots, max(snapshot_date) AS latest_snapshot,
      max(loaded_at) AS latest_load, max(snapshot_matchday) AS latest_matchday
      FROM stg_standings GROUP BY ALL""",
    "reconciliation": _rows("int_standings_reconciliation"),
    "colocated_reconciliation": _rows("int_standings_reconciliation"),
    "multi_season_reconciliation": f"""{TABLES}, seasons AS (
      SELECT competition_code, season_id, count(*) AS n, count(*) FILTER (is_reconciled) AS agreed, max(snapshot_date) AS newest
      FROM int_standings_reconciliation GROUP BY competition_code, season_id)
    SELECT competition_code, count(*) AS seasons, count(*) FILTER (n = agreed) AS reconciled_seasons,
      CAST(sum(n) AS BIGINT) AS teams, CAST(sum(agreed) AS BIGINT) AS reconciled_teams,
      max(season_id) FILTER (n <> agreed) AS last_unreconciled_season, max(newest) AS newest_snapshot
    FROM seasons GROUP BY competition_code""",
    "reconciliation_detail": f"""{TABLES} SELECT competition_code, season_id, position, team_id, short_name, played,
      points, is_reconciled, played_delta, points_delta, goals_for_delta, goals_against_delta
      FROM mart_current_standings""",
    "unreconciled": f"""{TABLES} SELECT competition_code, season_id, position, team_id, short_name, played,
      points, is_reconciled, played_delta, points_delta, goals_for_delta, goals_against_delta
      FROM mart_current_standings WHERE is_reconciled = false""",
    "reconciliation_summary": f"""{TABLES} SELECT count(*) AS total_teams,
      CAST(sum(CASE WHEN is_reconciled THEN 1 ELSE 0 END) AS BIGINT) AS reconciled_teams,
      CAST(sum(CASE WHEN NOT is_reconciled THEN 1 ELSE 0 END) AS BIGINT) AS unreconciled_teams,
      CAST(sum(CASE WHEN is_reconciled THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100 AS reconciliation_rate
      FROM mart_current_standings""",
    "current_standings": _rows("mart_current_standings"),
    "league_table": f"""{TABLES} SELECT competition_code, season_id, position AS pos, sportsdb_badge_url AS crest,
      short_name AS team, played AS p, won AS w, drawn AS d, lost AS l, goals_for AS gf, goals_against AS ga,
      goal_difference AS gd, points AS pts,
      CASE WHEN position BETWEEN 1 AND 4 THEN 'UCL' WHEN position BETWEEN 5 AND 7 THEN 'Europe'
        WHEN position BETWEEN 18 AND 20 THEN 'Relegation' ELSE '—' END AS zone,
      CASE WHEN is_reconciled THEN '✓ Synced' WHEN NOT is_reconciled THEN '⚠ Pending' END AS data
      FROM mart_current_standings""",
    "matchday_status": _rows("matchday_status"),
    "completed_matchdays": _rows("completed_matchdays"),
    "position_history": _rows("position_history"),
    "position_rounds": f"""{TABLES} SELECT competition_code, season_id, count(DISTINCT matchday) AS completed_rounds,
      max(matchday) AS latest_derived_round FROM position_history GROUP BY ALL""",
    "race_view": _rows("race_history"),
    "race_bounds": f"""{TABLES} SELECT h.competition_code, h.season_id, race,
      min(derived_position) AS best_position, max(derived_position) AS worst_position,
      CAST(greatest(1, min(derived_position) - 1) AS INTEGER) AS chart_top,
      CAST(least(max(c.clubs), max(derived_position) + 1) AS INTEGER) AS chart_bottom
      FROM race_history h JOIN (SELECT competition_code, season_id, count(*) AS clubs
        FROM mart_current_standings GROUP BY ALL) c
        ON h.competition_code = c.competition_code AND h.season_id = c.season_id
      GROUP BY h.competition_code, h.season_id, race""",
    "points_race": f"""{TABLES} SELECT competition_code, season_id, team_id, short_name, points, goal_difference,
      goals_for,
      CAST(row_number() OVER (PARTITION BY competition_code, season_id
        ORDER BY points, goal_difference, goals_for, team_id) AS INTEGER) AS points_order,
      CAST(row_number() OVER (PARTITION BY competition_code, season_id
        ORDER BY goal_difference, team_id) AS INTEGER) AS goal_difference_order,
      CAST(row_number() OVER (PARTITION BY competition_code, season_id
        ORDER BY goals_for, team_id) AS INTEGER) AS goals_for_order
      FROM mart_current_standings""",
    "league_highlights": f"""{TABLES}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY {LEAGUE_ORDER} ORDER BY position, short_name, team_id) AS a,
          row_number() OVER (PARTITION BY {LEAGUE_ORDER} ORDER BY goals_for DESC, goal_difference DESC, team_id) AS b,
          row_number() OVER (PARTITION BY {LEAGUE_ORDER} ORDER BY goals_against, goal_difference DESC, team_id) AS c
        FROM mart_current_standings)
      SELECT competition_code, season_id, 'League Leader' AS highlight, team_id, short_name, sportsdb_badge_url,
        CAST(points AS BIGINT) AS value, CAST(points AS VARCHAR) || ' points' AS value_text FROM ranked WHERE a = 1
      UNION ALL SELECT competition_code, season_id, 'Best Attack', team_id, short_name, sportsdb_badge_url,
        goals_for, CAST(goals_for AS VARCHAR) || ' goals' FROM ranked WHERE b = 1
      UNION ALL SELECT competition_code, season_id, 'Best Defence', team_id, short_name, sportsdb_badge_url,
        goals_against, CAST(goals_against AS VARCHAR) || ' conceded' FROM ranked WHERE c = 1""",
    "top10_table": f"""{TABLES} SELECT * FROM (SELECT competition_code, season_id,
      CAST(row_number() OVER (PARTITION BY {LEAGUE_ORDER} ORDER BY position, short_name, team_id) AS INTEGER) AS row_no,
      position, team_id, short_name, sportsdb_badge_url, played, won, drawn, lost, goal_difference, points
      FROM mart_current_standings) WHERE row_no <= 10""",
    "top10_ppg": f"""{TABLES} SELECT * FROM (SELECT competition_code, season_id,
      CAST(row_number() OVER (PARTITION BY {LEAGUE_ORDER} ORDER BY points_per_game DESC, team_id) AS INTEGER) AS row_no,
      team_id, short_name, points_per_game FROM mart_team_performance) WHERE row_no <= 10""",
    "form_last5": f"""{TABLES} SELECT competition_code, season_id, team_id, club, CAST(n AS INTEGER) AS recency,
      match_id, matchday, wdl AS result, CAST(gf AS VARCHAR) || '–' || CAST(ga AS VARCHAR) AS score, opponent,
      venue || ' • MD' || CAST(matchday AS VARCHAR) AS context FROM finished_rows WHERE n <= 5""",
    "form_strip": f"""{TABLES} SELECT competition_code, season_id, team_id, club,
      string_agg(wdl, ' ' ORDER BY n DESC) AS form, count(*) AS matches
      FROM finished_rows WHERE n <= 5 GROUP BY competition_code, season_id, team_id, club""",
    "club_recent": f"""{TABLES} SELECT competition_code, season_id, team_id, club, CAST(n AS INTEGER) AS row_no,
      match_id, matchday, strftime({LOCAL}, '%d %b %Y') AS date, home_team, scoreline AS score, away_team,
      wdl AS result FROM finished_rows WHERE n <= 8""",
    "club_upcoming": f"""{TABLES} SELECT * EXCLUDE (utc_date) FROM (SELECT competition_code, season_id, team_id, club,
      CAST(row_number() OVER (PARTITION BY competition_code, season_id, team_id ORDER BY utc_date, match_id)
        AS INTEGER) AS row_no, match_id, matchday,
      strftime({LOCAL}, '%d %b %Y • %H:%M ') || {ZONE} AS date, home_team, away_team, status, utc_date
      FROM club_results WHERE match_state = 'Upcoming') WHERE row_no <= 5""",
    "club_season_strip": f"""{TABLES} SELECT competition_code, season_id, team_id, club, match_id, matchday, utc_date,
      opponent, venue, CASE WHEN match_state = 'Finished' THEN wdl ELSE 'Upcoming' END AS result,
      CASE WHEN match_state = 'Finished' THEN scoreline ELSE '—' END AS score FROM club_results""",
    "club_record": f"""{TABLES} SELECT s.competition_code, s.season_id, s.team_id, s.team_name, s.short_name, s.tla,
      s.position, s.played, s.points, s.is_reconciled, p.played AS derived_played,
      coalesce(printf('%.2f', p.points_per_game), 'N/A') AS ppg_text,
      coalesce(printf('%+d', p.goal_difference), 'N/A') AS goal_difference_text,
      CAST(p.won AS VARCHAR) || '-' || CAST(p.drawn AS VARCHAR) || '-' || CAST(p.lost AS VARCHAR) AS wdl,
      printf('%.2f', p.goals_for_per_game) AS goals_per_match_text,
      printf('%.2f', p.goals_against_per_game) AS conceded_per_match_text
      FROM mart_current_standings s LEFT JOIN mart_team_performance p ON s.competition_code = p.competition_code
        AND s.season_id = p.season_id AND s.team_id = p.team_id""",
    "official_vs_derived": f"""{TABLES}, pairs AS (
        SELECT s.competition_code, s.season_id, s.team_id, s.short_name, s.played AS a1, p.played AS b1,
          s.points AS a2, p.points AS b2, s.goals_for AS a3, p.goals_for AS b3,
          s.goals_against AS a4, p.goals_against AS b4
        FROM mart_current_standings s JOIN mart_team_performance p ON s.competition_code = p.competition_code
          AND s.season_id = p.season_id AND s.team_id = p.team_id)
      SELECT competition_code, season_id, team_id, short_name, 'Played' AS metric,
        CAST(a1 AS BIGINT) AS official_standings, CAST(b1 AS BIGINT) AS finished_matches,
        CAST(a1 - b1 AS BIGINT) AS difference FROM pairs
      UNION ALL SELECT competition_code, season_id, team_id, short_name, 'Points', a2, b2, a2 - b2 FROM pairs
      UNION ALL SELECT competition_code, season_id, team_id, short_name, 'Goals For', a3, b3, a3 - b3 FROM pairs
      UNION ALL SELECT competition_code, season_id, team_id, short_name, 'Goals Against', a4, b4, a4 - b4 FROM pairs""",
    "home_vs_away": f"""{TABLES} SELECT competition_code, season_id, team_id, short_name, 'Home' AS venue,
        home_points AS points FROM mart_team_performance
      UNION ALL SELECT competition_code, season_id, team_id, short_name, 'Away', away_points
        FROM mart_team_performance""",
    "fixture_matrix": f"{TABLES} {_MATRIX}",
    "fixture_matrix_wide": _matrix_wide(),
    "fixture_matrix_slots": f"""{TABLES}, cells AS ({_MATRIX}),
    clubs AS (SELECT competition_code, season_id, team_id, short_name, coalesce(tla, short_name, CAST(team_id AS VARCHAR)) AS label
      FROM mart_current_standings),
    placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY competition_code, season_id ORDER BY label, team_id) AS INTEGER) AS slot
      FROM clubs)
    SELECT h.competition_code, h.season_id, h.team_id AS home_team_id, h.short_name AS home_team, h.slot,
      string_agg(a.label, '|' ORDER BY a.slot) AS columns,
      string_agg(coalesce(c.cell, CASE WHEN a.team_id = h.team_id THEN '—' ELSE '·' END), '|' ORDER BY a.slot) AS cells
    FROM placed h JOIN placed a USING (competition_code, season_id)
    LEFT JOIN cells c ON c.competition_code = h.competition_code AND c.season_id = h.season_id
      AND c.home_team_id = h.team_id AND c.away_team_id = a.team_id
    GROUP BY ALL""",
    "dq_not_null": _checks("not_null"),
    "dq_unique": _checks("unique"),
    "dq_accepted": _checks("accepted_values"),
    "dq_relationships": _checks("relationships"),
    "load_gate": _load_gate(),
    "dq_row_rules": f"""{TABLES}
      SELECT 'fact_match' AS model, 'home_team_id' AS column_name, 'home_team_id <> away_team_id' AS rule,
        count(*) FILTER (WHERE home_team_id = away_team_id) AS failures FROM stg_matches
      UNION ALL SELECT 'fact_standing_snapshot', 'played', 'played = won + drawn + lost',
        count(*) FILTER (WHERE played <> won + drawn + lost) FROM stg_standings
      UNION ALL SELECT 'fact_standing_snapshot', 'goal_difference', 'goal_difference = goals_for - goals_against',
        count(*) FILTER (WHERE goal_difference <> goals_for - goals_against) FROM stg_standings""",
    "dq_violating_rows": f"""{TABLES}
      SELECT 'fact_standing_snapshot' AS model, 'played' AS column_name, 'played = won + drawn + lost' AS rule,
        competition_code || '-' || CAST(season_id AS VARCHAR) || '-' || snapshot_date || '-'
          || CAST(team_id AS VARCHAR) AS row_key
      FROM stg_standings WHERE played <> won + drawn + lost
      UNION ALL SELECT 'fact_standing_snapshot', 'goal_difference', 'goal_difference = goals_for - goals_against',
        competition_code || '-' || CAST(season_id AS VARCHAR) || '-' || snapshot_date || '-'
          || CAST(team_id AS VARCHAR)
      FROM stg_standings WHERE goal_difference <> goals_for - goals_against
      UNION ALL SELECT 'fact_match', 'home_team_id', 'home_team_id <> away_team_id', CAST(match_id AS VARCHAR)
      FROM stg_matches WHERE home_team_id = away_team_id""",
    "dq_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
      WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
    "dq_orphan_keys": """SELECT c_custkey, count(*) AS rows FROM customer c WHERE c_custkey IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey) GROUP BY c_custkey""",
    "dq_orphan_keys_filtered": """SELECT c_custkey, count(*) AS rows FROM customer c WHERE c_mktsegment = 'BUILDING'
      AND c_custkey IS NOT NULL AND c_custkey NOT IN (SELECT o_custkey FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND o_custkey IS NOT NULL) GROUP BY c_custkey""",
    "reference_checks": _reference_checks(),
    "source_checks": _source_checks(),
    "reference_membership": f"""{TABLES}, current_clubs AS (
        SELECT competition_code, home_team_id AS team_id FROM stg_matches
        UNION SELECT competition_code, away_team_id FROM stg_matches
      ), reference AS (
        SELECT competition_code, CASE WHEN team_id = 3 THEN 99 ELSE team_id END AS team_id FROM stg_teams)
      SELECT coalesce(c.competition_code, r.competition_code) AS competition_code,
        coalesce(c.team_id, r.team_id) AS team_id,
        CASE WHEN r.team_id IS NULL THEN 'MISSING' WHEN c.team_id IS NULL THEN 'OBSOLETE' ELSE 'MATCHED' END
          AS membership
      FROM current_clubs c FULL JOIN reference r
        ON c.competition_code = r.competition_code AND c.team_id = r.team_id""",
    "reference_enriched": f"""{TABLES}, current_clubs AS (
        SELECT competition_code, home_team_id AS team_id FROM stg_matches
        UNION SELECT competition_code, away_team_id FROM stg_matches)
      SELECT c.competition_code, c.team_id, t.sportsdb_team_id, t.sportsdb_team_name, t.sportsdb_badge_url,
        t.sportsdb_source, t.sportsdb_resolution_method, t.sportsdb_fetched_at
      FROM current_clubs c LEFT JOIN stg_teams t
        ON c.competition_code = t.competition_code AND c.team_id = t.team_id AND t.team_id <> 3""",
    "badge_coverage": f"""{TABLES}, current_clubs AS (
        SELECT competition_code, home_team_id AS team_id FROM stg_matches
        UNION SELECT competition_code, away_team_id FROM stg_matches)
      SELECT c.competition_code, count(*) AS team_count, count(t.team_id) AS resolved_count,
        count(t.sportsdb_badge_url) AS badge_count
      FROM current_clubs c LEFT JOIN stg_teams t
        ON c.competition_code = t.competition_code AND c.team_id = t.team_id AND t.team_id <> 3
      GROUP BY c.competition_code""",
    "entity_resolution": f"{RESOLUTION} SELECT * FROM resolved",
    "entity_resolution_aliases": f"{ALIASED_RESOLUTION} SELECT * FROM resolved",
    "candidate_checks": f"""{RESOLUTION}
      SELECT 'candidate' AS model, 'team_id' AS column_name, 'unique' AS rule, count(*) AS failures FROM (
        SELECT 1 FROM resolved GROUP BY competition_code, team_id HAVING count(*) > 1) d
      UNION ALL SELECT 'candidate', 'sportsdb_team_id', 'coalesce(sportsdb_team_id, '''') <> ''''',
        count(*) FILTER (WHERE sportsdb_team_id IS NULL) FROM resolved
      UNION ALL SELECT 'candidate', 'sportsdb_badge_url', 'coalesce(sportsdb_badge_url, '''') <> ''''',
        count(*) FILTER (WHERE sportsdb_badge_url IS NULL) FROM resolved
      UNION ALL SELECT 'candidate', 'sportsdb_team_id', 'unique', count(*) FROM (
        SELECT 1 FROM resolved WHERE sportsdb_team_id IS NOT NULL
        GROUP BY competition_code, sportsdb_team_id HAVING count(*) > 1) d
      UNION ALL SELECT 'candidate', '*', 'row_count',
        abs((SELECT count(*) FROM resolved) - (SELECT count(*) FROM clubs))""",
    "health_overview": f"""{TABLES} SELECT (SELECT count(*) FROM stg_matches) AS match_rows,
      (SELECT count(DISTINCT snapshot_date) FROM stg_standings) AS standing_snapshots,
      (SELECT max(source_snapshot_date) FROM stg_matches) AS latest_source_snapshot,
      (SELECT max(loaded_at) FROM stg_matches) AS latest_warehouse_load,
      (SELECT count(*) FROM mart_current_standings WHERE is_reconciled) AS reconciled_teams,
      (SELECT count(*) FROM mart_current_standings) AS total_teams,
      CAST((SELECT count(*) FROM mart_current_standings WHERE is_reconciled) AS DOUBLE)
        / (SELECT count(*) FROM mart_current_standings) * 100 AS reconciliation_rate""",
    "model_row_counts": _inventory(),
    "run_log": f"{RUNS} SELECT * FROM runs",
    "run_log_compacted": f"{RUNS} SELECT * FROM runs",
    "pipeline_runs": f"{RUNS} SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 10",
    "run_history": f"""{RUNS} SELECT run_id, strftime(started_at, '%d %b %Y • %H:%M UTC') AS started, status,
      current_stage AS stage, failed_stage, round(duration_seconds, 2) AS duration_s, error_message AS error
      FROM runs ORDER BY started_at DESC, run_id LIMIT 10""",
    "latest_run_line": f"""{RUNS} SELECT run_id, status, strftime(started_at, '%d %b • %H:%M UTC') AS started,
      CASE status WHEN 'SUCCESS' THEN 'The latest run completed successfully.'
        WHEN 'RUNNING' THEN 'The latest run is still running.'
        ELSE 'Latest run failed during ' || coalesce(failed_stage, 'None') || '.' END AS message
      FROM runs ORDER BY started_at DESC, run_id LIMIT 1""",
    "json_flatten": f"""{TABLES} SELECT match_id, competition_id, competition_code, season_id, matchday, stage,
      utc_date, status, home_team_id, away_team_id, home_score, away_score, result, source_last_updated,
      source_snapshot_date FROM stg_matches""",
    "files_flatten_matches": f"""{TABLES} SELECT match_id, competition_id, competition_code, season_id, matchday, stage,
      utc_date, status, home_team_id, away_team_id, home_score, away_score, result, source_last_updated,
      source_snapshot_date FROM stg_matches""",
    "files_flatten_teams": f"""{TABLES} SELECT team_id, team_name, short_name, tla, country, venue_name, founded,
      club_colors, crest_url, competition_code, '2001-07-01' AS snapshot_date FROM stg_teams""",
    "published_base": f"{TABLES} SELECT * EXCLUDE (loaded_at) FROM stg_matches",
    "history_resumed": _rows("position_history"),
    "incremental_marts": _rows("mart_team_performance"),
    "latest_standings_by_part": f"{TABLES} SELECT * EXCLUDE (loaded_at) FROM latest",
    "dq_at_write": " UNION ALL ".join(
        f"SELECT * FROM ({_checks(kind)})" for kind in ("not_null", "unique", "accepted_values", "relationships")
    ),
    "drifted_union": f"""{TABLES} SELECT match_id, matchday, CASE WHEN season_id >= 2001 THEN home_score END AS home_score,
      CASE WHEN season_id < 2001 THEN stage END AS stage, CASE WHEN season_id < 2001 THEN 'early' ELSE 'late' END AS age
      FROM stg_matches""",
    "reference_loaded": f"""{TABLES} SELECT competition_code, team_id, sportsdb_team_id, sportsdb_team_name,
      sportsdb_badge_url, sportsdb_source, sportsdb_resolution_method, sportsdb_fetched_at FROM stg_teams""",
    "reference_published": f"""{TABLES} SELECT competition_code, team_id, sportsdb_team_id, sportsdb_team_name,
      sportsdb_badge_url, sportsdb_source, sportsdb_resolution_method, sportsdb_fetched_at FROM stg_teams""",
    "published_standings": f"{TABLES} SELECT * EXCLUDE (loaded_at) FROM stg_standings",
    "snapshot_roundtrip": f"{TABLES} SELECT * EXCLUDE (loaded_at) FROM stg_standings",
    "incremental_ingest": f"{TABLES} SELECT * EXCLUDE (loaded_at) FROM stg_standings",
    "latest_documents": f"""{TABLES} SELECT * EXCLUDE (loaded_at) FROM stg_standings s
      WHERE snapshot_date = (SELECT max(x.snapshot_date) FROM stg_standings x
        WHERE x.competition_code = s.competition_code)""",
}
