"""League tables expressed over the generic test tables (see FIXTURES.md).

``orders`` become matches (3 competitions x 7 seasons x 37 rounds), ``nation`` the clubs,
``supplier`` the artwork candidates and ``events`` the run events. Pure projections; only
the official standings aggregate.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.operators import LEAGUE
from touchline.operators.participants import team_match_results

COMPETITIONS = ["L0", "L1", "L2"]
LATEST_SNAPSHOT = "2001-07-01"
LOADED_AT = "2001-07-01 06:00:00"


_schemas: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is taken from the file footers once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def matches_from_orders(orders: DataFrame) -> DataFrame:
    base = orders.selectExpr(
        "o_orderkey AS match_id",
        "o_custkey % 3 AS competition_id",
        "concat('L', string(o_custkey % 3)) AS competition_code",
        "bigint(year(o_orderdate)) AS season_id",
        "int(floor((dayofyear(o_orderdate) - 1) / 10)) + 1 AS matchday",
        "timestamp(o_orderdate) AS utc_date",
        """CASE WHEN o_orderdate < '2001-06-01' THEN 'FINISHED'
                WHEN o_orderdate < '2001-06-21' THEN
                  CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'IN_PLAY' ELSE 'POSTPONED' END
                WHEN o_orderstatus = 'F' THEN 'SCHEDULED' ELSE 'TIMED' END AS status""",
        "o_custkey % 25 AS home_team_id",
        "(o_custkey % 25 + 1 + o_orderkey % 24) % 25 AS away_team_id",
        "int(floor(o_totalprice) % 5) AS home_goals",
        "int((o_orderkey * 7 + o_custkey) % 4) AS away_goals",
    )
    return base.selectExpr(
        "match_id", "competition_id", *LEAGUE, "matchday", "'REGULAR_SEASON' AS stage", "utc_date", "status",
        "home_team_id", "away_team_id",
        "CASE WHEN status IN ('FINISHED', 'IN_PLAY') THEN home_goals END AS home_score",
        "CASE WHEN status IN ('FINISHED', 'IN_PLAY') THEN away_goals END AS away_score",
        """CASE WHEN status = 'FINISHED' AND match_id % 997 <> 0 THEN
             CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A' ELSE 'D' END
           END AS result""",
        "utc_date AS source_last_updated",
        f"'{LATEST_SNAPSHOT}' AS source_snapshot_date",
        f"timestamp '{LOADED_AT}' AS loaded_at",
    )


EVERY_COMPETITION = "explode(array('L0', 'L1', 'L2')) AS competition_code"


def clubs_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Club dimension without artwork: every nation in every competition."""
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "bigint(n_nationkey) AS team_id",
        "n_name AS team_name",
        "concat('Nation ', n_nationkey) AS short_name",
        "concat('T', lpad(n_nationkey, 2, '0')) AS tla",
        "r_name AS country",
        "concat(n_name, ' Arena') AS venue_name",
        "int(n_nationkey + 1900) AS founded",
        "'Red / White' AS club_colors",
        "concat('https://crests.example/', n_nationkey, '.png') AS crest_url",
        EVERY_COMPETITION,
        f"timestamp '{LOADED_AT}' AS loaded_at",
    )


def _artwork(key: str, name: str) -> list[str]:
    return [
        f"string({key} + 133700) AS sportsdb_team_id",
        f"initcap({name}) AS sportsdb_team_name",
        f"concat('https://badges.example/', {key} + 133700, '.png') AS sportsdb_badge_url",
        "'TheSportsDB' AS sportsdb_source",
        f"CASE WHEN {key} < 20 THEN 'ID_OVERRIDE' ELSE 'NAME_SEARCH' END AS sportsdb_resolution_method",
        f"timestamp '{LOADED_AT}' AS sportsdb_fetched_at",
    ]


def reference_from_nations(nation: DataFrame) -> DataFrame:
    """Reviewed artwork reference for every competition."""
    return nation.selectExpr(
        EVERY_COMPETITION, "bigint(n_nationkey) AS team_id", "n_name AS team_name",
        *_artwork("n_nationkey", "n_name"),
    )


def teams_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Club dimension with artwork, built row by row from the same nation."""
    return clubs_from_nations(nation, region).selectExpr(
        "team_id", "team_name", "short_name", "tla", "country", "venue_name", "founded",
        "club_colors", "crest_url", *_artwork("team_id", "team_name"), "competition_code", "loaded_at",
    )


def standings_from_matches(matches: DataFrame) -> DataFrame:
    """Official snapshots: totals before each snapshot date; some clubs run ahead."""
    ahead = "if(snapshot_date = '2001-07-01' AND team_id % 7 = 0, 1, 0)"
    league = "competition_code, season_id, snapshot_date"
    # The snapshots a match is due in: 1 the year's last day, 2 both of 2001, 3 the later one.
    due = """CASE WHEN season_id < 2001 THEN if(month(utc_date) = 12 AND dayofmonth(utc_date) = 31, 0, 1)
                  WHEN utc_date < '2001-05-31' THEN 2 WHEN utc_date < '2001-07-01' THEN 3 ELSE 0 END AS due"""
    dates = """explode(CASE due WHEN 1 THEN array(concat(season_id, '-12-31'))
                 WHEN 2 THEN array('2001-05-31', '2001-07-01')
                 WHEN 3 THEN array('2001-07-01') END) AS snapshot_date"""
    counts = ["played", "won", "drawn", "lost", "goals_for", "goals_against", "points"]
    return (
        team_match_results(matches)
        .selectExpr("*", due)
        .groupBy("competition_id", *LEAGUE, "due", "team_id")
        .agg(
            F.expr("count(*) AS played"),
            F.expr("count_if(team_result = 'W') AS won"),
            F.expr("count_if(team_result = 'D') AS drawn"),
            F.expr("count_if(team_result = 'L') AS lost"),
            F.expr("sum(goals_for) AS goals_for"),
            F.expr("sum(goals_against) AS goals_against"),
            F.expr("sum(points_earned) AS points"),
        )
        .selectExpr("competition_id", *LEAGUE, "team_id", dates, *counts)
        .groupBy("competition_id", *LEAGUE, "snapshot_date", "team_id")
        .agg(*[F.expr(f"sum({c}) AS {c}") for c in counts])
        .selectExpr(
            "competition_id", *LEAGUE, "snapshot_date", "team_id",
            f"int(played + {ahead}) AS played",
            f"int(won + {ahead}) AS won",
            "int(drawn) AS drawn",
            "int(lost) AS lost",
            f"int(goals_for + {ahead}) AS goals_for",
            "int(goals_against) AS goals_against",
            f"int(goals_for + {ahead} - goals_against) AS goal_difference",
            f"int(points + 3 * {ahead}) AS points",
        )
        .selectExpr(
            "competition_id", *LEAGUE,
            "int(floor((dayofyear(to_date(snapshot_date)) - 1) / 10)) + 1 AS snapshot_matchday",
            "snapshot_date", "team_id",
            f"""rank() OVER (PARTITION BY {league}
                  ORDER BY points DESC, goal_difference DESC, goals_for DESC) AS position""",
            "played", "won", "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points",
            "string(NULL) AS form",
            f"timestamp '{LOADED_AT}' AS loaded_at",
        )
    )


def load(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """The three base tables as builders, so a query only prepares the tables it uses."""

    @cache
    def matches() -> DataFrame:
        return matches_from_orders(read(spark, sf_dir, "orders"))

    return {
        "dim_team": lambda: teams_from_nations(read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")),
        "fact_match": matches,
        "fact_standing_snapshot": lambda: standings_from_matches(matches()),
    }


# --- inputs of the reference and run-log operators ------------------------------------


def reviewed_reference(nation: DataFrame) -> DataFrame:
    """Reference with one club missing (id 3) and one obsolete (id 99) per competition."""
    reference = reference_from_nations(nation)
    obsolete = reference.filter(F.col("team_id") == 3).withColumn("team_id", F.lit(99).cast("bigint"))
    return reference.filter(F.col("team_id") != 3).unionByName(obsolete)


def candidates_from_suppliers(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Artwork candidates: mixed-case club names, some of another sport or without a badge."""
    located = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    home = F.col("s_suppkey") % 2 == 0
    key = F.col("s_suppkey")
    return located.join(
        region, F.when(home, F.col("n_regionkey")).otherwise(key % 5) == F.col("r_regionkey")
    ).select(
        key.alias("candidate_no"),
        key.cast("string").alias("sportsdb_team_id"),
        F.initcap("n_name").alias("sportsdb_team_name"),
        F.when(key % 5 == 0, F.lit("Rugby")).otherwise(F.lit("Soccer")).alias("sport"),
        F.initcap("r_name").alias("country"),
        F.when(
            key % 11 != 0, F.concat(F.lit("https://badges.example/"), key.cast("string"))
        ).alias("badge_url"),
    )


def overrides_from_suppliers(supplier: DataFrame) -> DataFrame:
    """Reviewed ids for clubs 0-9: the supplier with three times the club's number."""
    return supplier.filter((F.col("s_suppkey") % 3 == 0) & (F.col("s_suppkey") < 30)).select(
        (F.col("s_suppkey") / 3).cast("bigint").alias("team_id"),
        F.col("s_suppkey").cast("string").alias("sportsdb_team_id"),
    )


def search_aliases(nation: DataFrame) -> DataFrame:
    """Every fifth club is searched under the name of the club before it."""
    before = nation.select((F.col("n_nationkey") + 1).alias("key"), F.col("n_name").alias("search_name"))
    return nation.join(before, (F.col("n_nationkey") == F.col("key")) & (F.col("n_nationkey") % 5 == 4)).select(
        F.col("n_name").alias("team_name"), "search_name"
    )


def run_events(events: DataFrame) -> DataFrame:
    """Run events: one run per user and day."""
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    stage = F.element_at(
        F.array(
            F.lit("API_INGESTION"), F.lit("TRANSFORMATION"), F.lit("WAREHOUSE_LOAD"), F.lit("DBT_BUILD")
        ),
        (F.col("event_id") % 4).cast("int") + 1,
    )
    event = (
        F.when(kind == "signup", F.lit("START"))
        .when(kind == "purchase", F.lit("SUCCESS"))
        .when(kind == "error", F.lit("FAILED"))
        .otherwise(F.lit("STAGE"))
    )
    return events.select(
        F.concat(
            F.col("user_id").cast("string"), F.lit("-"), F.date_format(ts, "yyyyMMdd")
        ).alias("run_id"),
        "event_id",
        ts.alias("event_ts"),
        event.alias("event"),
        F.concat(F.lit("L"), (F.col("user_id") % 3).cast("string")).alias("competition_code"),
        F.when(event.isin("STAGE", "FAILED"), stage).alias("stage"),
        F.when(
            event == "FAILED", F.concat(F.lit("stage failed at event "), F.col("event_id").cast("string"))
        ).alias("error_message"),
    )


# --- raw documents -------------------------------------------------------------------

MATCHES_PER_DOCUMENT = 512


def _iso(ts: str) -> str:
    return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


# One match as it appears in a document.
_MATCH_ITEM = f"""named_struct(
  'id', match_id,
  'competition', named_struct('id', competition_id),
  'season', named_struct('id', season_id),
  'matchday', matchday, 'stage', stage, 'utcDate', {_iso("utc_date")}, 'status', status,
  'homeTeam', named_struct('id', home_team_id),
  'awayTeam', named_struct('id', away_team_id),
  'score', named_struct(
    'winner', CASE result WHEN 'H' THEN 'HOME_TEAM' WHEN 'A' THEN 'AWAY_TEAM' WHEN 'D' THEN 'DRAW' END,
    'fullTime', named_struct('home', home_score, 'away', away_score)),
  'lastUpdated', {_iso("source_last_updated")})"""


def match_documents(matches: DataFrame) -> DataFrame:
    """Match documents of at most 512 matches each, so no document grows with a league."""
    return (
        matches.groupBy(
            "competition_code",
            F.col("source_snapshot_date").alias("snapshot_date"),
            F.floor(F.col("match_id") / MATCHES_PER_DOCUMENT).alias("chunk"),
        )
        .agg(F.expr(f"collect_list({_MATCH_ITEM}) AS matches"))
        .drop("chunk")
    )


def standing_documents(standings: DataFrame) -> DataFrame:
    """One document per league and snapshot, with an overall and a home group."""
    row = F.struct(
        F.struct(F.col("team_id").alias("id")).alias("team"),
        "position",
        F.col("played").alias("playedGames"),
        "form",
        "won",
        F.col("drawn").alias("draw"),
        "lost",
        "points",
        F.col("goals_for").alias("goalsFor"),
        F.col("goals_against").alias("goalsAgainst"),
        F.col("goal_difference").alias("goalDifference"),
    )
    table = F.collect_list(row)
    return standings.groupBy(
        "competition_id", "season_id", "competition_code", "snapshot_date", "snapshot_matchday"
    ).agg(table.alias("table")).select(
        F.struct(F.col("competition_id").alias("id")).alias("competition"),
        F.struct(
            F.col("season_id").alias("id"), F.col("snapshot_matchday").alias("currentMatchday")
        ).alias("season"),
        F.array(
            F.struct(F.lit("TOTAL").alias("type"), F.col("table")),
            F.struct(F.lit("HOME").alias("type"), F.slice("table", 1, 1).alias("table")),
        ).alias("standings"),
        "competition_code",
        "snapshot_date",
    )


def team_documents(clubs: DataFrame) -> DataFrame:
    """One club-list document per competition."""
    item = F.struct(
        F.col("team_id").alias("id"),
        F.col("team_name").alias("name"),
        F.col("short_name").alias("shortName"),
        "tla",
        F.struct(F.col("country").alias("name")).alias("area"),
        F.col("venue_name").alias("venue"),
        "founded",
        F.col("club_colors").alias("clubColors"),
        F.col("crest_url").alias("crest"),
    )
    return clubs.groupBy("competition_code", F.lit(LATEST_SNAPSHOT).alias("snapshot_date")).agg(
        F.collect_list(item).alias("teams")
    )
