"""Club artwork reference: membership, enrichment, entity resolution and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.text import same_text
from touchline.operators.contracts import (
    ACCEPTED,
    NOT_EMPTY,
    NOT_NULL,
    PRESENT,
    ROW_RULE,
    UNIQUE,
    Rule,
)

SOURCE = "TheSportsDB"
SPORT = "Soccer"
ID_OVERRIDE, NAME_SEARCH = "ID_OVERRIDE", "NAME_SEARCH"

# Reviewed club id -> artwork source id.
REVIEWED_IDS = {
    77: "133727",
    78: "133729",
    79: "133730",
    80: "133734",
    81: "133739",
    82: "133731",
    84: "133736",
    86: "133738",
    87: "133728",
    88: "133732",
    90: "133722",
    92: "133724",
    94: "133740",
    95: "133725",
    263: "134221",
    285: "134384",
    558: "133937",
    559: "133735",
    560: "133816",
    5335: "133726",
}

ARTWORK_COLUMNS = [
    "sportsdb_team_id", "sportsdb_team_name", "sportsdb_badge_url", "sportsdb_source",
    "sportsdb_resolution_method", "sportsdb_fetched_at",
]
CLUB_KEY = ["competition_code", "team_id"]

# Checks on the loaded reference, on the enriched clubs and on a resolved candidate.
REFERENCE_RULES = [
    Rule("reference", NOT_EMPTY, "*"),
    *[Rule("reference", PRESENT, column) for column in ("team_id", "team_name", *ARTWORK_COLUMNS)],
    Rule("reference", NOT_NULL, "team_id"),
    Rule("reference", UNIQUE, "team_id", keys=tuple(CLUB_KEY)),
]
ENRICHED_RULES = [
    *[Rule("enriched", NOT_NULL, column) for column in ARTWORK_COLUMNS],
    Rule("enriched", UNIQUE, "sportsdb_team_id", keys=("competition_code", "sportsdb_team_id")),
    Rule("enriched", ACCEPTED, "sportsdb_source", values=(SOURCE,)),
]
SOURCE_RULES = [
    Rule("clubs", NOT_EMPTY, "*"),
    Rule("clubs", NOT_NULL, "team_id"),
    Rule("clubs", UNIQUE, "team_id", keys=tuple(CLUB_KEY)),
]
CANDIDATE_RULES = [
    Rule("candidate", UNIQUE, "team_id", keys=tuple(CLUB_KEY)),
    Rule("candidate", ROW_RULE, "sportsdb_team_id", condition="coalesce(sportsdb_team_id, '') <> ''"),
    Rule("candidate", ROW_RULE, "sportsdb_badge_url", condition="coalesce(sportsdb_badge_url, '') <> ''"),
    Rule("candidate", UNIQUE, "sportsdb_team_id", keys=("competition_code", "sportsdb_team_id")),
]


def reviewed_overrides(spark: SparkSession) -> DataFrame:
    """The reviewed ids as override table of ``resolve_clubs``."""
    return spark.createDataFrame(list(REVIEWED_IDS.items()), "team_id bigint, sportsdb_team_id string")


def reference_rules(competitions: list[str]) -> list[Rule]:
    """Reference checks for a build that serves these competitions."""
    return [*REFERENCE_RULES, Rule("reference", ACCEPTED, "competition_code", values=tuple(competitions))]


def membership(clubs: DataFrame, reference: DataFrame) -> DataFrame:
    """Clubs against the reference, both ways: MATCHED, MISSING or OBSOLETE."""
    left = clubs.select(*CLUB_KEY).filter(F.col("team_id").isNotNull()).distinct()
    right = reference.select(*CLUB_KEY).filter(F.col("team_id").isNotNull()).distinct()
    joined = left.withColumn("_club", F.lit(True)).join(
        right.withColumn("_reference", F.lit(True)), CLUB_KEY, "full_outer"
    )
    status = (
        F.when(F.col("_reference").isNull(), F.lit("MISSING"))
        .when(F.col("_club").isNull(), F.lit("OBSOLETE"))
        .otherwise(F.lit("MATCHED"))
    )
    return joined.select(*CLUB_KEY, status.alias("membership"))


def enrich(clubs: DataFrame, reference: DataFrame) -> DataFrame:
    """Clubs with their artwork columns; clubs without a reference row keep NULLs.

    One-to-one is a contract (unique club key on both sides), checked by the rules above.
    """
    return clubs.join(reference.select(*CLUB_KEY, *ARTWORK_COLUMNS), CLUB_KEY, "left")


def badge_coverage(clubs: DataFrame) -> DataFrame:
    """Clubs, resolved clubs and clubs with a badge, per competition."""
    return clubs.groupBy("competition_code").agg(
        F.count(F.lit(1)).alias("team_count"),
        F.count("sportsdb_team_id").alias("resolved_count"),
        F.count("sportsdb_badge_url").alias("badge_count"),
    )


def best_by_name(candidates: DataFrame) -> DataFrame:
    """First soccer candidate per (name, country), in one combine: a name shared by very many
    candidates becomes one row per country before it meets the clubs."""
    found = F.struct("candidate_no", "sportsdb_team_id", "sportsdb_team_name", "badge_url", "sport")
    return (
        candidates.filter(F.col("sport") == SPORT)
        .groupBy(
            F.lower("sportsdb_team_name").alias("name_key"),
            F.lower("country").alias("candidate_country"),
        )
        .agg(F.min_by(found, F.col("candidate_no")).alias("found"))
    )


def resolve_clubs(
    clubs: DataFrame,
    overrides: DataFrame,
    candidates: DataFrame,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Artwork candidate for every club.

    ``clubs``: competition_code, team_id, team_name, preferred_country.
    ``overrides``: team_id, sportsdb_team_id. ``aliases``: team_name, search_name.
    ``candidates``: candidate_no (source order), sportsdb_team_id, sportsdb_team_name, sport,
    country, badge_url.

    A reviewed id decides alone. Otherwise the first soccer candidate of that name wins,
    preferring the club's country. Another sport is rejected; a missing badge is reported.
    """
    searched = clubs.join(overrides.withColumnRenamed("sportsdb_team_id", "known_id"), ["team_id"], "left")
    name = F.col("team_name")
    if aliases is not None:
        searched = searched.join(aliases, ["team_name"], "left")
        name = F.coalesce("search_name", "team_name")
    searched = searched.withColumn("name_key", F.lower(name))

    club = ["competition_code", "team_id", "team_name"]
    by_id_table = (
        candidates.join(overrides.select("sportsdb_team_id").distinct(), ["sportsdb_team_id"], "left_semi")
        .groupBy(F.col("sportsdb_team_id").alias("known_id"))
        .agg(
            F.min_by(
                F.struct("candidate_no", "sportsdb_team_id", "sportsdb_team_name", "badge_url", "sport"),
                F.col("candidate_no"),
            ).alias("found")
        )
    )
    by_id = (
        searched.filter(F.col("known_id").isNotNull())
        .join(by_id_table, ["known_id"], "left")
        .select(*club, F.lit(ID_OVERRIDE).alias("method"), "found")
    )
    abroad = ~F.coalesce(same_text(F.col("candidate_country"), F.col("preferred_country")), F.lit(False))
    by_name = (
        searched.filter(F.col("known_id").isNull())
        .join(best_by_name(candidates), ["name_key"], "left")
        .groupBy(*club)
        .agg(F.min_by("found", F.struct(abroad, F.col("found.candidate_no"))).alias("found"))
        .select(*club, F.lit(NAME_SEARCH).alias("method"), "found")
    )
    found = F.col("found")
    accepted = found["sport"] == SPORT
    status = (
        F.when(found.isNull(), F.lit("NOT_FOUND"))
        .when(~F.coalesce(accepted, F.lit(False)), F.lit("REJECTED_SPORT"))
        .when(F.coalesce(found["badge_url"], F.lit("")) == "", F.lit("NO_BADGE"))
        .otherwise(F.lit("RESOLVED"))
    )
    return by_id.unionByName(by_name).select(
        *club,
        F.when(accepted, found["sportsdb_team_id"]).alias("sportsdb_team_id"),
        F.when(accepted, found["sportsdb_team_name"]).alias("sportsdb_team_name"),
        F.when(accepted, found["badge_url"]).alias("sportsdb_badge_url"),
        F.lit(SOURCE).alias("sportsdb_source"),
        F.col("method").alias("sportsdb_resolution_method"),
        status.alias("status"),
    )


def candidate_size_check(candidate: DataFrame, clubs: DataFrame) -> DataFrame:
    """The candidate must have exactly one row per source club: |difference| as failures."""
    sizes = candidate.agg(F.count(F.lit(1)).alias("n")).unionByName(
        clubs.agg((-F.count(F.lit(1))).alias("n"))
    )
    return sizes.agg(F.abs(F.sum("n")).alias("failures")).select(
        F.lit("candidate").alias("model"),
        F.lit("*").alias("column_name"),
        F.lit("row_count").alias("rule"),
        F.col("failures").cast("bigint").alias("failures"),
    )
