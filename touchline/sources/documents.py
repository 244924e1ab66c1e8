"""Raw JSON documents: landing, scanning, latest snapshot, flattening."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.clock import utc_timestamp
from touchline.functions.outcomes import winner_code
from touchline.schemas import DOCUMENTS, REFERENCE_DOCUMENT
from touchline.sources.commits import Store, key_value, part_of

SNAPSHOT = ["competition_code", "snapshot_date"]
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for NULL


def catalogue(spark: SparkSession, root: str) -> Store:
    """What has landed: a part for each dataset's snapshots, without data of its own. A commit's
    manifest lists all of them, so the newest ones are found without listing a folder."""
    return Store(spark, f"{root}/_landed", {name: (document_schema(name), SNAPSHOT) for name in DOCUMENTS})


def land(documents: DataFrame, root: str, dataset: str) -> None:
    """Write documents as JSON lines under ``<root>/<dataset>/competition_code=/snapshot_date=``.

    Landing a date again replaces that date and leaves the others alone. Rebalancing keeps
    files evenly sized when one competition or date dominates. Last, the snapshots are noted in
    the catalogue, whose readers take no notice of them before that.
    """
    (
        documents.hint("rebalance", *SNAPSHOT)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SNAPSHOT)
        .json(f"{root}/{dataset}")
    )
    note_landed(documents.select(*SNAPSHOT).distinct(), root, dataset)


def note_landed(snapshots: DataFrame, root: str, dataset: str) -> None:
    """Note snapshots in the catalogue: new ones, and changed ones under a new mark."""
    spark, mark = snapshots.sparkSession, uuid4().hex
    parts = snapshots.select(
        F.lit(dataset).alias("table_name"), part_of(SNAPSHOT).alias("part"), F.lit(mark).alias("attempt"),
        F.lit(None).cast("bigint").alias("row_count"), F.lit(None).cast("string").alias("checksum"),
    )
    catalogue(spark, root).note(parts, mark, forced=True)


def document_schema(dataset: str) -> str:
    return f"{DOCUMENTS[dataset]}, competition_code string, snapshot_date string"


def scan(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Landed documents of one dataset with their snapshot columns.

    A malformed document fails the read instead of losing its rows.
    """
    return (
        spark.read.schema(document_schema(dataset)).option("mode", "FAILFAST").json(f"{root}/{dataset}")
    )


def scan_folders(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Pretty-printed documents laid out as ``<root>/<competition>/<date>/<dataset>.json``."""
    folders = F.split(F.col("_metadata.file_path"), "/")
    return (
        spark.read.schema(DOCUMENTS[dataset])
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(f"{root}/*/*/{dataset}.json")
        .select(
            "*",
            F.element_at(folders, -3).alias("competition_code"),
            F.element_at(folders, -2).alias("snapshot_date"),
        )
    )


def landed_snapshots(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """(competition_code, snapshot_date) of what has landed, from the catalogue."""
    store = catalogue(spark, root)
    parts = store.parts(dataset, store.newest())
    return parts.select(*[key_value(F.col("part"), i).alias(name) for i, name in enumerate(SNAPSHOT)])


def listed_snapshots(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """(competition_code, snapshot_date) of the files that are there, from their names only.

    The file listing is a table here; no document is opened. ``note_landed`` brings documents
    into the catalogue that others have put there.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .load(f"{root}/{dataset}")
    )

    def folder(name: str) -> Column:
        value = F.url_decode(F.regexp_extract("path", f"/{name}=([^/]+)/", 1))
        return F.nullif(value, F.lit(NO_VALUE)).alias(name)

    return files.select(*[folder(name) for name in SNAPSHOT]).distinct()


def newest_snapshots(snapshots: DataFrame) -> DataFrame:
    """Each competition's newest snapshot."""
    return snapshots.groupBy("competition_code").agg(F.max("snapshot_date").alias("snapshot_date"))


def _snapshot_name() -> Column:
    return F.concat_ws("/", *[F.coalesce(c, F.lit(NO_VALUE)) for c in SNAPSHOT])


def only_snapshots(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents of the wanted snapshots; a missing competition is a value like any other.

    A join on a name made of the folder columns, which Spark turns into a filter on the folders
    while the query runs: other folders are not read, and no name comes to the driver.
    """
    names = wanted.select(_snapshot_name().alias("wanted_name")).filter(F.length("wanted_name") > 0).distinct()
    return documents.join(names, _snapshot_name() == F.col("wanted_name"), "left_semi")


def scan_newest(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Landed documents of each competition's newest snapshot.

    Its folder is known from the catalogue, so only these folders are listed and read; the driver
    gets one short name per competition.
    """
    newest = newest_snapshots(landed_snapshots(spark, root, dataset)).select(*SNAPSHOT).collect()
    if not newest:
        return spark.createDataFrame([], document_schema(dataset))
    named = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    folders = ["/".join([f"{root}/{dataset}", *(named(c, r[c]) for c in SNAPSHOT)]) for r in newest]
    documents = spark.read.schema(document_schema(dataset)).option("mode", "FAILFAST")
    return documents.option("basePath", f"{root}/{dataset}").json(folders)


def newest_documents(documents: DataFrame) -> DataFrame:
    """Documents of each competition's newest snapshot, for an already loaded set."""
    return only_snapshots(documents, newest_snapshots(documents))


def flatten_teams(documents: DataFrame) -> DataFrame:
    """``teams[]`` to one row per club and snapshot, without artwork columns."""
    return documents.select(*SNAPSHOT, F.explode("teams").alias("t")).select(
        F.col("t.id").alias("team_id"),
        F.col("t.name").alias("team_name"),
        F.col("t.shortName").alias("short_name"),
        "t.tla",
        F.col("t.area.name").alias("country"),
        F.col("t.venue").alias("venue_name"),
        "t.founded",
        F.col("t.clubColors").alias("club_colors"),
        F.col("t.crest").alias("crest_url"),
        *SNAPSHOT,
        F.current_timestamp().alias("loaded_at"),
    )


def flatten_matches(documents: DataFrame) -> DataFrame:
    """``matches[]`` to one row per match."""
    return documents.select(*SNAPSHOT, F.explode("matches").alias("m")).select(
        F.col("m.id").alias("match_id"),
        F.col("m.competition.id").alias("competition_id"),
        "competition_code",
        F.col("m.season.id").alias("season_id"),
        "m.matchday",
        "m.stage",
        utc_timestamp(F.col("m.utcDate")).alias("utc_date"),
        "m.status",
        F.col("m.homeTeam.id").alias("home_team_id"),
        F.col("m.awayTeam.id").alias("away_team_id"),
        F.col("m.score.fullTime.home").alias("home_score"),
        F.col("m.score.fullTime.away").alias("away_score"),
        winner_code(F.col("m.score.winner")).alias("result"),
        utc_timestamp(F.col("m.lastUpdated")).alias("source_last_updated"),
        F.col("snapshot_date").alias("source_snapshot_date"),
        F.current_timestamp().alias("loaded_at"),
    )


def flatten_standings(documents: DataFrame) -> DataFrame:
    """Overall (``TOTAL``) tables to one row per club and snapshot."""
    header = [
        F.col("competition.id").alias("competition_id"),
        "competition_code",
        F.col("season.id").alias("season_id"),
        F.col("season.currentMatchday").alias("snapshot_matchday"),
        "snapshot_date",
    ]
    groups = documents.select(*header, F.explode("standings").alias("g"))
    total = groups.filter(F.col("g.type") == "TOTAL")
    rows = total.select("*", F.explode("g.table").alias("r"))
    return rows.select(
        "competition_id", "competition_code", "season_id", "snapshot_matchday", "snapshot_date",
        F.col("r.team.id").alias("team_id"),
        "r.position",
        F.col("r.playedGames").alias("played"),
        "r.won",
        F.col("r.draw").alias("drawn"),
        "r.lost",
        F.col("r.goalsFor").alias("goals_for"),
        F.col("r.goalsAgainst").alias("goals_against"),
        F.col("r.goalDifference").alias("goal_difference"),
        "r.points",
        "r.form",
        F.current_timestamp().alias("loaded_at"),
    )


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """Reviewed artwork reference: one typed row per club, keyed like the club table."""
    documents = (
        spark.read.schema(REFERENCE_DOCUMENT)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
    )
    return documents.select("competition_code", F.explode("teams").alias("t")).select(
        "competition_code",
        F.col("t.football_data_team_id").cast("bigint").alias("team_id"),
        F.col("t.football_data_team_name").alias("team_name"),
        "t.sportsdb_team_id",
        "t.sportsdb_team_name",
        "t.sportsdb_badge_url",
        "t.sportsdb_source",
        "t.sportsdb_resolution_method",
        utc_timestamp(F.col("t.sportsdb_fetched_at")).alias("sportsdb_fetched_at"),
    )


def reference_documents(reference: DataFrame, clubs: DataFrame, snapshot_date: str) -> DataFrame:
    """The reference as one document per competition, with its header counts.

    A document holds one competition's clubs, as in the reviewed file.
    """
    named = reference.join(
        clubs.select("competition_code", "team_id", "team_name"), ["competition_code", "team_id"]
    )
    item = F.struct(
        F.col("team_id").alias("football_data_team_id"),
        F.col("team_name").alias("football_data_team_name"),
        "sportsdb_team_id", "sportsdb_team_name", "sportsdb_badge_url", "sportsdb_source",
        "sportsdb_resolution_method",
        F.date_format("sportsdb_fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("sportsdb_fetched_at"),
    )
    return named.groupBy("competition_code").agg(
        F.lit(snapshot_date).alias("source_snapshot_date"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("refreshed_at"),
        F.count(F.lit(1)).cast("int").alias("team_count"),
        F.count("sportsdb_team_id").cast("int").alias("resolved_count"),
        F.count("sportsdb_badge_url").cast("int").alias("badge_count"),
        F.sort_array(F.collect_list(item)).alias("teams"),
    )


FLATTEN = {
    "teams": flatten_teams,
    "matches": flatten_matches,
    "standings": flatten_standings,
}
