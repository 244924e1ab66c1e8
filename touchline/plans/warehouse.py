"""End-to-end build: landed documents -> processed tables -> published models."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import LEAGUE
from touchline.operators.contracts import NOT_EMPTY, Rule, fact_rules, failures, gate, model_rules
from touchline.operators.resolve import (
    CANDIDATE_RULES,
    CLUB_KEY,
    ENRICHED_RULES,
    SOURCE_RULES,
    candidate_size_check,
    enrich,
    membership,
    reference_rules,
)
from touchline.operators.runlog import FAILED, STAGE, START, SUCCESS
from touchline.plans.models import MARTS, SOURCES, Models
from touchline.schemas import DIM_TEAM, RUN_EVENT, column_names
from touchline.session import scratch_folder
from touchline.sources import documents as docs
from touchline.sources.commits import Commit, Store, part_of
from touchline.sources.tables import publish, read_table, write_table

INTERMEDIATE = "int_team_match_results"


# --- run log --------------------------------------------------------------------


def log_event(
    spark: SparkSession,
    path: str,
    run_id: str,
    event: str,
    competition_code: str | None = None,
    stage: str | None = None,
    error_message: str | None = None,
) -> None:
    """Append one event; events are never updated."""
    now = F.current_timestamp()
    spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.unix_micros(now).alias("event_id"),
        now.alias("event_ts"),
        F.lit(event).alias("event"),
        F.lit(competition_code).cast("string").alias("competition_code"),
        F.lit(stage).cast("string").alias("stage"),
        F.lit(error_message).cast("string").alias("error_message"),
    ).write.mode("append").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_EVENT).parquet(path)


# --- stages -----------------------------------------------------------------------


def club_dimension(clubs: DataFrame, reference: DataFrame, competitions: list[str]) -> DataFrame:
    """Clubs with artwork, after the reference contracts and exact membership hold."""
    gate(failures({"reference": reference}, reference_rules(competitions)))
    gate(
        membership(clubs, reference)
        .filter(F.col("membership") != "MATCHED")
        .groupBy("competition_code", "membership")
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(
            F.col("competition_code").alias("model"),
            F.lit("team_id").alias("column_name"),
            F.col("membership").alias("rule"),
            "failures",
        )
    )
    return enrich(clubs, reference)


def base_store(spark: SparkSession, root: str) -> Store:
    """The processed tables: clubs by competition, matches by league, tables by league and date."""
    keys = {"dim_team": ["competition_code"], "fact_match": LEAGUE, "fact_standing_snapshot": [*LEAGUE, "snapshot_date"]}
    return Store(spark, root, {name: (schema, keys[name]) for name, schema in SOURCES.items()})


def transform(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    reference: DataFrame,
    competitions: list[str],
) -> Commit:
    """Flatten the newest landed snapshots into checked processed tables, in one commit.

    Documents are parsed once, into staged tables; the checks read those, and they are what is
    written. Leagues and snapshot dates that the newest documents do not hold keep their rows,
    as do all that come out as they were. So do clubs of earlier seasons, which older matches
    refer to; the reference must match the current clubs only.
    """
    staging = scratch_folder(spark)
    store = base_store(spark, processed_root)
    seen = store.newest()

    def staged(name: str, rows: DataFrame) -> DataFrame:
        write_table(rows, f"{staging}/{name}")
        return read_table(spark, f"{staging}/{name}", rows.schema)

    newest = {
        name: staged(name, flatten(docs.scan_newest(spark, raw_root, name)))
        for name, flatten in docs.FLATTEN.items()
    }
    enriched = staged("enriched", club_dimension(newest["teams"], reference, competitions))
    gate(failures({"enriched": enriched}, ENRICHED_RULES))
    teams = enriched.select(*column_names(DIM_TEAM))
    replaced = None
    if seen:
        earlier = store.read("dim_team", seen).join(teams.select("competition_code").distinct(), "competition_code", "left_semi")
        teams = teams.unionByName(earlier.join(teams, CLUB_KEY, "left_anti").select(*teams.columns))
        # A date that has landed again replaces all leagues it had before.
        dates = newest["standings"].select(part_of(["competition_code", "snapshot_date"]).alias("date")).distinct()
        parts = store.parts("fact_standing_snapshot", seen)
        names = F.split("part", "/")
        dated = parts.select("part", F.concat_ws("/", F.get(names, F.lit(0)), F.get(names, F.lit(2))).alias("date"))
        replaced = dated.join(dates, "date", "left_semi").select(F.lit("fact_standing_snapshot").alias("table_name"), "part")
    tables = {
        "dim_team": staged("dim_team", teams),
        "fact_match": newest["matches"],
        "fact_standing_snapshot": newest["standings"],
    }
    version = staging.rsplit("/", 1)[-1]
    return store.commit(tables, version, fact_rules(competitions), seen=seen, replaced=replaced)


def load_base_tables(spark: SparkSession, processed_root: str, commit: Commit | None = None) -> dict[str, DataFrame]:
    """The processed tables as of one commit, by default the newest."""
    store = base_store(spark, processed_root)
    commit = commit or store.newest()
    return {name: store.read(name, commit) for name in SOURCES}


def mart_store(spark: SparkSession, root: str, models: Models) -> Store:
    """The published marts, by league."""
    return Store(spark, root, {name: (models[name].schema, LEAGUE) for name in MARTS})


def _league(part: Column) -> Column:
    return F.substring_index(part, "/", 2)


def _competition(part: Column) -> Column:
    return F.substring_index(part, "/", 1)


def affected_parts(base: Store, before: Commit | None, after: Commit, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """What the marts of changed leagues are made of: parts by table, and the leagues.

    A changed match table or snapshot touches its league, a changed club table all leagues of its
    competition. Of a league's snapshots only the newest one counts. Found from the names of
    parts alone, and kept as a small table in ``folder``.
    """
    changed = base.changed(before, after)
    clubs = changed.filter("table_name = 'dim_team'").select(F.col("part").alias("competition"))
    facts = changed.filter("table_name <> 'dim_team'").select(_league(F.col("part")).alias("league"))
    newest = base.newest_parts("fact_standing_snapshot", after, LEAGUE, "snapshot_date").select("part", "attempt")
    current = base.manifest(after).select("table_name", "part", "attempt")
    named = (
        current.filter("table_name <> 'fact_standing_snapshot'")
        .unionByName(current.join(newest, ["part", "attempt"], "left_semi").filter("table_name = 'fact_standing_snapshot'").select(*current.columns))
        .withColumn("league", F.when(F.col("table_name") != "dim_team", _league(F.col("part"))))
        .withColumn("competition", _competition(F.col("part")))
    )
    # A league that is gone from the base still has rows to lose.
    leagues = named.join(clubs, "competition", "left_semi").select("league").unionByName(facts).filter("league IS NOT NULL").distinct()
    leagues.write.parquet(f"{folder}/leagues")
    leagues = base.spark.read.schema("league string").parquet(f"{folder}/leagues")
    competitions = leagues.select(_competition(F.col("league")).alias("competition")).distinct()
    wanted = named.filter("league IS NOT NULL").join(leagues, "league", "left_semi")
    dims = named.filter("league IS NULL").join(competitions, "competition", "left_semi")
    columns = ["table_name", "part", "attempt"]
    wanted.select(*columns).unionByName(dims.select(*columns)).coalesce(1).write.parquet(f"{folder}/parts")
    parts = base.spark.read.schema("table_name string, part string, attempt string").parquet(f"{folder}/parts")
    return {name: parts.filter(F.col("table_name") == name).drop("table_name") for name in SOURCES}, leagues


def refresh_marts(
    spark: SparkSession,
    base: Store,
    root: str,
    version: str,
    competitions: Iterable[str],
    rules: list[Rule] | None = None,
) -> Models:
    """Bring the marts up to the newest base commit, computing only leagues that have changed.

    The marts' last commit names the base commit it was made from. Leagues whose parts differ
    since are built from their own parts, checked, and replace their rows in all marts at once;
    others are neither read nor written. The participant rows feed three models, so they are
    written once and read back. The rules are the models' own unless others are given.
    """
    after = base.newest()
    if after is None:
        raise FileNotFoundError(f"nothing committed under {base.root}")
    whole = Models({name: base.read(name, after) for name in SOURCES})
    marts = mart_store(spark, f"{root}/marts", whole)
    last = marts.newest()
    before = base.commit_of(last.base) if last else None
    if before is None or before.number < after.number:
        staging = scratch_folder(spark)
        parts, leagues = affected_parts(base, before, after, staging)
        tables = {name: base.read(name, after, found) for name, found in parts.items()}
        results = Models(tables)[INTERMEDIATE]
        write_table(results, f"{staging}/{INTERMEDIATE}", LEAGUE)
        models = Models({**tables, INTERMEDIATE: read_table(spark, f"{staging}/{INTERMEDIATE}", results.schema)})
        gone = [leagues.select(F.lit(name).alias("table_name"), F.col("league").alias("part")) for name in MARTS]
        last = marts.commit(
            {name: models[name] for name in MARTS},
            version,
            model_rules(competitions) if rules is None else rules,
            seen=last,
            replaced=reduce(DataFrame.unionByName, gone),
            context=models,
            base=after.number,
        )
    return Models({**{name: whole[name] for name in SOURCES}, **{name: marts.read(name, last) for name in MARTS}})


def publish_reference(
    spark: SparkSession, candidate: DataFrame, clubs: DataFrame, root: str, version: str
) -> None:
    """Keep the resolved candidate for audit; publish it as reference only if it is complete."""
    gate(failures({"clubs": clubs}, SOURCE_RULES))
    audit = f"{root}/audit/{version}"
    write_table(candidate, audit)
    kept = spark.read.schema(candidate.schema).parquet(audit)
    gate(candidate_size_check(kept, clubs))
    publish(spark, {"candidate": kept}, f"{root}/reference", version, CANDIDATE_RULES)


def build(
    spark: SparkSession,
    run_id: str,
    raw_root: str,
    processed_root: str,
    warehouse_root: str,
    log_path: str,
    reference: DataFrame,
    competitions: list[str],
) -> Models:
    """All stages with run-log events; a failing stage is logged and re-raised."""
    done: dict[str, Store | Models] = {}

    def transform_stage() -> None:
        transform(spark, raw_root, processed_root, reference, competitions)

    def load_stage() -> None:
        store = base_store(spark, processed_root)
        commit = store.newest()
        present = {name: store.parts(name, commit).select("part") for name in SOURCES}
        gate(failures(present, [Rule(name, NOT_EMPTY, "*") for name in SOURCES]))
        done["base"] = store

    def model_stage() -> None:
        done["models"] = refresh_marts(spark, done["base"], warehouse_root, run_id, competitions)

    log_event(spark, log_path, run_id, START, competition_code=",".join(competitions))
    for stage, action in (
        ("TRANSFORMATION", transform_stage),
        ("WAREHOUSE_LOAD", load_stage),
        ("MODEL_BUILD", model_stage),
    ):
        log_event(spark, log_path, run_id, STAGE, stage=stage)
        try:
            action()
        except Exception as error:
            log_event(spark, log_path, run_id, FAILED, stage=stage, error_message=str(error))
            raise
    log_event(spark, log_path, run_id, SUCCESS)
    return done["models"]
