"""Registered queries and their reference SQL.

``entry`` runs the flagship query, ``queries`` maps every query name to a function of
(session, table folder), ``oracle_sql`` gives the equivalent SQL on the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import LEAGUE, clubs, contracts, health, history, matches, performance
from touchline.operators import resolve, rounds, runlog, season, standings
from touchline.operators.keyfilter import SLOTS
from touchline.operators.participants import clubs_of
from touchline.plans import progress, warehouse
from touchline.plans.models import BUILDERS, SOURCES, Models
from touchline.schemas import FACT_STANDING_SNAPSHOT, MATCHES_DOCUMENT
from touchline.session import scratch_folder, tune
from touchline.sources import documents as docs
from touchline.sources import driver_tables as driver
from touchline.sources.commits import Store
from touchline.sources.eventlog import append_batch, compact, read_log
from touchline.sources.tables import (
    publish, read_by_name, read_published, read_table, write_bucketed, write_snapshots, write_table,
)
from touchline.streaming.incremental import ingest_new_snapshots

Query = Callable[[SparkSession, str], DataFrame]

TEAMS, MATCHES, STANDINGS = "stg_teams", "stg_matches", "stg_standings"
RESULTS, RECONCILIATION = "int_team_match_results", "int_standings_reconciliation"
CURRENT, PERFORMANCE = "mart_current_standings", "mart_team_performance"
EXPLORER = "mart_match_explorer"


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(driver.load(tune(spark), sf_dir))


def _on(build: Callable[..., DataFrame], *names: str, **options) -> Query:
    """A query applying ``build`` to the named models."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = models(spark, sf_dir)
        return build(*[found[name] for name in names], **options)

    return run


def _model(name: str) -> Query:
    return lambda spark, sf_dir: models(spark, sf_dir)[name]


# --- composed queries ---------------------------------------------------------------


def _match_list(explorer: DataFrame) -> DataFrame:
    return matches.explorer_order(explorer).select(
        "match_id", "competition_code", "season_id", "matchday", "utc_date", "status", "match_state",
        "home_team_id", "home_team", "home_tla", "home_badge_url",
        "away_team_id", "away_team", "away_tla", "away_badge_url",
        "home_score", "away_score", "scoreline", "result",
    )


def _filtered(table: DataFrame, teams: DataFrame) -> DataFrame:
    explorer = matches.match_explorer(matches.of_named_club(table, teams, "Nation 7"), teams)
    return _match_list(matches.filter_matches(explorer, club="Nation 7", state="Finished"))


def _matrix_slots(table: DataFrame, current: DataFrame) -> DataFrame:
    rows = season.fixture_matrix_slots(table, current)
    return rows.withColumns({name: F.array_join(name, "|") for name in ("columns", "cells")})


def _completed(table: DataFrame) -> DataFrame:
    return rounds.completed_rounds(rounds.round_status(table))


def _latest_completed(table: DataFrame) -> DataFrame:
    return rounds.latest_finished_round(rounds.round_status(table))


def _history(current: DataFrame, table: DataFrame, results: DataFrame) -> DataFrame:
    return history.history_order(history.position_history(current, table, results))


def _history_rounds(current: DataFrame, table: DataFrame, results: DataFrame) -> DataFrame:
    return history.history_rounds(history.position_history(current, table, results))


def _race_view(current: DataFrame, table: DataFrame, results: DataFrame) -> DataFrame:
    return history.race_history(history.history_rows(current, table, results))


def _race_bounds(current: DataFrame, table: DataFrame, results: DataFrame) -> DataFrame:
    return history.race_bounds(history.history_rows(current, table, results))


def _form_strip(table: DataFrame, teams: DataFrame) -> DataFrame:
    return clubs.form_strip(clubs.form_matches(table, teams))


# --- contracts ----------------------------------------------------------------------


def _contract(rules: list[contracts.Rule]) -> Query:
    return lambda spark, sf_dir: contracts.failures(models(spark, sf_dir), rules)


def _dq_violating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows breaking any row rule, of every table that has one."""
    keys = {
        "fact_standing_snapshot": ["competition_code", "season_id", "snapshot_date", "team_id"],
        "fact_match": ["match_id"],
    }
    found = models(spark, sf_dir)
    parts = [
        contracts.violating_rows(
            found[name], F.concat_ws("-", *key), [r for r in contracts.ROW_RULES if r.model == name]
        )
        for name, key in keys.items()
    ]
    return parts[0].unionByName(parts[1])


def _load_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of the base tables before a load; L9 is served but has no rows."""
    return contracts.failures(models(spark, sf_dir), contracts.fact_rules([*driver.COMPETITIONS, "L9"]))


def _matrix_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = models(spark, sf_dir)
    current = found[CURRENT]
    return season.fixture_matrix_wide(found[MATCHES], current, season.matrix_columns(current))


def _dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return contracts.duplicate_keys(driver.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _dq_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    customer, events = (driver.read(spark, sf_dir, name) for name in ("customer", "events"))
    return contracts.orphan_keys(
        customer, ["c_custkey"], events, ["user_id"], parent_unique=False
    )


def _dq_orphan_keys_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one segment without an urgent finished order; orders of others are not shuffled."""
    tune(spark)
    customer, orders = (driver.read(spark, sf_dir, name) for name in ("customer", "orders"))
    child = customer.filter("c_mktsegment = 'BUILDING'")
    urgent = orders.filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    return contracts.orphan_keys(
        child, ["c_custkey"], urgent, ["o_custkey"], parent_unique=False, filter_slots=SLOTS
    )


# --- reference and resolution -------------------------------------------------------


def _current_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    played = clubs_of(models(spark, sf_dir)[MATCHES])
    return played.select("competition_code", "team_id").distinct()


def _reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver.reviewed_reference(driver.read(spark, sf_dir, "nation"))


def _membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.membership(_current_clubs(spark, sf_dir), _reviewed(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.enrich(_current_clubs(spark, sf_dir), _reviewed(spark, sf_dir))


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.badge_coverage(_enriched(spark, sf_dir))


def _reference_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of the reviewed reference, by a build that does not serve L2."""
    tune(spark)
    return contracts.failures({"reference": _reviewed(spark, sf_dir)}, resolve.reference_rules(["L0", "L1"]))


def _source_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of the clubs that artwork is searched for."""
    return contracts.failures({"clubs": _current_clubs(spark, sf_dir)}, resolve.SOURCE_RULES)


def _resolution_inputs(spark: SparkSession, sf_dir: str, aliased: bool = False) -> tuple[DataFrame, DataFrame]:
    tune(spark)
    nation, region, supplier = (driver.read(spark, sf_dir, n) for n in ("nation", "region", "supplier"))
    searched = driver.clubs_from_nations(nation, region).select(
        "competition_code", "team_id", "team_name", F.col("country").alias("preferred_country")
    )
    candidates = driver.candidates_from_suppliers(supplier, nation, region)
    return searched, resolve.resolve_clubs(
        searched,
        driver.overrides_from_suppliers(supplier),
        candidates,
        driver.search_aliases(nation) if aliased else None,
    )


def _resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolution_inputs(spark, sf_dir)[1]


def _aliased_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolution_inputs(spark, sf_dir, aliased=True)[1]


def _candidate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of the written candidate, as before publication: clubs are resolved once."""
    searched, candidate = _resolution_inputs(spark, sf_dir)
    path = f"{scratch_folder(spark)}/candidate"
    write_table(candidate, path)
    kept = spark.read.schema(candidate.schema).parquet(path)
    report = contracts.failures({"candidate": kept}, resolve.CANDIDATE_RULES)
    return report.unionByName(resolve.candidate_size_check(kept, searched))


# --- run log ------------------------------------------------------------------------


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return runlog.fold_runs(driver.run_events(driver.read(spark, sf_dir, "events")))


def _runs_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in four batches, compacted twice on the way, then folded with what came after."""
    root = scratch_folder(tune(spark))
    events = driver.run_events(driver.read(spark, sf_dir, "events"))
    for batch in range(4):
        append_batch(events.filter(F.col("event_id") % 4 == batch), root, batch)
        if batch in (1, 2):
            compact(spark, root, events.schema, batch)
    return runlog.fold_deciding(runlog.deciding_events(read_log(spark, root, events.schema)))


# --- raw documents ------------------------------------------------------------------


def _json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents serialised to JSON text, parsed with the explicit schema, flattened."""
    documents = driver.match_documents(models(spark, sf_dir)["fact_match"])
    text = documents.select(
        "competition_code", "snapshot_date", F.to_json(F.struct("matches")).alias("body")
    )
    parsed = text.select(
        "competition_code", "snapshot_date", F.from_json("body", MATCHES_DOCUMENT, {"mode": "FAILFAST"}).alias("d")
    ).select("competition_code", "snapshot_date", "d.matches")
    return docs.flatten_matches(parsed).drop("loaded_at")


def _landed_standings(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_folder(spark)
    documents = driver.standing_documents(models(spark, sf_dir)["fact_standing_snapshot"])
    docs.land(documents, f"{root}/raw", "standings")
    return root


def _typed_standings(table: DataFrame) -> DataFrame:
    return table.select(
        "competition_id", "competition_code", "season_id", "snapshot_matchday", "snapshot_date",
        "team_id", "position", "played", "won", "drawn", "lost", "goals_for", "goals_against",
        "goal_difference", "points", "form",
    )


def _snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land documents, scan them, write per-snapshot tables, read them back by name."""
    root = _landed_standings(spark, sf_dir)
    write_snapshots(docs.flatten_standings(docs.scan(spark, f"{root}/raw", "standings")), f"{root}/table")
    return _typed_standings(read_by_name(spark, f"{root}/table", FACT_STANDING_SNAPSHOT))


def _latest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flatten only each competition's newest landed snapshot."""
    root = _landed_standings(spark, sf_dir)
    return _typed_standings(docs.flatten_standings(docs.scan_newest(spark, f"{root}/raw", "standings")))


def _incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream landed documents into the snapshot table, in several micro-batches."""
    root = _landed_standings(spark, sf_dir)
    ingest_new_snapshots(
        spark, f"{root}/raw", "standings", f"{root}/table", f"{root}/checkpoint", files_per_batch=8
    )
    return _typed_standings(read_by_name(spark, f"{root}/table", FACT_STANDING_SNAPSHOT))


def _published_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the standings under a version, and read what readers then get."""
    root = scratch_folder(spark)
    table = _typed_standings(models(spark, sf_dir)[STANDINGS])
    rules = [contracts.Rule("standings", "not_empty", "*"), contracts.Rule("standings", "not_null", "team_id")]
    publish(spark, {"standings": table}, root, "v1", rules)
    return read_published(spark, root, {"standings": table.schema})["standings"]


def _two_commits(spark: SparkSession, sf_dir: str, between: Callable[[Store], None]) -> Store:
    """Base tables in two commits: one competition's matches lack scores in the first."""
    store = warehouse.base_store(spark, scratch_folder(spark))
    found = models(spark, sf_dir)
    late = F.col("competition_code") == driver.COMPETITIONS[0]
    fact = found["fact_match"]
    unscored = fact.withColumns({c: F.when(~late, F.col(c)) for c in ("home_score", "away_score", "result")})
    first = store.commit({**{name: found[name] for name in SOURCES}, "fact_match": unscored}, "v1")
    between(store)
    store.commit({"fact_match": fact.filter(late)}, "v2", seen=first)
    return store


def _published_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit three tables together, replace some leagues of one, and read what readers get."""
    return _two_commits(spark, sf_dir, lambda store: None).read("fact_match").drop("loaded_at")


def _incremental_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts of the first commit, brought up to the second by the leagues it changed."""
    root = scratch_folder(spark)

    def refresh(store: Store, version: str = "v1") -> Models:
        return warehouse.refresh_marts(spark, store, root, version, driver.COMPETITIONS, rules=[])

    return refresh(_two_commits(spark, sf_dir, refresh), "v2")[PERFORMANCE]


def _history_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History stored while the later rounds are still to come, then brought up to date: only the
    later blocks of rounds are read."""
    root = scratch_folder(spark)
    found = models(spark, sf_dir)
    fact, current = progress.in_blocks(found["fact_match"]), found[CURRENT]
    store = progress.round_store(spark, f"{root}/rounds")
    late = F.coalesce(F.col("block") >= 3, F.lit(False))
    unplayed = {"status": F.when(late, "TIMED").otherwise(F.col("status"))} | {
        c: F.when(~late, F.col(c)) for c in ("home_score", "away_score", "result")
    }
    first = store.commit({"fact_match": fact.withColumns(unplayed)}, "v1")
    progress.refresh_history(spark, store, f"{root}/history", current, "v1")
    store.commit({"fact_match": fact.filter(late)}, "v2", seen=first)
    last = progress.refresh_history(spark, store, f"{root}/history", current, "v2")
    return history.history_order(progress.stored_history(spark, f"{root}/history", current, last))


def _latest_standings_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each league's newest table, found among the names of committed parts."""
    store = warehouse.base_store(spark, scratch_folder(spark))
    name = "fact_standing_snapshot"
    commit = store.commit({name: models(spark, sf_dir)[name]}, "v1")
    return _typed_standings(store.read(name, commit, store.newest_parts(name, commit, LEAGUE, "snapshot_date")))


def _dq_at_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of all models, counted while each model is written once from stored ones."""
    root = scratch_folder(spark)
    stored = dict(driver.load(tune(spark), sf_dir))

    def write(name: str, rows: DataFrame) -> DataFrame:
        write_table(rows, f"{root}/{name}")
        stored[name] = read_table(spark, f"{root}/{name}", rows.schema)
        return stored[name]

    rules = contracts.model_rules(["L0", "L1"])
    return contracts.write_and_check({name: lambda n=name: Models(stored)[n] for name in BUILDERS}, rules, write)


def _drifted_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of different ages as one table: one column was dropped, one added, one widened."""
    path = scratch_folder(spark)
    fact = models(spark, sf_dir)["fact_match"]
    early, late = fact.filter("season_id < 2001"), fact.filter("season_id >= 2001")
    write_table(early.select("match_id", "stage", F.col("matchday").cast("short").alias("matchday")), f"{path}/age=early")
    write_table(late.select("home_score", "matchday", "match_id"), f"{path}/age=late")
    return read_by_name(spark, path, "match_id bigint, matchday int, home_score int, stage string, age string")


def _reference_rows(rows: DataFrame) -> DataFrame:
    return rows.select("competition_code", "team_id", *resolve.ARTWORK_COLUMNS)


def _reference_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the reviewed reference as documents, load it, and let it pass its checks."""
    path = scratch_folder(spark)
    nation, region = (driver.read(tune(spark), sf_dir, name) for name in ("nation", "region"))
    reference = driver.reference_from_nations(nation).drop("team_name")
    documents = docs.reference_documents(reference, driver.clubs_from_nations(nation, region), "2001-07-01")
    documents.write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)  # a file holds one document
    loaded = docs.read_reference(spark, path)
    contracts.gate(contracts.failures({"reference": loaded}, resolve.reference_rules(driver.COMPETITIONS)))
    return _reference_rows(loaded)


def _reference_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a complete candidate reference, let a broken one fail, and read the current one."""
    root = scratch_folder(spark)
    nation, region = (driver.read(tune(spark), sf_dir, name) for name in ("nation", "region"))
    found = driver.clubs_from_nations(nation, region)
    candidate = _reference_rows(driver.reference_from_nations(nation))
    warehouse.publish_reference(spark, candidate, found, root, "v1")
    try:
        warehouse.publish_reference(spark, candidate.filter("team_id <> 3"), found, root, "v2")
    except contracts.ContractError:
        return _reference_rows(read_published(spark, f"{root}/reference", {"candidate": candidate.schema})["candidate"])
    raise AssertionError("an incomplete reference was published")


def _colocated_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest official tables and the sums of rounds in the same buckets: compared without a shuffle."""
    root = scratch_folder(spark)
    found = models(spark, sf_dir)
    keys, buckets = [*LEAGUE, "team_id"], int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = {"official": standings.latest_per_league(found[STANDINGS]), "rounds": performance.round_sums(found[RESULTS])}
    stored = {
        name: write_bucketed(rows, f"{name}_{uuid4().hex}", f"{root}/{name}", keys, buckets)
        for name, rows in tables.items()
    }
    return standings.reconcile_official(stored["official"], performance.totals_of_rounds(stored["rounds"]))


def _files_flatten_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land match documents as JSON files, scan and flatten them."""
    root = scratch_folder(spark)
    docs.land(driver.match_documents(models(spark, sf_dir)["fact_match"]), f"{root}/raw", "matches")
    return docs.flatten_matches(docs.scan(spark, f"{root}/raw", "matches")).drop("loaded_at")


def _files_flatten_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land club documents as JSON files, scan and flatten them."""
    root = scratch_folder(spark)
    nation, region = (driver.read(tune(spark), sf_dir, name) for name in ("nation", "region"))
    docs.land(driver.team_documents(driver.clubs_from_nations(nation, region)), f"{root}/raw", "teams")
    return docs.flatten_teams(docs.scan(spark, f"{root}/raw", "teams")).drop("loaded_at")


def _club_fixtures(explorer: DataFrame) -> DataFrame:
    return _match_list(matches.fixtures_of(explorer, 7))


def _chosen_history(current: DataFrame, table: DataFrame, results: DataFrame) -> DataFrame:
    found = history.position_history(current, table, results)
    return history.history_order(history.club_history(found, ["Nation 3", "Nation 7"]))


# --- registry -----------------------------------------------------------------------


def core_queries() -> dict[str, Query]:
    """The league queries by name."""
    return {
        "stg_matches": _model(MATCHES),
        "stg_teams": _model(TEAMS),
        "stg_standings": _model(STANDINGS),
        "team_match_results": _model(RESULTS),
        "team_performance": _on(performance.performance_order, PERFORMANCE),
        "match_explorer": _model(EXPLORER),
        "match_list": _on(_match_list, EXPLORER),
        "match_explorer_filtered": _on(_filtered, MATCHES, TEAMS),
        "club_fixtures": _on(_club_fixtures, EXPLORER),
        "chosen_history": _on(_chosen_history, CURRENT, MATCHES, RESULTS),
        "published_standings": _published_standings,
        "published_base": _published_base,
        "incremental_marts": _incremental_marts,
        "latest_standings_by_part": _latest_standings_by_part,
        "history_resumed": _history_resumed,
        "dq_at_write": _dq_at_write,
        "drifted_union": _drifted_union,
        "reference_loaded": _reference_loaded,
        "reference_published": _reference_published,
        "files_flatten_matches": _files_flatten_matches,
        "files_flatten_teams": _files_flatten_teams,
        "club_options": _on(clubs.club_options, MATCHES, TEAMS),
        "recent_matches": _on(matches.recent_matches, MATCHES, TEAMS),
        "upcoming_matches": _on(matches.upcoming_matches, MATCHES, TEAMS),
        "match_status_summary": _on(matches.status_summary, MATCHES),
        "match_state_summary": _on(matches.state_summary, EXPLORER),
        "match_kpis": _on(matches.match_kpis, MATCHES),
        "season_completion": _on(matches.season_completion, MATCHES),
        "kickoff_labels": _on(matches.kickoff_labels, EXPLORER),
        "goals_by_matchday": _on(rounds.goals_by_round, MATCHES),
        "default_matchday": _on(rounds.default_round, MATCHES),
        "latest_completed_round": _on(_latest_completed, MATCHES),
        "matchday_window": _on(rounds.round_window, MATCHES),
        "matchday_neighbours": _on(rounds.round_neighbours, MATCHES),
        "latest_standings": _on(standings.latest_per_league, STANDINGS),
        "snapshot_freshness": _on(standings.snapshot_freshness, STANDINGS),
        "reconciliation": _model(RECONCILIATION),
        "colocated_reconciliation": _colocated_reconciliation,
        "multi_season_reconciliation": _on(standings.competition_reconciliation, RECONCILIATION),
        "reconciliation_detail": _on(standings.reconciliation_detail, CURRENT),
        "unreconciled": _on(standings.unreconciled, CURRENT),
        "reconciliation_summary": _on(standings.reconciliation_summary, CURRENT),
        "current_standings": _on(standings.table_order, CURRENT),
        "league_table": _on(standings.league_table, CURRENT),
        "matchday_status": _on(rounds.round_status, MATCHES),
        "completed_matchdays": _on(_completed, MATCHES),
        "position_history": _on(_history, CURRENT, MATCHES, RESULTS),
        "position_rounds": _on(_history_rounds, CURRENT, MATCHES, RESULTS),
        "race_view": _on(_race_view, CURRENT, MATCHES, RESULTS),
        "race_bounds": _on(_race_bounds, CURRENT, MATCHES, RESULTS),
        "points_race": _on(standings.points_race, CURRENT),
        "league_highlights": _on(standings.league_highlights, CURRENT),
        "top10_table": _on(standings.top_of_table, CURRENT),
        "top10_ppg": _on(standings.top_by_points_per_game, PERFORMANCE),
        "form_last5": _on(clubs.form_matches, MATCHES, TEAMS),
        "form_strip": _on(_form_strip, MATCHES, TEAMS),
        "club_recent": _on(clubs.recent_fixtures, MATCHES, TEAMS),
        "club_upcoming": _on(clubs.upcoming_fixtures, MATCHES, TEAMS),
        "club_season_strip": _on(clubs.season_strip, MATCHES, TEAMS),
        "club_record": _on(clubs.club_record, CURRENT, PERFORMANCE),
        "official_vs_derived": _on(clubs.official_vs_derived, CURRENT, PERFORMANCE),
        "home_vs_away": _on(performance.home_vs_away, PERFORMANCE),
        "fixture_matrix": _on(season.fixture_matrix, MATCHES, CURRENT),
        "fixture_matrix_wide": _matrix_wide,
        "fixture_matrix_slots": _on(_matrix_slots, MATCHES, CURRENT),
        "dq_not_null": _contract(contracts.not_null_rules()),
        "dq_unique": _contract(contracts.unique_rules()),
        # L2 is deliberately not among the served competitions, so the check has failures.
        "dq_accepted": _contract(contracts.accepted_rules(["L0", "L1"])),
        "dq_relationships": _contract(contracts.relationship_rules()),
        "load_gate": _load_gate,
        "dq_row_rules": _contract(contracts.ROW_RULES),
        "dq_violating_rows": _dq_violating_rows,
        "dq_duplicate_keys": _dq_duplicate_keys,
        "dq_orphan_keys": _dq_orphan_keys,
        "dq_orphan_keys_filtered": _dq_orphan_keys_filtered,
        "reference_checks": _reference_checks,
        "source_checks": _source_checks,
        "reference_membership": _membership,
        "reference_enriched": _enriched,
        "badge_coverage": _coverage,
        "entity_resolution": _resolution,
        "entity_resolution_aliases": _aliased_resolution,
        "candidate_checks": _candidate_checks,
        "health_overview": _on(health.health_overview, MATCHES, STANDINGS, CURRENT),
        "model_row_counts": lambda spark, sf_dir: models(spark, sf_dir).inventory(),
        "run_log": _runs,
        "run_log_compacted": _runs_compacted,
        "pipeline_runs": lambda spark, sf_dir: runlog.latest_runs(_runs(spark, sf_dir)),
        "run_history": lambda spark, sf_dir: runlog.run_history(_runs(spark, sf_dir)),
        "latest_run_line": lambda spark, sf_dir: runlog.latest_run_line(_runs(spark, sf_dir)),
        "json_flatten": _json_flatten,
        "snapshot_roundtrip": _snapshot_roundtrip,
        "latest_documents": _latest_documents,
        "incremental_ingest": _incremental_ingest,
    }


def _present(module: str) -> bool:
    try:
        return find_spec(module) is not None
    except ModuleNotFoundError:
        return False


def has_text_operators() -> bool:
    """The text operators and their pipeline are an optional part of the library."""
    return _present("touchline.llm.queries") and _present("corpus_pipeline")


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    found = core_queries()
    if has_text_operators():
        import corpus_pipeline
        from touchline.llm.queries import QUERIES

        found |= QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: league position after every completed round."""
    return queries()["position_history"](spark, "/root/testdata/sf0.001")


def oracle_sql() -> dict[str, str]:
    """Equivalent SQL for every league query and for the text queries that SQL can express."""
    from oracle_queries import ORACLE

    found = dict(ORACLE)
    if has_text_operators():
        import corpus_pipeline
        from touchline.llm.oracle import ORACLE as TEXT_ORACLE

        found |= TEXT_ORACLE
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
