"""Documents, tables, publication, the end-to-end build, incremental ingestion, run log."""

from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from frames import match, matches, standing, standings, teams
from pyspark.sql import functions as F

from touchline.operators import runlog
from touchline.operators.contracts import ContractError, Rule
from touchline.operators.resolve import ARTWORK_COLUMNS
from touchline.plans import warehouse
from touchline.plans.models import Models
from touchline.schemas import DIM_TEAM
from touchline.session import shared_dir
from touchline.sources import documents as docs
from touchline.sources import driver_tables as driver
from touchline.sources import tables as store
from touchline.streaming import incremental
from touchline.streaming.incremental import ingest_new_snapshots


def table_document(rows, season=1, matchday=3, kind="TOTAL"):
    table = [
        {"team": {"id": t}, "position": p, "playedGames": n, "won": 0, "draw": n, "lost": 0, "points": n,
         "goalsFor": 1, "goalsAgainst": 1, "goalDifference": 0}
        for t, p, n in rows
    ]
    return {
        "competition": {"id": 2014}, "season": {"id": season, "currentMatchday": matchday},
        "standings": [{"type": kind, "table": table}, {"type": "HOME", "table": table}],
    }


def put(root, competition, date, **documents):
    folder = root / competition / date
    folder.mkdir(parents=True, exist_ok=True)
    for name, document in documents.items():
        (folder / f"{name}.json").write_text(json.dumps(document, indent=2))


def test_folder_documents_flatten(spark, tmp_path):
    match_document = {
        "matches": [
            {"id": 1, "competition": {"id": 2014}, "season": {"id": 7}, "matchday": 1, "stage": "REGULAR_SEASON",
             "utcDate": "2026-08-15T19:00:00Z", "status": "FINISHED", "homeTeam": {"id": 77}, "awayTeam": {"id": 78},
             "score": {"winner": "AWAY_TEAM", "fullTime": {"home": 0, "away": 2}},
             "lastUpdated": "2026-08-16T00:20:00Z", "unknown": [1]},
            {"id": 2, "season": {"id": 7}, "status": "TIMED", "homeTeam": None, "awayTeam": {"id": 78}, "score": None},
        ]
    }
    team_document = {"teams": [{"id": 77, "name": "Athletic Club", "area": {"name": "Spain"}}]}
    put(tmp_path, "PD", "2026-08-30", matches={"matches": []}, standings=table_document([(77, 1, 1)]), teams=team_document)
    put(tmp_path, "PD", "2026-08-31", matches=match_document, standings=table_document([(77, 1, 2), (78, 2, 2)]), teams=team_document)
    root = str(tmp_path)

    newest = docs.newest_documents(docs.scan_folders(spark, root, "matches"))
    rows = {r["match_id"]: r for r in docs.flatten_matches(newest).collect()}
    assert rows[1]["result"] == "A" and rows[1]["competition_code"] == "PD"
    assert str(rows[1]["utc_date"]) == "2026-08-15 19:00:00" and rows[1]["source_snapshot_date"] == "2026-08-31"
    assert rows[2]["home_team_id"] is None and rows[2]["home_score"] is None and rows[2]["utc_date"] is None

    every = docs.flatten_standings(docs.scan_folders(spark, root, "standings")).collect()
    assert sorted((r["snapshot_date"], r["team_id"], r["played"]) for r in every) == [
        ("2026-08-30", 77, 1), ("2026-08-31", 77, 2), ("2026-08-31", 78, 2),
    ]
    club = docs.flatten_teams(docs.newest_documents(docs.scan_folders(spark, root, "teams"))).first()
    assert (club["team_name"], club["country"], club["founded"]) == ("Athletic Club", "Spain", None)


def test_malformed_documents_fail_the_read(spark, tmp_path):
    put(tmp_path, "PD", "2026-08-31", standings=table_document([(77, 1, 1)]))
    (tmp_path / "PD" / "2026-08-31" / "standings.json").write_text('{"standings": [')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        docs.flatten_standings(docs.scan_folders(spark, str(tmp_path), "standings")).collect()
    docs.land(driver.standing_documents(standings(spark, [standing(1, 1)])), str(tmp_path), "standings")
    folder = tmp_path / "standings" / "competition_code=PD" / "snapshot_date=2026-08-31"
    (folder / "part-broken.json").write_text('{"standings": [\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        docs.flatten_standings(docs.scan(spark, str(tmp_path), "standings")).collect()


def test_reference_document(spark, tmp_path):
    path = tmp_path / "reference.json"
    path.write_text(json.dumps({
        "competition_code": "PD", "team_count": 1,
        "teams": [{"football_data_team_id": 77, "football_data_team_name": "Athletic Club", "sportsdb_team_id": "133727",
                   "sportsdb_source": "TheSportsDB", "sportsdb_fetched_at": "2026-08-31T18:12:10.810821+00:00"}],
    }))
    row = docs.read_reference(spark, str(path)).first()
    assert (row["team_id"], row["sportsdb_team_id"], row["sportsdb_badge_url"]) == (77, "133727", None)
    assert str(row["sportsdb_fetched_at"]) == "2026-08-31 18:12:10.810821"


def test_reference_roundtrip(spark, tmp_path):
    clubs = teams(spark, [2, 1])
    reference = clubs.select("competition_code", "team_id", *ARTWORK_COLUMNS).withColumn(
        "sportsdb_fetched_at", F.lit("2026-08-31 18:12:10.5").cast("timestamp")
    )
    written = docs.reference_documents(reference, clubs, "2026-08-31")
    written.write.json(str(tmp_path / "r"))
    header = written.first()
    assert (header["team_count"], header["resolved_count"], header["badge_count"]) == (2, 2, 2)
    back = docs.read_reference(spark, str(tmp_path / "r"))
    assert sorted(map(tuple, back.drop("team_name").collect())) == sorted(map(tuple, reference.collect()))


def test_newest_snapshots_come_from_file_names(spark, tmp_path):
    raw = str(tmp_path)
    rows = [standing(1, 1), standing(1, 2, date="2026-09-01"), standing(1, 3, competition_code="S A")]
    docs.land(driver.standing_documents(standings(spark, rows)), raw, "standings")
    found = docs.newest_snapshots(docs.landed_snapshots(spark, raw, "standings"))
    assert {tuple(r) for r in found.collect()} == {("PD", "2026-09-01"), ("S A", "2026-08-31")}

    def positions(documents):
        rows = docs.flatten_standings(documents).select("competition_code", "position").collect()
        return sorted(map(tuple, rows))

    joined = docs.only_snapshots(docs.scan(spark, raw, "standings"), found)
    assert positions(joined) == [("PD", 2), ("S A", 3)]
    # A malformed document in an older folder is never opened.
    (tmp_path / "standings" / "competition_code=PD" / "snapshot_date=2026-08-31" / "broken.json").write_text("{")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert positions(joined) == [("PD", 2), ("S A", 3)]
    newest = docs.scan_newest(spark, raw, "standings")
    # Its folders are named to the reader, so no other one is listed.
    assert "InMemoryFileIndex(2 paths)" in newest._jdf.queryExecution().executedPlan().toString()
    assert positions(newest) == [("PD", 2), ("S A", 3)]


def test_documents_put_there_by_others_can_be_noted(spark, tmp_path):
    raw = str(tmp_path)
    document = driver.standing_documents(standings(spark, [standing(1, 1)]))
    document.write.partitionBy("competition_code", "snapshot_date").json(f"{raw}/standings")
    assert docs.scan_newest(spark, raw, "standings").count() == 0
    docs.note_landed(docs.listed_snapshots(spark, raw, "standings"), raw, "standings")
    assert docs.scan_newest(spark, raw, "standings").count() == 1
    store = docs.catalogue(spark, raw)
    before = store.newest()
    docs.land(driver.standing_documents(standings(spark, [standing(1, 7)])), raw, "standings")  # the same date again
    assert [tuple(r) for r in store.changed(before, store.newest()).collect()] == [("standings", "=PD/=2026-08-31")]


def test_documents_without_a_competition_are_kept(spark, tmp_path):
    rows = [standing(1, 1), standing(1, 2, competition_code=None), standing(1, 3, competition_code=None, date="2026-09-01")]
    docs.land(driver.standing_documents(standings(spark, rows)), str(tmp_path), "standings")
    newest = docs.scan_newest(spark, str(tmp_path), "standings").collect()
    got = {(r["competition_code"], r["snapshot_date"]) for r in newest}
    assert len(newest) == 2 and got == {("PD", "2026-08-31"), (None, "2026-09-01")}


def test_a_rejected_retry_leaves_readers_alone(spark, tmp_path):
    root, rules = str(tmp_path), [Rule("clubs", "unique", "team_id")]
    store.publish(spark, {"clubs": teams(spark, [1, 2])}, root, "v1", rules)
    with pytest.raises(ContractError):
        store.publish(spark, {"clubs": teams(spark, [1, 1, 1])}, root, "v1", rules)
    assert store.read_published(spark, root, {"clubs": DIM_TEAM})["clubs"].count() == 2


def test_rewriting_a_snapshot_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "table")
    first = standings(spark, [standing(1, 1, date="2026-08-30"), standing(1, 1, date="2026-08-31"), standing(2, 2, date="2026-08-31")])
    store.write_snapshots(first, path)
    store.write_snapshots(standings(spark, [standing(1, 9, date="2026-08-31")]), path)
    rows = store.read_by_name(spark, path).select("snapshot_date", "team_id", "position").collect()
    assert sorted(map(tuple, rows)) == [("2026-08-30", 1, 1), ("2026-08-31", 1, 9)]


def test_files_unite_by_name(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.createDataFrame([(1, "a")], "team_id int, old string").write.parquet(f"{path}/snapshot_date=2026-01-01")
    spark.createDataFrame([(5, 2)], "points int, team_id int").write.parquet(f"{path}/snapshot_date=2026-01-02")
    table = store.read_by_name(spark, path)
    assert dict(table.dtypes)["snapshot_date"] == "string"
    rows = table.select("team_id", "old", "points", "snapshot_date").collect()
    assert sorted(map(tuple, rows)) == [(1, "a", None, "2026-01-01"), (2, None, 5, "2026-01-02")]


def test_failed_check_keeps_the_published_version(spark, tmp_path):
    root, rules = str(tmp_path), [Rule("clubs", "unique", "team_id"), Rule("clubs", "not_empty", "*")]
    store.publish(spark, {"clubs": teams(spark, [1, 2])}, root, "v1", rules)
    for bad in (teams(spark, [1, 1]), teams(spark, [1]).limit(0)):
        with pytest.raises(ContractError):
            store.publish(spark, {"clubs": bad}, root, "v2", rules)
        assert store.current_version(spark, root) == "v1"
        assert store.read_published(spark, root, {"clubs": DIM_TEAM})["clubs"].count() == 2
    store.publish(spark, {"clubs": teams(spark, [1, 2, 3])}, root, "v3", rules)
    assert store.read_published(spark, root, {"clubs": DIM_TEAM})["clubs"].count() == 3


def test_build_end_to_end(spark, sf_dir, tmp_path):
    tables = Models(driver.load(spark, sf_dir))
    nation, region = driver.read(spark, sf_dir, "nation"), driver.read(spark, sf_dir, "region")
    raw = str(tmp_path / "raw")
    clean = tables["fact_standing_snapshot"].filter("played = won + drawn + lost")
    docs.land(driver.match_documents(tables["fact_match"]), raw, "matches")
    docs.land(driver.standing_documents(clean), raw, "standings")
    docs.land(driver.team_documents(driver.clubs_from_nations(nation, region)), raw, "teams")
    log = str(tmp_path / "log")
    paths = {"raw_root": raw, "processed_root": str(tmp_path / "p"), "warehouse_root": str(tmp_path / "w"), "log_path": log}
    reference = driver.reference_from_nations(nation)
    with pytest.raises(ContractError, match="MISSING"):
        warehouse.build(spark, "r0", reference=reference.filter("team_id <> 3"), competitions=driver.COMPETITIONS, **paths)
    models = warehouse.build(spark, "r1", reference=reference, competitions=driver.COMPETITIONS, **paths)
    assert models["mart_match_explorer"].count() == 1500
    schema = models["mart_team_performance"].schema
    marts = warehouse.mart_store(spark, f"{tmp_path}/w/marts", tables)
    want = {(r["team_performance_key"], r["points"]) for r in tables["mart_team_performance"].collect()}
    assert {(r["team_performance_key"], r["points"]) for r in marts.read("mart_team_performance").collect()} == want
    assert schema == marts.read("mart_team_performance").schema
    runs = {r["run_id"]: r for r in runlog.fold_runs(warehouse.read_events(spark, log)).collect()}
    assert (runs["r0"]["status"], runs["r0"]["failed_stage"]) == ("FAILED", "TRANSFORMATION")
    assert "MISSING" in runs["r0"]["error_message"]
    with pytest.raises(ContractError, match="stg_matches.competition_code accepted_values"):
        warehouse.refresh_marts(spark, warehouse.base_store(spark, paths["processed_root"]), str(tmp_path / "w2"), "r2", ["L0"])
    assert marts.newest().version == "r1"
    assert (runs["r1"]["status"], runs["r1"]["current_stage"], runs["r1"]["failed_stage"]) == ("SUCCESS", "COMPLETE", None)
    assert runs["r1"]["duration_seconds"] > 0


def test_seasons_and_relegated_clubs_stay(spark, tmp_path):
    raw, log = str(tmp_path / "raw"), str(tmp_path / "log")
    paths = {"raw_root": raw, "processed_root": str(tmp_path / "p"), "warehouse_root": str(tmp_path / "w"), "log_path": log}

    def season(number, date, ids, more=()):
        clubs = teams(spark, ids)
        a, b, c = ids
        played = [match(10 * number, 1, a, b, (1, 0)), match(10 * number + 1, 1, c, a, (0, 0)), *more]
        rows = [
            standing(a, 1, 2, 1, 1, 0, 1, 0, 4, date=date, season_id=number),
            standing(b, 3, 1, 0, 0, 1, 0, 1, 0, date=date, season_id=number),
            standing(c, 2, 1, 0, 1, 0, 0, 0, 1, date=date, season_id=number),
        ]
        played = [{"season_id": number, "source_snapshot_date": date, **m} for m in played]
        docs.land(driver.match_documents(matches(spark, played)), raw, "matches")
        docs.land(driver.standing_documents(standings(spark, rows)), raw, "standings")
        docs.land(driver.team_documents(clubs).withColumn("snapshot_date", F.lit(date)), raw, "teams")
        reference = clubs.select("competition_code", "team_id", "team_name", *ARTWORK_COLUMNS).withColumn(
            "sportsdb_fetched_at", F.lit("2026-08-31").cast("timestamp")
        )
        return warehouse.build(spark, f"r{date}", reference=reference, competitions=["PD"], **paths)

    season(1, "2026-06-01", [1, 2, 3])
    models = season(2, "2027-06-01", [1, 2, 4])  # club 3 is relegated
    seasons = {(r["season_id"], r["match_id"]) for r in models["stg_matches"].collect()}
    assert seasons == {(1, 10), (1, 11), (2, 20), (2, 21)}
    assert {r["team_id"] for r in models["stg_teams"].collect()} == {1, 2, 3, 4}
    table = models["mart_current_standings"].collect()
    assert {(r["season_id"], r["team_id"]) for r in table} == {(s, t) for s, last in ((1, 3), (2, 4)) for t in (1, 2, last)}
    assert all(r["is_reconciled"] for r in table)
    # A newer snapshot of a season replaces its matches and leaves the other season alone.
    models = season(2, "2027-06-02", [1, 2, 4], more=[match(22, 2, 2, 4, None, "TIMED")])
    assert {r["match_id"] for r in models["stg_matches"].collect()} == {10, 11, 20, 21, 22}
    assert models["stg_teams"].count() == 4


def test_nothing_is_published_at_first(spark, tmp_path):
    assert store.current_version(spark, str(tmp_path)) is None
    with pytest.raises(FileNotFoundError):
        store.read_published(spark, str(tmp_path), {"clubs": DIM_TEAM})


def test_publish_reference(spark, tmp_path):
    root, clubs = str(tmp_path), teams(spark, [1, 2])
    candidate = clubs.select("competition_code", "team_id", *ARTWORK_COLUMNS)
    warehouse.publish_reference(spark, candidate, clubs, root, "v1")
    with pytest.raises(ContractError, match="sportsdb_badge_url"):
        warehouse.publish_reference(
            spark, candidate.withColumn("sportsdb_badge_url", F.lit("")), clubs, root, "v2"
        )
    with pytest.raises(ContractError, match="row_count"):
        warehouse.publish_reference(spark, candidate.filter("team_id = 1"), clubs, root, "v3")
    assert store.current_version(spark, f"{root}/reference") == "v1"
    assert spark.read.parquet(f"{root}/audit/v3").count() == 1  # the rejected candidate stays


def snapshot_rows(spark, path):
    rows = store.read_by_name(spark, path).select("competition_code", "snapshot_date", "season_id", "team_id", "position")
    return sorted(map(tuple, rows.collect()))


def test_incremental_ingestion_equals_batch(spark, tmp_path):
    raw, table, state = (str(tmp_path / n) for n in ("raw", "table", "state"))

    def land(rows):
        docs.land(driver.standing_documents(standings(spark, rows)), raw, "standings")

    def ingest():
        ingest_new_snapshots(spark, raw, "standings", table, state, files_per_batch=1)

    # Two seasons of one snapshot land as separate documents and, one file per batch, in
    # separate micro-batches.
    land([standing(1, 1), standing(1, 1, season_id=2), standing(1, 1, competition_code="SA")])
    ingest()
    land([standing(1, 2, date="2026-09-01")])
    ingest()
    ingest()  # nothing new
    land([standing(1, 5), standing(2, 6)])  # a re-landed date replaces, and loses season 2
    ingest()
    want = sorted(
        map(
            tuple,
            docs.flatten_standings(docs.scan(spark, raw, "standings"))
            .select("competition_code", "snapshot_date", "season_id", "team_id", "position")
            .collect(),
        )
    )
    assert snapshot_rows(spark, table) == want == [
        ("PD", "2026-08-31", 1, 1, 5), ("PD", "2026-08-31", 1, 2, 6), ("PD", "2026-09-01", 1, 1, 2),
        ("SA", "2026-08-31", 1, 1, 1),
    ]


def test_other_datasets_ingest_incrementally(spark, tmp_path):
    raw = str(tmp_path / "raw")
    played = matches(spark, [match(i, 1, 1, 2, (1, 0), source_snapshot_date="2026-08-31") for i in range(1, 4)])
    docs.land(driver.match_documents(played), raw, "matches")
    docs.land(driver.team_documents(teams(spark, [1, 2])), raw, "teams")
    for dataset in ("matches", "teams"):
        ingest_new_snapshots(spark, raw, dataset, str(tmp_path / dataset), str(tmp_path / f"{dataset}-state"))
    kept = store.read_by_name(spark, str(tmp_path / "matches"))
    assert kept.count() == 3 and kept.select("result").distinct().first()["result"] == "H"
    assert store.read_by_name(spark, str(tmp_path / "teams")).count() == 2


def test_replayed_stream_gives_the_same_table(spark, tmp_path):
    raw, table = str(tmp_path / "raw"), str(tmp_path / "table")
    docs.land(driver.standing_documents(standings(spark, [standing(1, 1), standing(2, 2)])), raw, "standings")
    ingest_new_snapshots(spark, raw, "standings", table, str(tmp_path / "a"))
    before = snapshot_rows(spark, table)
    ingest_new_snapshots(spark, raw, "standings", table, str(tmp_path / "b"))  # lost checkpoint
    assert snapshot_rows(spark, table) == before and len(before) == 2


def test_a_changed_snapshot_is_written_once(spark, tmp_path, monkeypatch):
    raw, table, state = (str(tmp_path / n) for n in ("raw", "table", "state"))
    written = []

    def counting(rows, path):
        written.append({(r["snapshot_date"], r["season_id"]) for r in rows.collect()})
        store.write_snapshots(rows, path)

    def failing(rows, path):
        raise OSError("lost")

    def land(rows):
        docs.land(driver.standing_documents(standings(spark, rows)), raw, "standings")

    def ingest():
        ingest_new_snapshots(spark, raw, "standings", table, state, files_per_batch=1)

    # Six documents of one snapshot, one file each, come in six batches.
    for number in range(6):
        document = driver.standing_documents(standings(spark, [standing(1, 1, season_id=number)]))
        document.coalesce(1).write.mode("append").partitionBy("competition_code", "snapshot_date").json(f"{raw}/standings")
    monkeypatch.setattr(incremental, "write_snapshots", counting)
    ingest()
    assert written == [{("2026-08-31", n) for n in range(6)}]
    ingest()  # nothing new, nothing written
    assert len(written) == 1
    # A call that ends between the stream and the write leaves its batches to the next one.
    land([standing(1, 2, date="2026-09-01")])
    monkeypatch.setattr(incremental, "write_snapshots", failing)
    with pytest.raises(OSError, match="lost"):
        ingest()
    monkeypatch.setattr(incremental, "write_snapshots", counting)
    ingest()
    assert written[1:] == [{("2026-09-01", 1)}] and len(snapshot_rows(spark, table)) == 7


def test_run_log_folding(spark):
    def at(second):
        return f"2026-08-31 10:00:{second:02d}"

    events = [
        ("a", 1, at(0), "START", "PD", None, None), ("a", 2, at(1), "STAGE", None, "API_INGESTION", None),
        ("a", 3, at(9), "SUCCESS", None, None, None),
        ("b", 4, at(2), "START", "PD", None, None), ("b", 5, at(4), "FAILED", None, "DBT_BUILD", "boom"),
        ("c", 6, at(3), "START", "PD", None, None),
        ("d", 7, at(1), "FAILED", None, "DBT_BUILD", "early"), ("d", 8, at(2), "START", "PD", None, None),
        ("d", 9, at(2), "STAGE", None, "TRANSFORMATION", None),
        ("e", 10, at(5), "SUCCESS", None, None, None),  # never started
    ]
    frame = spark.createDataFrame(
        events, "run_id string, event_id bigint, ts string, event string, competition_code string, stage string, error_message string"
    ).withColumn("event_ts", F.col("ts").cast("timestamp"))
    runs = runlog.fold_runs(frame)
    rows = {r["run_id"]: r for r in runs.collect()}
    assert set(rows) == {"a", "b", "c", "d"}
    assert (rows["a"]["status"], rows["a"]["current_stage"], rows["a"]["duration_seconds"]) == ("SUCCESS", "COMPLETE", 9.0)
    assert (rows["b"]["current_stage"], rows["b"]["failed_stage"], rows["b"]["error_message"]) == ("FAILED", "DBT_BUILD", "boom")
    assert (rows["c"]["status"], rows["c"]["current_stage"], rows["c"]["finished_at"]) == ("RUNNING", "STARTING", None)
    assert (rows["d"]["status"], rows["d"]["current_stage"], rows["d"]["failed_stage"]) == ("RUNNING", "TRANSFORMATION", None)
    assert [r["run_id"] for r in runlog.latest_runs(runs, 2).collect()] == ["c", "b"]
    assert runlog.run_history(runs, 1).first()["started"] == "31 Aug 2026 • 10:00 UTC"


def test_shared_dir_follows_the_session(spark):
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=settings.get))

    cluster = {"spark.master": "yarn"}
    assert shared_dir(session(**cluster, **{"spark.checkpoint.dir": "s3://b/shared/"})) == "s3://b/shared"
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        shared_dir(session(**cluster))
    assert shared_dir(spark)
