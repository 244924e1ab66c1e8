"""History that goes on from stored blocks of rounds, compacted run logs, matrices by place, tables in buckets."""

from __future__ import annotations

import itertools
import random

from frames import match, matches, standing, standings, teams
from pyspark.sql import functions as F

from touchline.operators import LEAGUE, history, runlog, season
from touchline.operators.matches import filter_matches, match_explorer, of_named_club
from touchline.operators.participants import team_match_results
from touchline.operators.performance import derived_totals, round_sums, totals_of_rounds
from touchline.operators.standings import competition_reconciliation, reconcile_official, standings_reconciliation
from touchline.plans import progress
from touchline.sources import eventlog
from touchline.sources.tables import open_bucketed, write_bucketed

CLUBS = [1, 2, 3, 4]
PLACES = "competition_code string, season_id long, team_id long, short_name string, tla string, sportsdb_badge_url string, position int"


def table_of(spark, clubs):
    return spark.createDataFrame([(c, 1, n, f"C{n}", f"T{n}", None, n) for c, n in clubs], PLACES)


def rounds(code, first, last, seed=0, status="FINISHED"):
    rng = random.Random(f"{code}{seed}")
    rows = []
    for n in range(first, last + 1):
        for k, (a, b) in enumerate([(1, 2), (3, 4)]):
            score = (rng.randint(0, 3), rng.randint(0, 3)) if status == "FINISHED" else None
            number = 1000 * (code == "SA") + 10 * n + k
            rows.append(match(number, n, a, b, score, status=status, competition_code=code))
    return rows


def shown(rows):
    return sorted(map(tuple, rows.drop("short_name", "tla", "sportsdb_badge_url").collect()))


def test_resumed_history_equals_a_whole_one(spark, tmp_path):
    store = progress.round_store(spark, f"{tmp_path}/rounds")
    root = f"{tmp_path}/history"
    state = {"PD": rounds("PD", 1, 20) + rounds("PD", 21, 30, status="TIMED"), "SA": rounds("SA", 1, 12)}
    clubs = [(c, n) for c in ("PD", "SA") for n in CLUBS]
    seen = None

    def step(version, changed, clubs):
        nonlocal seen
        played = matches(spark, [r for code in changed for r in state[code]])
        seen = store.commit({"fact_match": progress.in_blocks(played)}, version, seen=seen)
        current = table_of(spark, clubs)
        commit = progress.refresh_history(spark, store, root, current, version)
        whole = matches(spark, list(itertools.chain(*state.values())))
        want = history.position_history(current, whole, team_match_results(whole))
        got = progress.stored_history(spark, root, current, commit).select(want.columns)
        assert shown(got) == shown(want)
        parts = progress.history_store(spark, root).parts("history", commit)
        return {r["part"]: r["attempt"] for r in parts.collect()}

    one = step("v1", ["PD", "SA"], clubs)
    state["PD"] = rounds("PD", 1, 20) + rounds("PD", 21, 26, seed=1) + rounds("PD", 27, 30, status="TIMED")
    two = step("v2", ["PD"], clubs)  # later rounds are played
    assert {p for p in one if one[p] == two[p]} == {"=PD/=1/=0", "=PD/=1/=1", "=SA/=1/=0", "=SA/=1/=1"}
    state["PD"][22] = {**state["PD"][22], "home_score": 9, "away_score": 0, "result": "H"}
    three = step("v3", ["PD"], clubs)  # round 12 is corrected
    assert {p for p in two if two[p] == three[p]} == {"=PD/=1/=0", "=SA/=1/=0", "=SA/=1/=1"}
    state["PD"][20] = {**state["PD"][20], "status": "POSTPONED", "home_score": None, "away_score": None, "result": None}
    step("v4", ["PD"], clubs)  # a gap in round 11 takes the later rounds away
    state["PD"] = state["PD"] + rounds("PD", 31, 33)
    step("v5", ["PD"], clubs)  # and nothing after the gap counts
    state["SA"].append(match(9000, None, 1, 2, (1, 0), competition_code="SA"))
    step("v6", ["SA"], clubs)  # a match without a round
    clubs = [*clubs, ("SA", 9)]
    six = step("v7", ["SA"], clubs)  # a new club stands in every round
    assert len(six) == len(progress.history_store(spark, root).parts("history", None).collect()) + 4
    step("v8", ["SA"], [c for c in clubs if c[0] == "SA"])  # a league without a table has no history


def test_resuming_reads_only_the_blocks_from_the_change_on(spark, tmp_path):
    store = progress.round_store(spark, f"{tmp_path}/rounds")
    current = table_of(spark, [("PD", n) for n in CLUBS])
    first = store.commit({"fact_match": progress.in_blocks(matches(spark, rounds("PD", 1, 30)))}, "v1")
    history_store = progress.history_store(spark, f"{tmp_path}/history")
    last = progress.refresh_history(spark, store, f"{tmp_path}/history", current, "v1")
    changed = progress.in_blocks(matches(spark, rounds("PD", 1, 24) + rounds("PD", 25, 32, seed=5)))
    after = store.commit({"fact_match": changed}, "v2", seen=first)
    points = progress.resume_points(store, first, after, history_store, last, current).collect()
    assert [tuple(p) for p in points] == [("=PD/=1", 3, 2)]


EVENT = "run_id string, event_id long, event_ts timestamp, event string, competition_code string, stage string, error_message string"


def run_events(spark, seed, runs, events):
    rng = random.Random(seed)
    rows = []
    for n in range(events):
        kind = rng.choice(["START", "STAGE", "STAGE", "SUCCESS", "FAILED", None, "OTHER"])
        run = None if n % 50 == 0 else f"r{0 if n % 3 == 0 else rng.randrange(runs)}"  # a third belong to one run
        rows.append((run, n, f"2026-01-01 00:00:{rng.randrange(60):02d}" if n % 17 else None, kind, "PD", rng.choice("ABC"), f"e{n}"))
    schema = EVENT.replace("timestamp", "string")
    return spark.createDataFrame(rows, schema).withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def folded(rows):
    return sorted(map(tuple, rows.collect()), key=repr)


def test_compacted_logs_fold_alike(spark, tmp_path):
    events = run_events(spark, 1, 40, 1200)
    want = folded(runlog.fold_runs(events))
    few = runlog.deciding_events(events)
    assert folded(runlog.fold_deciding(few)) == want and folded(runlog.fold_runs(few)) == want
    assert folded(runlog.deciding_events(events.unionByName(events))) == folded(few)
    assert few.groupBy("run_id").count().filter("count > 4").count() == 0
    root = str(tmp_path)
    for batch in range(5):
        eventlog.append_batch(events.filter(F.col("event_id") % 5 == batch), root, batch)
        if batch in (0, 2, 3):
            eventlog.compact(spark, root, events.schema, batch)
            eventlog.compact(spark, root, events.schema, batch)
    log = eventlog.read_log(spark, root, events.schema)
    assert folded(runlog.fold_deciding(runlog.deciding_events(log))) == want
    assert log.count() < events.count() / 2


def test_compaction_sorts_nothing_and_reads_the_tail_only(spark, tmp_path):
    events, root = run_events(spark, 2, 10, 300), str(tmp_path)
    for batch in range(3):
        eventlog.append_batch(events.filter(F.col("event_id") % 3 == batch), root, batch)
    eventlog.compact(spark, root, events.schema, 1)
    rows = runlog.fold_deciding(runlog.deciding_events(eventlog.read_log(spark, root, events.schema)))
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "batch" in text.split("PartitionFilters", 1)[1]
    assert runlog.fold_deciding(runlog.deciding_events(events.limit(0))).count() == 0


def test_matrix_by_place(spark):
    places = [("PD", 1, 1, "A", "ZZ", None, 1), ("PD", 1, 2, "B", None, None, 2), ("PD", 1, 3, "C", "ZZ", None, 3),
              ("SA", 1, 1, "A", "AA", None, 1)]
    current = spark.createDataFrame(places, PLACES)
    played = matches(spark, [match(1, 1, 1, 2, (2, 1)), match(2, 2, 3, 1, (0, 0)), match(3, 3, 1, 3, status="TIMED")])
    rows = {(r[0], r["home_team_id"]): r for r in season.fixture_matrix_slots(played, current).collect()}
    assert rows["PD", 1]["columns"] == ["B", "ZZ", "ZZ"] and rows["PD", 1]["slot"] == 2
    assert rows["PD", 1]["cells"] == ["2–1", "—", "·"] and rows["PD", 2]["cells"] == ["—", "·", "·"]
    assert rows["PD", 3]["cells"] == ["·", "0–0", "—"] and rows["SA", 1]["cells"] == ["—"]
    assert season.fixture_matrix_slots(played, current.limit(0)).count() == 0


def test_named_clubs_are_picked_before_their_columns_are_joined(spark):
    clubs = teams(spark, [1, 2, 3]).unionByName(teams(spark, [1, 4], "SA"))
    played = matches(spark, [match(1, 1, 1, 2, (1, 0)), match(2, 1, 3, 2, (1, 0)), match(3, 1, 4, 1, (1, 0), competition_code="SA")])
    for name in ("C1", "C2", "C4", "none"):
        whole = filter_matches(match_explorer(played, clubs), club=name)
        picked = filter_matches(match_explorer(of_named_club(played, clubs, name), clubs), club=name)
        assert sorted(r["match_id"] for r in picked.collect()) == sorted(r["match_id"] for r in whole.collect())
    plan = match_explorer(of_named_club(played, clubs, "C1"), clubs)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("Inner") < plan.index("LeftSemi")


def test_tables_in_the_same_buckets_join_without_a_shuffle(spark, tmp_path):
    hot = [match(n, n % 5 if n % 7 else None, 1, 2 + n % 3, (n % 4, 1)) for n in range(300)]  # one club plays in all
    results = team_match_results(matches(spark, hot))
    sums = round_sums(results)
    assert sums.count() <= 4 * 6
    derived = {tuple(r) for r in derived_totals(results).collect()}
    official = standings(spark, [standing(1, 1, 300), standing(2, 2), standing(9, 3)])
    keys = [*LEAGUE, "team_id"]
    stored = {
        name: write_bucketed(rows, f"{name}_in_buckets", f"{tmp_path}/{name}", keys, 4)
        for name, rows in {"official": official, "sums": sums}.items()
    }
    spark.sql("DROP TABLE sums_in_buckets")  # the files stay; another session opens them again
    stored["sums"] = open_bucketed(spark, "sums_again", f"{tmp_path}/sums", sums.schema, keys, 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = totals_of_rounds(stored["sums"])
        rows = reconcile_official(stored["official"], totals)
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in totals.collect()} == derived
        want = standings_reconciliation(official, results).collect()
        assert sorted(rows.collect(), key=repr) == sorted(want, key=repr) and len(want) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("official_in_buckets", "sums_again"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_reconciliation_over_seasons(spark):
    rows = [("PD", 1, True, "2026-01-01"), ("PD", 1, True, "2026-01-01"), ("PD", 2, True, "2027-01-01"), ("PD", 2, None, "2027-01-01"),
            ("SA", 1, True, None)]
    table = spark.createDataFrame(rows, "competition_code string, season_id long, is_reconciled boolean, snapshot_date string")
    got = sorted(tuple(r) for r in competition_reconciliation(table).collect())
    assert got == [("PD", 2, 1, 4, 3, 2, "2027-01-01"), ("SA", 1, 1, 1, 1, None, None)]
    assert competition_reconciliation(table.limit(0)).count() == 0
