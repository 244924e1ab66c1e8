"""Commits of several tables, and marts that follow them."""

from __future__ import annotations

import threading

import pytest
from frames import match, matches, standing, standings, teams
from pyspark.sql import functions as F

from touchline.operators import LEAGUE
from touchline.operators.contracts import FACT_RULES, ContractError, Observed, Rule, failures, row_failures, write_and_check
from touchline.plans import warehouse
from touchline.plans.models import MARTS, SOURCES, Models
from touchline.schemas import FACT_MATCH
from touchline.session import create_once, read_text
from touchline.sources import commits
from touchline.sources.commits import Conflict, Store


def base_tables(spark, leagues, goals=1):
    """Two clubs and two matches in each (competition, season)."""
    played, rows, clubs = [], [], []
    for n, (code, season) in enumerate(leagues):
        more = {"competition_code": code, "season_id": season}
        played += [match(10 * n, 1, 1, 2, (goals, 0), **more), match(10 * n + 1, 2, 2, 1, (0, 0), **more)]
        dates = ("2026-08-30", "2026-08-31")
        rows += [standing(1, 1, 2, 1, 1, 0, goals, 0, 4, date=d, **more) for d in dates]
        rows += [standing(2, 2, 2, 0, 1, 1, 0, goals, 1, date=d, **more) for d in dates]
    for code in dict.fromkeys(c for c, _ in leagues):
        clubs.append(teams(spark, [1, 2], code))
    dim = clubs[0]
    for c in clubs[1:]:
        dim = dim.unionByName(c)
    dim = dim.withColumn("sportsdb_fetched_at", F.lit("2026-08-31").cast("timestamp"))
    return {"dim_team": dim, "fact_match": matches(spark, played), "fact_standing_snapshot": standings(spark, rows)}


LEAGUES = [("PD", 1), ("PD", 2), ("SA", 1)]


def formatted(frame):
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")


def scores(store):
    rows = store.read("fact_match").select(*LEAGUE, "match_id", "home_score").collect()
    return sorted(map(tuple, rows), key=repr)


def test_a_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/a/1.json"
    results = []
    threads = [threading.Thread(target=lambda k=k: results.append(create_once(spark, path, f"text {k}"))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(results) == [False] * 7 + [True] and read_text(spark, path).startswith("text ")
    assert [f.name for f in (tmp_path / "a").iterdir() if not f.name.startswith(".")] == ["1.json"]


def test_parts_are_replaced_and_read_by_pruning(spark, tmp_path):
    store = warehouse.base_store(spark, str(tmp_path))
    assert store.newest() is None
    with pytest.raises(FileNotFoundError):
        store.read("fact_match")
    first = store.commit(base_tables(spark, LEAGUES), "v1", FACT_RULES)
    second = store.commit({"fact_match": base_tables(spark, [("PD", 2)], 3)["fact_match"].withColumn("match_id", F.col("match_id") + 90)}, "v2", seen=first)
    assert (second.number, store.newest()) == (2, second)
    assert scores(store) == [("PD", 1, 0, 1), ("PD", 1, 1, 0), ("PD", 2, 90, 3), ("PD", 2, 91, 0), ("SA", 1, 20, 1), ("SA", 1, 21, 0)]
    assert store.read("fact_match", first).count() == 6  # an older commit can still be read
    assert [tuple(r) for r in store.changed(first, second).collect()] == [("fact_match", "=PD/=2")]
    plan = formatted(store.read("fact_match"))
    assert "dynamicpruningexpression(part" in plan and "hashpartitioning" not in plan
    counted = {(r["part"], r["row_count"]) for r in store.parts("fact_match", second).collect()}
    assert counted == {("=PD/=1", 2), ("=PD/=2", 2), ("=SA/=1", 2)}


def test_newest_parts_need_no_rows(spark, tmp_path):
    store = warehouse.base_store(spark, str(tmp_path))
    tables = base_tables(spark, LEAGUES)
    old = standings(spark, [standing(1, 1, date="2026-01-01", competition_code="XX"), standing(1, 1, date=None, competition_code="XX")])
    commit = store.commit({**tables, "fact_standing_snapshot": tables["fact_standing_snapshot"].unionByName(old)}, "v1")
    parts = store.newest_parts("fact_standing_snapshot", commit, LEAGUE, "snapshot_date")
    assert sorted(r["part"] for r in parts.collect()) == ["=PD/=1/=2026-08-31", "=PD/=2/=2026-08-31", "=SA/=1/=2026-08-31", "=XX/=1/=2026-01-01"]
    rows = store.read("fact_standing_snapshot", commit, parts)
    assert {r["snapshot_date"] for r in rows.collect()} == {"2026-08-31", "2026-01-01"} and rows.count() == 7
    assert "Window" not in formatted(rows) and "dynamicpruningexpression(part" in formatted(rows)


def test_any_key_value_makes_a_part(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"fact_match": (FACT_MATCH, LEAGUE)})
    codes = [None, "", "-", "=", "a/b", "a", "É %2F", "__HIVE_DEFAULT_PARTITION__"]
    rows = [match(i, 1, 1, 2, (1, 0), competition_code=c, season_id=s) for i, (c, s) in enumerate([(c, s) for c in codes for s in (1, None)])]
    commit = store.commit({"fact_match": matches(spark, rows)}, "v1")
    parts = store.parts("fact_match", commit)
    assert parts.count() == len(rows)
    names = {(r[0], r[1]) for r in parts.select(commits.key_value(F.col("part"), 0), commits.key_value(F.col("part"), 1)).collect()}
    assert names == {(c, s) for c in codes for s in ("1", None)}
    assert sorted(map(str, (r["competition_code"] for r in store.read("fact_match").collect()))) == sorted(map(str, codes * 2))
    empty = store.commit({"fact_match": matches(spark, [])}, "v2", seen=commit, replaced=store.manifest(commit))
    assert store.read("fact_match", empty).count() == 0


def test_unchanged_parts_stay(spark, tmp_path):
    store = warehouse.base_store(spark, str(tmp_path))
    first = store.commit(base_tables(spark, LEAGUES), "v1")
    again = {name: rows.repartition(3).withColumn("loaded_at", F.current_timestamp()) for name, rows in base_tables(spark, LEAGUES).items()}
    second = store.commit(again, "v2", seen=first)
    assert store.changed(first, second).count() == 0
    assert store.read("fact_match").count() == 6


def test_writers_of_other_parts_both_succeed(spark, tmp_path):
    store = warehouse.base_store(spark, str(tmp_path))
    first = store.commit(base_tables(spark, LEAGUES), "v0")
    errors = []

    def write(league, goals):
        try:
            rows = base_tables(spark, LEAGUES, goals)["fact_match"]
            rows = rows.filter((F.col("competition_code") == league[0]) & (F.col("season_id") == league[1]))
            warehouse.base_store(spark, str(tmp_path)).commit({"fact_match": rows}, f"v{goals}", seen=first)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=write, args=(league, 5 + n)) for n, league in enumerate(LEAGUES)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and store.newest().number == 4
    assert [s for _, _, _, s in scores(store)] == [5, 0, 6, 0, 7, 0]
    # A fourth one, which still builds on the first commit, shares a part with one of them.
    with pytest.raises(Conflict, match="=SA/=1"):
        write_again = base_tables(spark, [("SA", 1)], 9)["fact_match"]
        store.commit({"fact_match": write_again}, "v9", seen=first)
    used = store.manifest(first).filter("part = '=PD/=1'")
    with pytest.raises(Conflict, match="=PD/=1"):
        store.commit({"dim_team": teams(spark, [5], "XX")}, "v9", seen=first, uses=used)
    assert store.newest().number == 4


@pytest.mark.parametrize("write", range(4))
def test_a_run_that_ends_early_leaves_the_old_version(spark, tmp_path, monkeypatch, write):
    store = warehouse.base_store(spark, str(tmp_path))
    first = store.commit(base_tables(spark, LEAGUES), "v1")
    before = scores(store)
    done = []
    plain, once = Store._write, commits.create_once

    def failing_write(self, name, *rest):
        if len(done) == write:
            raise OSError("lost")
        done.append(name)
        return plain(self, name, *rest)

    def failing_create(*args):
        if write == 3:
            raise OSError("lost")
        return once(*args)

    monkeypatch.setattr(Store, "_write", failing_write)
    monkeypatch.setattr(commits, "create_once", failing_create)
    with pytest.raises(OSError, match="lost"):
        store.commit(base_tables(spark, LEAGUES, 8), "v2", seen=first)
    assert len(done) == write and store.newest() == first and scores(store) == before
    monkeypatch.undo()
    store.commit(base_tables(spark, LEAGUES, 8), "v2", seen=first)
    assert scores(store) != before


def test_broken_rules_keep_the_old_version(spark, tmp_path):
    store = warehouse.base_store(spark, str(tmp_path))
    first = store.commit(base_tables(spark, LEAGUES), "v1", FACT_RULES)
    good = base_tables(spark, LEAGUES, 2)
    broken = {
        "home_team_id": {**good, "fact_match": good["fact_match"].withColumn("home_team_id", F.col("away_team_id"))},
        "match_id unique": {**good, "fact_match": good["fact_match"].unionByName(good["fact_match"])},
        "dim_team.* not_empty": {**good, "dim_team": good["dim_team"].limit(0)},
        "relationships": {**good, "dim_team": good["dim_team"].filter("team_id = 1")},
    }
    for message, tables in broken.items():
        with pytest.raises(ContractError) as raised:
            store.commit(tables, "v2", FACT_RULES, seen=first)
        assert message in str(raised.value)
        assert store.newest() == first


def test_observed_counts_equal_queries(spark, tmp_path):
    table = base_tables(spark, LEAGUES)["fact_match"]
    bad = table.withColumn("match_id", F.when(F.col("matchday") == 1, F.col("match_id"))).withColumn("status", F.lit("ODD"))
    rules = [
        Rule("m", "not_null", "match_id"), Rule("m", "accepted_values", "status", values=("FINISHED", "O'X")),
        Rule("m", "row_rule", "matchday", condition="matchday < 2"), Rule("m", "not_empty", "*"),
        Rule("m", "covers", "competition_code", values=("PD", "ZZ")), Rule("m", "present", "form"),
    ]
    bad = bad.withColumn("form", F.lit(None).cast("string"))
    observed = Observed(rules)
    observed.watch(bad).write.parquet(f"{tmp_path}/m")
    want = {tuple(r) for r in failures({"m": bad}, rules).collect()}
    assert set(observed.counts()) == want and Observed([]).counts() == []
    assert {c[3] for c in observed.counts()[:3]} == {3, 6}
    assert row_failures(bad, rules[:3]).count() == 3

    def write(name, rows):
        rows.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    keyed = [Rule("n", "unique", "status"), Rule("n", "not_null", "match_id")]
    report = {tuple(r) for r in write_and_check({"n": lambda: bad}, keyed, write).collect()}
    assert report == {("n", "status", "unique", 1), ("n", "match_id", "not_null", 3)}


def test_each_model_is_built_once_for_its_checks(spark, sf_dir, monkeypatch):
    import __spark_entry__ as entry

    plans = []
    watch = Observed.watch
    monkeypatch.setattr(Observed, "watch", lambda self, rows: plans.append(rows) or watch(self, rows))
    assert entry.queries()["dq_at_write"](spark, sf_dir).count() == 62
    files = [f for rows in plans for f in rows.inputFiles() if "orders" in f]
    assert len(plans) == 8 and len(files) <= 2  # matches, and the official tables that the data derive from them


def test_marts_follow_changed_leagues_only(spark, tmp_path, monkeypatch):
    base = warehouse.base_store(spark, f"{tmp_path}/base")
    first = base.commit(base_tables(spark, LEAGUES), "v1")

    def rows(models):
        return {name: sorted(map(repr, models[name].drop("loaded_at").collect())) for name in MARTS}

    def refresh(version):
        return rows(warehouse.refresh_marts(spark, base, str(tmp_path), version, ["PD", "SA"]))

    def whole():
        return rows(Models({name: base.read(name) for name in SOURCES}))

    assert refresh("v1") == whole()
    store = warehouse.mart_store(spark, f"{tmp_path}/marts", Models({name: base.read(name) for name in SOURCES}))
    before = store.newest()
    assert refresh("v1b") == whole() and store.newest() == before  # nothing has changed
    base.commit({"fact_match": base_tables(spark, LEAGUES, 4)["fact_match"].filter("season_id = 2")}, "v2", seen=first)
    read = []
    plain = Store.read
    monkeypatch.setattr(Store, "read", lambda self, name, commit=None, parts=None: read.append((name, parts)) or plain(self, name, commit, parts))
    assert refresh("v2") == whole()
    wanted = {name: sorted(r["part"] for r in parts.collect()) for name, parts in read if parts is not None}
    assert wanted == {"dim_team": ["=PD"], "fact_match": ["=PD/=2"], "fact_standing_snapshot": ["=PD/=2/=2026-08-31"]}
    monkeypatch.undo()
    after = store.newest()
    assert after.base == 2 and {r["part"] for r in store.changed(before, after).collect()} == {"=PD/=2"}
    # A club's new name touches all leagues of its competition; a league that is gone leaves no row.
    clubs = base.read("dim_team").filter("competition_code = 'SA'").withColumn("team_name", F.concat(F.lit("New "), "team_name"))
    gone = base.manifest(base.newest()).filter("part LIKE '=PD/=1%'")
    base.commit({"dim_team": clubs}, "v3", seen=base.newest(), replaced=gone)
    assert refresh("v3") == whole()
    assert {r["part"] for r in store.changed(after, store.newest()).collect()} == {"=SA/=1", "=PD/=1"}
    assert {r["part"] for r in store.parts("mart_match_explorer", store.newest()).collect()} == {"=PD/=2", "=SA/=1"}


def test_attempts_that_no_commit_names_are_removed(spark, tmp_path):
    store = warehouse.base_store(spark, str(tmp_path))
    assert store.remove_unnamed(age_seconds=0) == []
    first = store.commit(base_tables(spark, LEAGUES), "v1")
    with pytest.raises(ContractError):  # a run that fails its checks leaves an attempt behind
        bad = teams(spark, [5], "XX").withColumn("team_id", F.lit(None).cast("bigint"))
        store.commit({"dim_team": bad}, "v2", [Rule("dim_team", "not_null", "team_id")], seen=first)
    second = store.commit({"fact_match": base_tables(spark, LEAGUES, 3)["fact_match"]}, "v2", seen=first)
    before, tables = scores(store), {name: store.read(name).count() for name in SOURCES}
    assert store.remove_unnamed() == []  # all of it is young
    gone = store.remove_unnamed(keep=2, age_seconds=0)
    kinds = sorted(path.removeprefix(f"{tmp_path}/").split("/")[1].split("=")[0].split("-")[0] for path in gone)
    assert kinds == ["dim_team", "new", "new"] and scores(store) == before
    assert store.read("fact_match", first).count() == 6  # the last two commits can be read
    gone = store.remove_unnamed(keep=1, age_seconds=0)
    assert [path.removeprefix(f"{tmp_path}/").split("/")[1] for path in gone] == ["fact_match"]
    assert scores(store) == before and {name: store.read(name).count() for name in SOURCES} == tables
    assert store.changed(first, second).count() == 3  # manifests stay
    assert store.remove_unnamed(keep=1, age_seconds=0) == []
