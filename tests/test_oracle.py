"""Every registered query equals its SQL, on the given tables and on tables with hot keys."""

from __future__ import annotations

import compare
import duckdb
import pytest

import __spark_entry__ as entry

QUERIES = entry.core_queries()
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


def check(spark, folder, name):
    got = compare.spark_rows(QUERIES[name](spark, folder))
    con = compare.connect(folder)
    want = compare.duckdb_rows(con, SQL[name])
    con.close()
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    check(spark, sf_dir, name)


@pytest.fixture(scope="session")
def hot_dir(tmp_path_factory):
    """A third of all matches belong to one club pairing of one league, at one kick-off; a
    third of all run events to one run; a third of all candidates share one name."""
    source, folder = "/root/testdata/sf0.001", tmp_path_factory.mktemp("hot")
    changed = {
        "orders": """SELECT o_orderkey * 24 AS o_orderkey,
            CASE WHEN o_orderkey % 3 = 0 THEN 75 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice,
            CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1998-03-01' ELSE o_orderdate END AS o_orderdate,
            o_orderpriority FROM t""",
        "events": """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-05' ELSE ts END AS ts,
            CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id, event_type, value, props FROM t""",
        "supplier": """SELECT s_suppkey, s_name, CAST(CASE WHEN s_suppkey % 3 = 0 THEN 12 ELSE s_nationkey END
            AS INTEGER) AS s_nationkey, s_acctbal FROM t""",
    }
    con = duckdb.connect()
    for name in compare.TABLES:
        con.execute(f"CREATE OR REPLACE VIEW t AS SELECT * FROM read_parquet('{source}/{name}.parquet')")
        con.execute(f"COPY ({changed.get(name, 'SELECT * FROM t')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    con.close()
    return str(folder)


HOT = [
    "stg_standings", "team_performance", "match_list", "recent_matches", "current_standings",
    "position_history", "race_bounds", "form_strip", "club_recent", "club_upcoming",
    "fixture_matrix", "fixture_matrix_wide", "matchday_window", "goals_by_matchday",
    "dq_unique", "dq_relationships", "entity_resolution", "run_log", "json_flatten",
    "incremental_ingest",
]


@pytest.mark.parametrize("name", HOT)
def test_hot_keys(spark, hot_dir, name):
    check(spark, hot_dir, name)


@pytest.mark.parametrize("name", ["match_list", "position_history", "fixture_matrix_wide", "club_recent", "dq_relationships"])
def test_shuffle_joins_give_the_same(spark, hot_dir, name):
    """Beyond the broadcast threshold the same queries run on shuffle joins."""
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for limit in limits:
        spark.conf.set(limit, "-1")
    try:
        plan = QUERIES[name](spark, hot_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "CartesianProduct" not in plan
        check(spark, hot_dir, name)
    finally:
        for limit in limits:
            spark.conf.unset(limit)
