"""Physical plans: no nested-loop joins, no Python, pruned scans, limits before the shuffle."""

from __future__ import annotations

import pytest
from frames import match, matches, standing, standings, teams

import __spark_entry__ as entry
from touchline.operators.clubs import form_matches
from touchline.operators.participants import team_match_results
from touchline.operators.performance import team_performance
from touchline.operators.standings import latest_per_league
from touchline.sources.tables import read_table, write_snapshots, write_table

WRITES_FILES = {
    "snapshot_roundtrip", "latest_documents", "incremental_ingest", "published_standings", "files_flatten_matches",
    "files_flatten_teams",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.core_queries()) - WRITES_FILES))
def test_no_slow_operators(spark, sf_dir, name):
    text = plan(entry.core_queries()[name](spark, sf_dir))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in text


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact"))
    write_table(matches(spark, [match(1, 1, 1, 2, (1, 0))]), path, ["competition_code", "season_id"])
    return read_table(spark, path, matches(spark, []).schema)


def test_filters_and_columns_reach_the_scan(spark, stored):
    text = plan(team_performance(team_match_results(stored), teams(spark, [1, 2])))
    assert "EqualTo(status,FINISHED)" in text
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "utc_date" not in scan and "stage" not in scan and "source_last_updated" not in scan


def test_partitions_are_pruned(stored):
    text = plan(stored.filter("competition_code = 'PD' AND season_id = 1").select("match_id"))
    assert "PartitionFilters: [isnotnull(competition_code" in text


def test_top_n_limits_before_the_exchange(spark, stored):
    lines = plan(form_matches(stored, teams(spark, [1, 2]))).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[exchange:])


def test_newest_snapshot_limits_before_the_exchange(spark, tmp_path):
    table = standings(spark, [standing(1, 1)])
    write_snapshots(table, str(tmp_path / "s"))
    lines = plan(latest_per_league(read_table(spark, str(tmp_path / "s"), table.schema))).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[exchange:])


def test_participants_scan_once_without_exchange(spark, stored):
    text = plan(team_match_results(stored))
    assert text.count("FileScan") == 1 and "Exchange" not in text
