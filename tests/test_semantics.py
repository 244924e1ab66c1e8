"""Hand-computed cases."""

from __future__ import annotations

import datetime as dt

from direct_forms import range_join_history, union_results
from frames import match, matches, standing, standings, teams
from pyspark.sql import functions as F

from touchline.operators import clubs, history, rounds, season
from touchline.operators import matches as match_ops
from touchline.operators.participants import clubs_of, team_match_results
from touchline.operators.performance import derived_totals, performance_order, team_performance
from touchline.operators.standings import (
    current_standings,
    latest_per_league,
    league_highlights,
    league_table,
    points_race,
    reconciliation_summary,
    standings_reconciliation,
    top_of_table,
    unreconciled,
)
from touchline.plans.models import Models


def by(rows, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}


def test_null_result_counts_as_played_only(spark):
    table = matches(spark, [match(1, 1, 1, 2, (2, 0)), match(2, 2, 2, 1, (1, 1), result=None)])
    results = team_match_results(table)
    assert results.count() == 4
    perf = by(team_performance(results, teams(spark, [1, 2])).collect(), "team_id")
    assert (perf[1]["played"], perf[1]["won"], perf[1]["drawn"], perf[1]["lost"]) == (2, 1, 0, 0)
    assert perf[1]["points"] == 3 and perf[1]["points_per_game"] == 1.5
    assert perf[2]["goals_against_per_game"] == 1.5 and perf[2]["home_played"] == 1
    assert by(results.collect(), "team_match_key")["2-2"]["team_result"] is None


def test_participants_mirror_both_sides(spark):
    rows = by(team_match_results(matches(spark, [match(9, 1, 1, 2, (0, 3))])).collect(), "team_id")
    assert (rows[1]["venue"], rows[1]["team_result"], rows[1]["points_earned"]) == ("HOME", "L", 0)
    assert (rows[2]["venue"], rows[2]["team_result"], rows[2]["points_earned"]) == ("AWAY", "W", 3)
    assert rows[1]["goals_against"] == rows[2]["goals_for"] == 3


def test_reconciliation_flags_and_deltas(spark):
    table = matches(spark, [match(1, 1, 1, 2, (2, 1)), match(2, 1, 3, 4, (0, 0))])
    results = team_match_results(table)
    official = standings(
        spark,
        [
            standing(1, 1, played=1, won=9, points=3, gf=2, ga=1),  # wins are not compared
            standing(2, 4, played=2, points=3, gf=2, ga=2),
            standing(3, 2, played=None, points=1),
            standing(5, 5),  # no result at all
            standing(1, 1, date="2026-08-01"),  # older snapshot
        ],
    )
    rows = by(standings_reconciliation(official, results).collect(), "team_id")
    assert set(rows) == {1, 2, 3, 5}
    assert rows[1]["is_reconciled"] is True
    assert rows[2]["is_reconciled"] is False and rows[2]["played_delta"] == 1 and rows[2]["points_delta"] == 3
    assert rows[3]["is_reconciled"] is False and rows[3]["played_delta"] is None
    assert rows[5]["is_reconciled"] is True and rows[5]["derived_played"] == 0


def test_carried_reconciliation_equals_join_on_four_keys(spark):
    table = matches(spark, [match(1, 1, 1, 2, (2, 1))])
    results, clubs_table = team_match_results(table), teams(spark, [1, 2])
    official = standings(spark, [standing(1, 1, played=1, points=3, gf=2, ga=1), standing(2, 2, played=5)])
    keys = ["competition_code", "season_id", "team_id", "snapshot_date"]
    flags = standings_reconciliation(official, results).select(*keys, "is_reconciled", "played_delta")
    joined = latest_per_league(official).join(flags, keys, "left")
    current = current_standings(official, results, clubs_table)
    cols = [*keys, "is_reconciled", "played_delta"]
    assert sorted(map(tuple, joined.select(cols).collect())) == sorted(map(tuple, current.select(cols).collect()))


def test_latest_snapshot_is_per_league(spark):
    official = standings(
        spark,
        [
            standing(1, 1, date="2026-08-31"),
            standing(1, 1, date="2026-09-30", competition_code="SA"),
            standing(2, 2, date=None, competition_code="SA"),
        ],
    )
    found = {(r["competition_code"], r["snapshot_date"]) for r in latest_per_league(official).collect()}
    assert found == {("PD", "2026-08-31"), ("SA", "2026-09-30")}


def test_null_flag_counts_only_in_total(spark):
    frame = spark.createDataFrame([(True,), (False,), (None,)], "is_reconciled boolean")
    row = reconciliation_summary(frame).first()
    assert (row["total_teams"], row["reconciled_teams"], row["unreconciled_teams"]) == (3, 1, 1)
    empty = reconciliation_summary(frame.limit(0)).first()
    assert (empty["total_teams"], empty["reconciliation_rate"]) == (0, 0.0)


def history_case(spark):
    """Round 2 is unfinished for nobody, round 3 is; club 5 never plays; rounds 4 is finished."""
    table = matches(
        spark,
        [
            match(1, 1, 1, 2, (1, 0)),
            match(2, 1, 3, 4, (1, 0)),
            match(3, 2, 2, 1, (2, 2)),
            match(4, 2, 4, 3, (0, 4)),
            match(5, 3, 1, 3, (9, 9)),
            match(6, 3, 2, 4, None, "IN_PLAY"),
            match(7, 4, 1, 4, (1, 0)),
            match(8, None, 1, 4, (5, 0)),
        ],
    )
    official = standings(spark, [standing(i, i) for i in (1, 2, 3, 4, 5)])
    return table, official, teams(spark, [1, 2, 3, 4, 5])


def test_position_history(spark):
    table, official, club_table = history_case(spark)
    results = team_match_results(table)
    current = current_standings(official, results, club_table)
    rows = by(history.position_history(current, table, results).collect(), "matchday", "team_id")
    assert {m for m, _ in rows} == {1, 2}  # contiguous prefix: 3 is open, 4 is not reached
    assert len(rows) == 10
    # Round 1: 1 and 3 are level on points, difference and goals and share the first place.
    assert [rows[1, t]["derived_position"] for t in (1, 2, 3, 4, 5)] == [1, 4, 1, 4, 3]
    assert rows[2, 3]["derived_position"] == 1 and rows[2, 3]["points"] == 6
    assert rows[2, 5]["played"] == 0 and rows[2, 5]["points"] == 0
    assert rows[2, 1]["goals_for"] == 3  # the match without a round is left out


def test_history_views(spark):
    table, official, club_table = history_case(spark)
    results = team_match_results(table)
    rows = history.history_rows(current_standings(official, results, club_table), table, results)
    assert history.club_history(rows, ["C1", "C3"]).count() == 4
    summary = history.history_rounds(rows).first()
    assert (summary["completed_rounds"], summary["latest_derived_round"]) == (2, 2)
    # Position 4 is in the title race and in the European race.
    races = {(r["race"], r["team_id"]) for r in history.race_history(rows).collect()}
    assert races == {("Title Race", t) for t in (1, 2, 3, 4)} | {("European Race", t) for t in (4, 5)}
    bounds = {r["race"]: (r["chart_top"], r["chart_bottom"]) for r in history.race_bounds(rows).collect()}
    assert bounds["Title Race"] == (1, 5)


def test_history_window_form_equals_range_join_form(spark):
    table, official, club_table = history_case(spark)
    results = team_match_results(table)
    current = current_standings(official, results, club_table)
    windowed = history.position_history(current, table, results)
    ranged = range_join_history(current, table, results).select(*windowed.columns)
    assert sorted(map(tuple, windowed.collect())) == sorted(map(tuple, ranged.collect()))


def test_one_scan_equals_two_branches(spark):
    table, _, _ = history_case(spark)
    one = team_match_results(table)
    two = union_results(table).select(*one.columns)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_two_notions_of_latest_round(spark):
    table, _, _ = history_case(spark)
    status = rounds.round_status(table)
    assert rounds.latest_finished_round(status).first()["latest_completed_round"] == 4
    assert sorted(r["matchday"] for r in rounds.completed_rounds(status).collect()) == [1, 2]


def test_default_round_priority(spark):
    played, upcoming = match(1, 3, 1, 2, (1, 0)), match(2, 5, 1, 2, None, "TIMED")
    live, odd = match(3, 4, 1, 2, (0, 0), "PAUSED"), match(4, 1, 1, 2, None, "POSTPONED")

    def default(*rows):
        return rounds.default_round(matches(spark, list(rows))).first()["default_label"]

    assert default(played, upcoming, live) == "4"
    assert default(played, upcoming) == "3"
    assert default(upcoming, odd) == "5"
    assert default(odd) == "All"


def test_round_window_is_clamped(spark):
    rows = [match(i, i, 1, 2, (1, 0) if i <= 2 else None, "FINISHED" if i <= 2 else "TIMED") for i in range(1, 11)]
    table = matches(spark, rows)

    def shown(**options):
        found = rounds.round_window(table, **options).orderBy("matchday").collect()
        return [r["matchday"] for r in found]

    assert shown() == [1, 2, 3, 4, 5, 6, 7]  # default round 2
    assert shown(selected=6) == [3, 4, 5, 6, 7, 8, 9]
    assert shown(selected=10) == [4, 5, 6, 7, 8, 9, 10]
    assert shown(selected=99) == [1, 2, 3, 4, 5, 6, 7]  # unknown round: default
    assert shown(selected=5, size=20) == list(range(1, 11))


def test_round_neighbours_skip_missing_rounds(spark):
    table = matches(spark, [match(1, 1, 1, 2), match(2, 4, 1, 2), match(3, 9, 1, 2)])
    rows = by(rounds.round_neighbours(table).collect(), "matchday")
    assert (rows[4]["previous_matchday"], rows[4]["next_matchday"]) == (1, 9)
    assert rows[1]["previous_matchday"] is None and rows[9]["next_matchday"] is None


def test_scorelines_and_states(spark):
    table = matches(
        spark,
        [
            match(1, 1, 1, 2, (2, 1)),
            match(2, 1, 1, 2, None),  # finished without a score
            match(3, 1, 1, 2, (0, 1), "IN_PLAY"),
            match(4, 1, 1, 2, None, "PAUSED"),
            match(5, 1, 1, 2, None, "TIMED"),
            match(6, 1, 1, 2, None, "SUSPENDED"),
            match(7, 1, 1, 99, (1, 0)),  # unknown club: dropped by the inner join
        ],
    )
    explorer = match_ops.match_explorer(table, teams(spark, [1, 2]))
    rows = by(explorer.collect(), "match_id")
    assert [rows[i]["scoreline"] for i in range(1, 7)] == ["2 – 1", None, "0 – 1", "–", "–", "–"]
    assert [rows[i]["match_state"] for i in range(1, 7)] == [
        "Finished", "Finished", "Live", "Live", "Upcoming", "Other",
    ]
    assert 7 not in rows
    assert match_ops.fixtures_of(explorer, 2).count() == 6
    assert match_ops.filter_matches(explorer, matchday=1, club="C1", state="Live").count() == 2
    assert match_ops.filter_matches(explorer, competition="PD", season=2).count() == 0
    kpis = match_ops.match_kpis(table).first()
    assert (kpis["total_matches"], kpis["live_matches"], kpis["other_matches"]) == (7, 2, 1)


def test_strip_uses_scores_and_marks_unplayed(spark):
    table = matches(
        spark,
        [
            match(1, 1, 1, 2, (2, 1)),
            match(2, 2, 2, 1, (1, 1), result=None),
            match(3, 3, 1, 2, (0, 0), "IN_PLAY"),
            match(4, 4, 2, 1, None),
        ],
    )
    strip = clubs.season_strip(table, teams(spark, [1, 2]))
    rows = [(r["result"], r["venue"], r["score"]) for r in clubs.strip_of(strip, "C1").collect()]
    assert rows == [
        ("W", "Home", "2 – 1"), ("D", "Away", "1 – 1"), ("Upcoming", "Home", "—"), (None, "Away", None),
    ]


def test_form_and_fixture_limits(spark):
    day = dt.datetime(2026, 8, 1)
    rows = [
        match(i, i, 1, 2, (i % 3, 1), utc_date=day + dt.timedelta(days=i // 2)) for i in range(1, 13)
    ] + [match(100 + i, 20 + i, 2, 1, None, "TIMED", utc_date=day + dt.timedelta(days=60 + i)) for i in range(9)]
    table, club_table = matches(spark, rows), teams(spark, [1, 2])
    form = clubs.form_matches(table, club_table)
    mine = sorted((r for r in form.collect() if r["team_id"] == 1), key=lambda r: r["recency"])
    assert [r["match_id"] for r in mine] == [12, 11, 10, 9, 8]  # ties on time break by id
    strip = by(clubs.form_strip(form).collect(), "team_id")
    assert strip[1]["form"] == "W L D W L" and strip[2]["form"] == "L W D L W"
    assert clubs.recent_fixtures(table, club_table).filter("team_id = 2").count() == 8
    ahead = clubs.upcoming_fixtures(table, club_table).filter("team_id = 2").orderBy("row_no").collect()
    assert [r["match_id"] for r in ahead] == [100, 101, 102, 103, 104]
    assert ahead[0]["date"] == "30 Sep 2026 • 02:00 CEST" and ahead[0]["home_team"] == "C2"


def test_fixture_matrix(spark):
    day = dt.datetime(2026, 8, 1)
    table = matches(
        spark,
        [
            match(1, 1, 1, 2, (2, 1), utc_date=day),
            match(2, 9, 1, 2, (0, 3), utc_date=day + dt.timedelta(days=5)),  # replaces match 1
            match(3, 1, 2, 1, (1, 1), "IN_PLAY", utc_date=day),
            match(4, 1, 3, 1, None, "TIMED", utc_date=day),
            match(5, 1, 1, 8, (4, 0), utc_date=day),  # club 8 is not in the current table
        ],
    )
    official = standings(spark, [standing(i, i) for i in (1, 2, 3)])
    current = current_standings(official, team_match_results(table), teams(spark, [1, 2, 3, 8]))
    cells = by(season.fixture_matrix(table, current).collect(), "home_team", "away_tla")
    assert {k: (v["cell"], v["outcome"]) for k, v in cells.items()} == {
        ("C1", "T2"): ("0–3", "away win"), ("C2", "T1"): ("1–1*", "draw"), ("C3", "T1"): ("·", "blank"),
    }
    columns = season.matrix_columns(current)
    codes = list(columns.values())
    assert codes == ["T1", "T2", "T3"]
    wide = by(season.fixture_matrix_wide(table, current, columns).collect(), "home_team")
    assert [wide["C1"][c] for c in codes] == ["—", "0–3", "·"]
    assert [wide["C3"][c] for c in codes] == ["·", "·", "—"]
    # A missing or shared code loses no result.
    from pyspark.sql import functions as F

    for code, labels in ((F.lit(None).cast("string"), ["C1", "C2", "C3"]), (F.lit("T"), ["T (1)", "T (2)", "T (3)"])):
        plain = current.withColumn("tla", code)
        columns = season.matrix_columns(plain)
        assert list(columns.values()) == labels
        wide = by(season.fixture_matrix_wide(table, plain, columns).collect(), "home_team")
        assert [wide["C1"][c] for c in labels] == ["—", "0–3", "·"]


def test_highlights_rankings_and_zones(spark):
    official = standings(
        spark,
        [
            standing(1, 1, points=9, gf=5, ga=3),
            standing(2, 2, points=7, gf=8, ga=1),
            standing(3, 2, points=7, gf=8, ga=3),
            standing(4, 18, points=0, gf=0, ga=12),
        ],
    )
    current = current_standings(official, team_match_results(matches(spark, [])), teams(spark, [1, 2, 3, 4]))
    cards = by(league_highlights(current).collect(), "highlight")
    assert cards["League Leader"]["team_id"] == 1 and cards["Best Attack"]["team_id"] == 2
    assert cards["Best Defence"]["value_text"] == "1 conceded"
    table = by(league_table(current).collect(), "team")
    assert [table[f"C{i}"]["zone"] for i in (1, 2, 4)] == ["UCL", "UCL", "Relegation"]
    assert table["C1"]["data"] == "⚠ Pending"
    order = by(points_race(current).collect(), "team_id")
    assert [order[i]["points_order"] for i in (1, 2, 3, 4)] == [4, 3, 2, 1]
    assert top_of_table(current, 2).count() == 2
    assert unreconciled(current).count() == 4


def test_club_record_without_results(spark):
    table = matches(spark, [match(1, 1, 1, 2, (2, 1))])
    results, club_table = team_match_results(table), teams(spark, [1, 2, 3])
    current = current_standings(standings(spark, [standing(i, i) for i in (1, 2, 3)]), results, club_table)
    perf = team_performance(results, club_table)
    rows = by(clubs.club_record(current, perf).collect(), "team_id")
    assert rows[1]["ppg_text"] == "3.00" and rows[1]["goal_difference_text"] == "+1" and rows[1]["wdl"] == "1-0-0"
    assert rows[3]["ppg_text"] == "N/A" and rows[3]["wdl"] is None
    compared = clubs.official_vs_derived(current, perf).filter("team_id = 1").collect()
    assert {r["metric"]: r["difference"] for r in compared} == {
        "Played": -1, "Points": -3, "Goals For": -2, "Goals Against": -1,
    }
    assert [r["team_id"] for r in performance_order(perf).collect()] == [1, 2]


def test_seasons_never_mix(spark):
    table = matches(spark, [match(1, 1, 1, 2, (1, 0)), match(2, 1, 1, 2, (1, 0), season_id=2)])
    totals = derived_totals(team_match_results(table)).filter("team_id = 1").collect()
    assert sorted((r["season_id"], r["played"]) for r in totals) == [(1, 1), (2, 1)]


def test_invariants(spark, sf_dir):
    from touchline.sources import driver_tables as driver

    models = Models(driver.load(spark, sf_dir))
    played = models["stg_matches"]
    results = team_match_results(played)
    finished = played.filter("status = 'FINISHED'").count()
    assert results.count() == 2 * finished
    goals = results.groupBy("competition_code", "season_id").agg(
        F.sum("goals_for").alias("f"), F.sum("goals_against").alias("a")
    )
    assert goals.filter("f <> a").count() == 0
    assert clubs_of(played).count() == clubs_of(played).distinct().count()
    models.create_views(["stg_teams", "mart_team_performance"])
    top = spark.sql("SELECT max(points) AS p FROM mart_team_performance").first()["p"]
    assert top == models["mart_team_performance"].agg(F.max("points")).first()[0]
    assert len(models) == len(list(models)) == 11
