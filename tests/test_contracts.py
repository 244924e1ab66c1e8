"""Contract rules: one passing and one failing case each, with the exact violations."""

from __future__ import annotations

from collections import Counter

import pytest
from frames import match, matches, standing, standings, teams
from pyspark.sql import functions as F

from touchline.operators import contracts as c
from touchline.operators import keyfilter, resolve
from touchline.plans.models import Models


def counts(report):
    return {(r["model"], r["column_name"], r["rule"]): r["failures"] for r in report.collect()}


def good_models(spark):
    return Models(
        {
            "dim_team": teams(spark, [1, 2]),
            "fact_match": matches(spark, [match(1, 1, 1, 2, (1, 0)), match(2, 2, 2, 1, (0, 0))]),
            "fact_standing_snapshot": standings(
                spark,
                [
                    standing(1, 1, played=2, won=1, drawn=1, gf=1, points=4),
                    standing(2, 2, played=2, drawn=1, lost=1, ga=1, points=1),
                ],
            ),
        }
    )


def test_catalogue_size():
    rules = c.model_rules(["PD"])
    kinds = [r.kind for r in rules]
    assert len(rules) == 62
    assert [kinds.count(k) for k in (c.NOT_NULL, c.UNIQUE, c.ACCEPTED, c.RELATION)] == [38, 7, 7, 10]


def test_all_rules_pass_on_good_models(spark):
    report = c.failures(good_models(spark), c.model_rules(["PD"]))
    assert set(counts(report).values()) == {0}
    c.gate(report)
    tables = good_models(spark)
    c.gate(c.failures({n: tables[n] for n in ("dim_team", "fact_match", "fact_standing_snapshot")}, c.FACT_RULES))


def test_broken_models_are_counted(spark):
    broken = Models(
        {
            "dim_team": teams(spark, [1, 2, 2]),
            "fact_match": matches(
                spark,
                [
                    match(1, 1, 1, 2, (1, 0)),
                    match(1, 1, 1, 9, (1, 0)),
                    match(None, 1, 3, 3, None, None, competition_code="PD"),
                    match(5, 1, None, 2, None, "TIMED", competition_code="XX"),
                ],
            ),
            "fact_standing_snapshot": standings(spark, [standing(7, None, points=None)]),
        }
    )
    found = counts(c.failures(broken, c.model_rules(["PD"])))
    assert found["stg_teams", "team_id", "unique"] == 1
    assert found["stg_matches", "match_id", "unique"] == 1
    assert found["stg_matches", "match_id", "not_null"] == 1
    assert found["stg_matches", "home_team_id", "not_null"] == 1
    assert found["stg_matches", "status", "not_null"] == 1
    assert found["stg_matches", "competition_code", "accepted_values"] == 1
    assert found["stg_matches", "home_team_id", "relationships"] == 1
    assert found["stg_matches", "away_team_id", "relationships"] == 3
    assert found["stg_standings", "team_id", "relationships"] == 1
    assert found["stg_standings", "position", "not_null"] == 1
    with pytest.raises(c.ContractError, match="stg_teams.team_id unique: 1"):
        c.gate(c.failures(broken, c.unique_rules()))


def test_fact_rules_and_violating_rows(spark):
    tables = {
        "dim_team": teams(spark, [1]).limit(0),
        "fact_match": matches(spark, [match(1, 1, 4, 4), match(2, 1, 4, None)]),
        "fact_standing_snapshot": standings(
            spark,
            [
                standing(1, 1, played=3, won=1),
                standing(2, 1, played=None, won=1),  # NULL comparison is no violation
                standing(3, 1, goal_difference=5),
                standing(3, 1, date="2026-09-01"),
                standing(1, 1, played=3, won=1, date="2026-09-01", goals_for=None),
                standing(1, 2, date="2026-09-01"),
            ],
        ),
    }
    found = counts(c.failures(tables, c.FACT_RULES))
    assert found["dim_team", "*", "not_empty"] == 1
    assert found["fact_match", "*", "not_empty"] == 0
    assert found["fact_match", "home_team_id", "home_team_id <> away_team_id"] == 1
    assert found["fact_standing_snapshot", "played", "played = won + drawn + lost"] == 2
    assert found["fact_standing_snapshot", "goal_difference", "goal_difference = goals_for - goals_against"] == 1
    assert found["fact_standing_snapshot", "team_id", "unique"] == 1
    rows = c.violating_rows(
        tables["fact_standing_snapshot"],
        F.concat_ws("/", "team_id", "snapshot_date"),
        [r for r in c.ROW_RULES if r.model == "fact_standing_snapshot"],
    ).collect()
    assert sorted((r["column_name"], r["row_key"]) for r in rows) == [
        ("goal_difference", "3/2026-08-31"), ("played", "1/2026-08-31"), ("played", "1/2026-09-01"),
    ]


def test_every_served_competition_needs_rows(spark):
    tables = good_models(spark)
    rules = [r for r in c.fact_rules(["PD", "SA", "PL"]) if r.kind == c.COVERS]
    assert set(counts(c.failures(tables, rules)).values()) == {2}
    c.gate(c.failures(tables, c.fact_rules(["PD"])))


def test_key_checks_return_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (7,), (7,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    assert [tuple(r) for r in c.orphan_keys(child, ["k"], parent, ["id"], parent_unique=False).collect()] == [(7, 2)]
    assert sorted(tuple(r) for r in c.duplicate_keys(child, ["k"]).collect()) == [(1, 2), (7, 2)]


KEYS = "k bigint, season string"


@pytest.mark.parametrize("slots", [1, 50, 1 << 14, keyfilter.SLOTS])
def test_filtered_orphans_are_exact(spark, slots):
    """Whatever the size of the filter, also one that all keys fill; with nulls and repeated keys."""
    child = [(n, f"s{n % 3}") for n in range(0, 3000, 2)] + [(4, "s1"), (4, "s1"), (None, "s0"), (2, None)]
    parent = [(n, f"s{n % 3}") for n in range(0, 9000, 3)] * 2 + [(None, "s1"), (5, None)]
    frames = [spark.createDataFrame(rows, KEYS) for rows in (child, parent)]
    keys = ["k", "season"]
    got = c.orphan_keys(frames[0], keys, frames[1].toDF("id", "year"), ["id", "year"], parent_unique=False, filter_slots=slots)
    want = Counter(r for r in child if None not in r and r not in set(parent))
    assert {(r["k"], r["season"]): r["rows"] for r in got.collect()} == want
    found = keyfilter.key_filter(frames[0], keys, slots)
    passed = {tuple(r) for r in keyfilter.passing(frames[1], keys, found, slots).collect()}
    both = set(child) & set(parent)
    assert both <= passed and not any(None in r for r in passed)
    if slots >= 1 << 14:  # of 3000 parents 500 are referred to
        assert len(passed) <= len(both) + 10
    assert found.count() <= slots


def test_filtered_keys_of_other_types_and_empty_tables(spark):
    child = spark.createDataFrame([(1,), (2,), (7,)], "k bigint")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    none = spark.createDataFrame([], "k bigint")
    find = lambda a, b: sorted(tuple(r) for r in c.orphan_keys(a, ["k"], b, b.columns, False, keyfilter.SLOTS).collect())
    assert find(child, parent) == [(7, 1)]
    assert find(child, none) == [(1, 1), (2, 1), (7, 1)] and find(none, parent) == []
    with pytest.raises(ValueError, match="slots"):
        keyfilter.key_filter(child, ["k"], keyfilter.MAX_SLOTS + 1)


def test_a_filter_keeps_foreign_parents_out_of_the_shuffle(spark, tmp_path):
    spark.range(1000).toDF("k").write.parquet(f"{tmp_path}/child")
    spark.range(200_000).toDF("k").write.parquet(f"{tmp_path}/parent")
    child, parent = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("child", "parent"))

    def shuffled(**options):
        """The most rows that any exchange writes."""
        found = c.orphan_keys(child, ["k"], parent, ["k"], parent_unique=False, **options)
        assert found.collect() == []
        written, rest = [0], [found._jdf.queryExecution().executedPlan()]
        while rest:
            node = rest.pop()
            if node.nodeName() == "Exchange":
                written.append(node.metrics().apply("shuffleRecordsWritten").value())
            rest += [node.children().apply(i) for i in range(node.children().size())]
        return max(written)

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert shuffled() == 200_000
        assert shuffled(filter_slots=keyfilter.SLOTS) <= 1100
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_references_to_any_parent_key(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (7,)], "club int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    rules = [c.Rule("child", c.RELATION, "club", parent="parent", parent_keys=("id",))]
    found = counts(c.failures({"child": child, "parent": parent}, rules))
    assert found == {("child", "club", "relationships"): 1}
    same = c.failures({"child": child, "parent": parent.toDF("club")}, [c.Rule("child", c.RELATION, "club", parent="parent")])
    assert counts(same) == found


def reference(spark, ids, **changes):
    table = teams(spark, ids).select("competition_code", "team_id", *resolve.ARTWORK_COLUMNS)
    stamped = table.withColumn("sportsdb_fetched_at", F.lit("2026-08-31").cast("timestamp"))
    for column, new in changes.items():
        stamped = stamped.withColumn(column, new)
    return stamped


def test_membership_and_enrichment(spark):
    clubs = spark.createDataFrame([("PD", 1), ("PD", 2), ("PD", None)], "competition_code string, team_id bigint")
    table = reference(spark, [2, 3])
    status = {r["team_id"]: r["membership"] for r in resolve.membership(clubs, table).collect()}
    assert status == {1: "MISSING", 2: "MATCHED", 3: "OBSOLETE"}
    enriched = resolve.enrich(clubs.filter("team_id is not null"), table)
    found = counts(c.failures({"enriched": enriched}, resolve.ENRICHED_RULES))
    assert found["enriched", "sportsdb_badge_url", "not_null"] == 1
    cover = resolve.badge_coverage(enriched).first()
    assert (cover["team_count"], cover["resolved_count"], cover["badge_count"]) == (2, 1, 1)
    shared = resolve.enrich(
        clubs.filter("team_id is not null"),
        reference(spark, [1, 2], sportsdb_team_id=F.lit("5"), sportsdb_source=F.lit("Elsewhere")),
    )
    found = counts(c.failures({"enriched": shared}, resolve.ENRICHED_RULES))
    assert found["enriched", "sportsdb_team_id", "unique"] == 1
    assert found["enriched", "sportsdb_source", "accepted_values"] == 2
    named = table.withColumn("team_name", F.lit(None).cast("string"))
    twice = counts(c.failures({"reference": named.unionByName(named)}, resolve.reference_rules(["SA"])))
    assert twice["reference", "team_id", "unique"] == 2
    assert twice["reference", "team_name", "present"] == 1 and twice["reference", "team_id", "present"] == 0
    assert twice["reference", "competition_code", "accepted_values"] == 4


def test_resolution_order(spark):
    clubs = spark.createDataFrame(
        [
            ("PD", 1, "Reviewed", "Spain"), ("PD", 2, "Racing", "Spain"), ("PD", 3, "Only Abroad", "Spain"),
            ("PD", 4, "Nobody", "Spain"), ("PD", 5, "Wrong Sport", "Spain"), ("PD", 6, "Bare", "Spain"),
            ("PD", 7, "Odd Name", "Spain"), ("PD", 8, "Rugby Only", "Spain"), ("PD", 9, "Lost Id", "Spain"),
        ],
        "competition_code string, team_id bigint, team_name string, preferred_country string",
    )
    overrides = spark.createDataFrame([(1, "50"), (5, "60"), (9, "404")], "team_id bigint, sportsdb_team_id string")
    aliases = spark.createDataFrame([("Odd Name", "Proper Name")], "team_name string, search_name string")
    candidates = spark.createDataFrame(
        [
            (1, "10", "RACING", "Soccer", "Argentina", "b"), (2, "11", "racing", "Soccer", "SPAIN", "b"),
            (3, "12", "Racing", "Soccer", "spain", "b"), (4, "13", "Racing", "Basketball", "Spain", "b"),
            (5, "20", "Only Abroad", "Soccer", None, "b"), (6, "21", "Only Abroad", "Soccer", "Italy", "b"),
            (7, "50", "Other Name", "Soccer", "Italy", "b"), (8, "51", "Reviewed", "Soccer", "Spain", "b"),
            (9, "60", "Wrong Sport", "Rugby", "Spain", "b"), (10, "70", "Bare", "Soccer", "Spain", None),
            (11, "80", "Proper Name", "Soccer", "Spain", "b"), (12, "90", "Rugby Only", "Rugby", "Spain", "b"),
            (13, "91", "Lost Id", "Soccer", "Spain", "b"),
        ],
        "candidate_no bigint, sportsdb_team_id string, sportsdb_team_name string, sport string, country string, badge_url string",
    )
    resolved = resolve.resolve_clubs(clubs, overrides, candidates, aliases)
    rows = {r["team_id"]: (r["sportsdb_team_id"], r["sportsdb_resolution_method"], r["status"]) for r in resolved.collect()}
    assert rows == {
        1: ("50", "ID_OVERRIDE", "RESOLVED"),
        2: ("11", "NAME_SEARCH", "RESOLVED"),
        3: ("20", "NAME_SEARCH", "RESOLVED"),
        4: (None, "NAME_SEARCH", "NOT_FOUND"),
        5: (None, "ID_OVERRIDE", "REJECTED_SPORT"),
        6: ("70", "NAME_SEARCH", "NO_BADGE"),
        7: ("80", "NAME_SEARCH", "RESOLVED"),
        8: (None, "NAME_SEARCH", "NOT_FOUND"),
        9: (None, "ID_OVERRIDE", "NOT_FOUND"),
    }
    report = c.failures({"candidate": resolved}, resolve.CANDIDATE_RULES).unionByName(
        resolve.candidate_size_check(resolved, clubs.filter("team_id < 9"))
    )
    found = {(r["column_name"], r["failures"]) for r in report.collect()}
    assert found == {("team_id", 0), ("sportsdb_team_id", 4), ("sportsdb_badge_url", 5), ("sportsdb_team_id", 0), ("*", 1)}


def test_reviewed_ids_decide(spark):
    clubs = spark.createDataFrame(
        [("PD", 77, "Athletic", "Spain")], "competition_code string, team_id bigint, team_name string, preferred_country string"
    )
    candidates = spark.createDataFrame(
        [(1, "5", "Athletic", "Soccer", "Spain", "b"), (2, "133727", "Bilbao", "Soccer", "Spain", "b")],
        "candidate_no bigint, sportsdb_team_id string, sportsdb_team_name string, sport string, country string, badge_url string",
    )
    found = resolve.resolve_clubs(clubs, resolve.reviewed_overrides(spark), candidates).first()
    assert (found["sportsdb_team_id"], found["status"]) == ("133727", "RESOLVED")


def test_reviewed_ids_are_unique():
    assert len(resolve.REVIEWED_IDS) == len(set(resolve.REVIEWED_IDS.values())) == 20
