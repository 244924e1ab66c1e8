"""Data contracts: rules, failure counts, violating rows and the gate.

Counts come back as one row per rule. Row-level rules of a table share one scan and one
aggregate; key rules group by the key first, so a hot key collapses before the exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from touchline.functions.outcomes import MATCH_STATES
from touchline.operators import LEAGUE
from touchline.operators.keyfilter import key_filter, passing

NOT_NULL, UNIQUE = "not_null", "unique"
ACCEPTED, RELATION = "accepted_values", "relationships"
NOT_EMPTY, PRESENT, COVERS, ROW_RULE = "not_empty", "present", "covers", "row_rule"
ROW_LEVEL = (NOT_NULL, ACCEPTED, ROW_RULE)


class ContractError(ValueError):
    """Raised by the gate; the message lists every failing rule."""


@dataclass(frozen=True)
class Rule:
    """One check on ``model``. ``column`` names the tested column in reports; ``keys`` are
    the columns really compared (the column within its league, for example), for a reference
    with the ``parent_keys`` of ``parent``, by default columns of the same names."""

    model: str
    kind: str
    column: str
    keys: tuple[str, ...] = ()
    values: tuple = ()
    parent: str = ""
    parent_keys: tuple[str, ...] = ()
    condition: str = ""

    @property
    def tested(self) -> list[str]:
        return list(self.keys or (self.column,))

    @property
    def target(self) -> tuple[str, tuple[str, ...]]:
        """What a reference points at: the parent and its keys."""
        return self.parent, self.parent_keys or tuple(self.tested)

    @property
    def label(self) -> str:
        return self.condition if self.kind == ROW_RULE else self.kind


def _literal(value) -> str:
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def broken(rule: Rule) -> str:
    """SQL condition of a violating row. A comparison with NULL is not a violation."""
    if rule.kind == NOT_NULL:
        return f"{rule.column} IS NULL"
    if rule.kind == ACCEPTED:
        return f"{rule.column} NOT IN ({', '.join(map(_literal, rule.values))})"
    return f"NOT ({rule.condition})"


def _absent(rule: Rule) -> str:
    """1 for an empty table or a column without a value; for ``covers``, the number of
    expected values without a row."""
    if rule.kind == COVERS:
        return " + ".join(f"if(count_if({rule.column} = {_literal(v)}) = 0, 1, 0)" for v in rule.values)
    return f"if(count({rule.column}) = 0, 1, 0)"


def _report(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row of counts c0, c1, ... turned into one row per rule."""
    rows = ", ".join(
        f"{_literal(r.model)}, {_literal(r.column)}, {_literal(r.label)}, bigint(c{i})"
        for i, r in enumerate(rules)
    )
    return counts.selectExpr(f"stack({len(rules)}, {rows}) AS (model, column_name, rule, failures)")


def row_failures(table: DataFrame, rules: list[Rule]) -> DataFrame:
    """Failure counts of all row-level rules of one table in a single pass."""
    counts = [F.expr(f"count_if({broken(rule)}) AS c{i}") for i, rule in enumerate(rules)]
    return _report(table.agg(*counts), rules)


def violating_rows(table: DataFrame, key: Column, rules: list[Rule]) -> DataFrame:
    """Every violating row and the rule it breaks; one narrow pass, no shuffle."""
    hits = ", ".join(
        f"CASE WHEN {broken(r)} THEN named_struct('model', {_literal(r.model)}, "
        f"'column_name', {_literal(r.column)}, 'rule', {_literal(r.label)}) END"
        for r in rules
    )
    found = F.expr(f"explode(filter(array({hits}), hit -> hit IS NOT NULL)) AS hit")
    return table.select(key.cast("string").alias("row_key"), found).select("hit.*", "row_key")


def duplicate_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once, with their row count (NULL keys are ignored)."""
    return (
        table.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def orphan_keys(
    child: DataFrame,
    keys: list[str],
    parent: DataFrame,
    parent_keys: list[str],
    parent_unique: bool = True,
    filter_slots: int | None = None,
) -> DataFrame:
    """Child keys absent from the parent, with their row count (NULL keys pass).

    The child, and a parent whose key repeats, collapse to distinct keys before the anti
    join, so neither a hot key nor a large table reaches the join as rows. If the parent is much
    larger than the child has keys, ``filter_slots`` makes a filter of that many slots from the child,
    and parent rows that no child refers to are dropped where they are read.
    """
    children = (
        child.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    parents = parent.select(*[F.col(p).alias(k) for p, k in zip(parent_keys, keys, strict=True)])
    if filter_slots:
        kinds = {k: child.schema[k].dataType for k in keys}  # equal keys hash alike in one type only
        parents = parents.select(*[F.col(k).try_cast(kinds[k]).alias(k) for k in keys])
        parents = passing(parents, keys, key_filter(child, keys, filter_slots), filter_slots)
    if not parent_unique:
        parents = parents.distinct()
    return children.join(parents, keys, "left_anti")


def _relation_failures(child: DataFrame, parent: DataFrame, rules: list[Rule]) -> DataFrame:
    """Failure counts of several references from one child to one key of a parent, in one scan.

    Every row yields one (rule, key) per rule; those collapse in the map-side combine before
    they meet the parent.
    """
    parent_keys = rules[0].target[1]
    keys = [f"k{j}" for j in range(len(parent_keys))]
    references = ", ".join(f"{i}, {', '.join(rule.tested)}" for i, rule in enumerate(rules))
    flat = child.selectExpr(f"stack({len(rules)}, {references}) AS (rule_no, {', '.join(keys)})")
    parents = parent.select(*[F.col(p).alias(k) for p, k in zip(parent_keys, keys, strict=True)])
    lost = (
        flat.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys))
        .groupBy("rule_no", *keys)
        .agg(F.expr("count(*) AS rows"))
        .join(parents, keys, "left_anti")
    )
    counts = [
        F.expr(f"coalesce(sum(if(rule_no = {i}, rows, 0)), 0) AS c{i}") for i in range(len(rules))
    ]
    return _report(lost.agg(*counts), rules)


def failures(models: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """(model, column_name, rule, failures) for every rule.

    Each table is scanned once for its row-level rules, once for its references and once per
    unique key.
    """
    rules = list(rules)
    parts: list[DataFrame] = []
    for model in dict.fromkeys(rule.model for rule in rules):
        table = models[model]
        mine = [r for r in rules if r.model == model]
        row_level = [r for r in mine if r.kind in ROW_LEVEL]
        if row_level:
            parts.append(row_failures(table, row_level))
        relations = [r for r in mine if r.kind == RELATION]
        for target in dict.fromkeys(r.target for r in relations):
            parts.append(
                _relation_failures(table, models[target[0]], [r for r in relations if r.target == target])
            )
        whole = [r for r in mine if r.kind in (NOT_EMPTY, PRESENT, COVERS)]
        if whole:
            counts = [F.expr(f"{_absent(r)} AS c{i}") for i, r in enumerate(whole)]
            parts.append(_report(table.agg(*counts), whole))
        for rule in (r for r in mine if r.kind == UNIQUE):
            count = duplicate_keys(table, rule.tested).agg(F.expr("count(*) AS c0"))
            parts.append(_report(count, [rule]))
    return reduce(DataFrame.unionByName, parts)


def gate(report: DataFrame) -> None:
    """Raise when a rule fails. Only failing rules reach the driver (one row per rule)."""
    gate_counts([tuple(r) for r in report.filter(F.col("failures") > 0).collect()])


def gate_counts(counts: Iterable[tuple[str, str, str, int]]) -> None:
    """Raise when one of some (model, column_name, rule, failures) has failures."""
    lines = sorted(f"{model}.{column} {rule}: {n}" for model, column, rule, n in counts if n)
    if lines:
        raise ContractError("contract violated\n" + "\n".join(lines))


class Observed:
    """Rules on single rows and whole tables, counted while the table is written.

    The counts are metrics of the write's own job, so they cost no scan; rules on keys cannot
    be counted that way and read the written table.
    """

    KINDS = (*ROW_LEVEL, NOT_EMPTY, PRESENT, COVERS)

    def __init__(self, rules: Iterable[Rule]):
        self.rules = [r for r in rules if r.kind in self.KINDS]
        self._seen = Observation()

    def watch(self, table: DataFrame) -> DataFrame:
        """The table, to be written once; the counts are known after that."""
        if not self.rules:
            return table
        counts = [
            F.expr(f"count_if({broken(r)}) AS c{i}") if r.kind in ROW_LEVEL else F.expr(f"{_absent(r)} AS c{i}")
            for i, r in enumerate(self.rules)
        ]
        return table.observe(self._seen, *counts)

    def counts(self) -> list[tuple[str, str, str, int]]:
        """(model, column_name, rule, failures); waits for the write to have ended."""
        found = self._seen.get if self.rules else {}
        return [(r.model, r.column, r.label, int(found[f"c{i}"])) for i, r in enumerate(self.rules)]


def write_and_check(
    tables: Mapping[str, Callable[[], DataFrame]], rules: Iterable[Rule], write: Callable[[str, DataFrame], DataFrame]
) -> DataFrame:
    """Build and write each table once, in order, and report all rules.

    ``write(name, rows)`` stores a table and returns it as stored; a later table may be built
    from it. (model, column_name, rule, failures) come from the writes' own jobs; those of key
    rules from the stored tables.
    """
    rules = list(rules)
    counts, stored = [], {}
    for name, build in tables.items():
        observed = Observed(r for r in rules if r.model == name)
        stored[name] = write(name, observed.watch(build()))
        counts += observed.counts()
    spark = next(iter(stored.values())).sparkSession
    report = spark.createDataFrame(counts, "model string, column_name string, rule string, failures bigint")
    keyed = [r for r in rules if r.kind not in Observed.KINDS]
    return report.unionByName(failures(stored, keyed)) if keyed else report


# --- catalogue -----------------------------------------------------------------

_CLUB_KEY = "competition_code"
_CLUB = (_CLUB_KEY, "team_id")

# Tested columns of every model. Identifiers of clubs are unique, and refer
# to the club table, within a competition.
_NOT_NULL = {
    "stg_teams": [
        "team_id", "team_name", "competition_code", "sportsdb_team_id", "sportsdb_badge_url",
        "sportsdb_source", "sportsdb_resolution_method",
    ],
    "stg_matches": ["match_id", "home_team_id", "away_team_id", "status"],
    "stg_standings": ["team_id", "position", "snapshot_date", "points"],
    "int_team_match_results": ["team_match_key", "match_id", "team_id", "opponent_team_id"],
    "int_standings_reconciliation": ["team_id", "snapshot_date", "is_reconciled"],
    "mart_current_standings": [
        "standings_key", "team_id", "position", "points", "snapshot_date", "is_reconciled",
    ],
    "mart_team_performance": [
        "team_performance_key", "team_id", "played", "points", "points_per_game",
    ],
    "mart_match_explorer": ["match_id", "matchday", "home_team_id", "away_team_id", "status"],
}
_UNIQUE = [
    ("stg_teams", "team_id", (_CLUB_KEY, "team_id")),
    ("stg_matches", "match_id", ()),
    ("int_team_match_results", "team_match_key", ()),
    ("int_standings_reconciliation", "team_id", (*LEAGUE, "team_id")),
    ("mart_current_standings", "standings_key", ()),
    ("mart_team_performance", "team_performance_key", ()),
    ("mart_match_explorer", "match_id", ()),
]
_ACCEPTED = [
    ("stg_teams", "sportsdb_source", ("TheSportsDB",)),
    ("stg_teams", "sportsdb_resolution_method", ("ID_OVERRIDE", "NAME_SEARCH")),
    ("int_team_match_results", "venue", ("HOME", "AWAY")),
    ("int_team_match_results", "team_result", ("W", "D", "L")),
    ("int_team_match_results", "points_earned", (0, 1, 3)),
    ("mart_match_explorer", "match_state", tuple(MATCH_STATES)),
]
_RELATIONS = [
    ("stg_matches", "home_team_id"),
    ("stg_matches", "away_team_id"),
    ("stg_standings", "team_id"),
    ("int_team_match_results", "team_id"),
    ("int_team_match_results", "opponent_team_id"),
    ("int_standings_reconciliation", "team_id"),
    ("mart_current_standings", "team_id"),
    ("mart_team_performance", "team_id"),
    ("mart_match_explorer", "home_team_id"),
    ("mart_match_explorer", "away_team_id"),
]


def not_null_rules() -> list[Rule]:
    return [Rule(m, NOT_NULL, c) for m, columns in _NOT_NULL.items() for c in columns]


def unique_rules() -> list[Rule]:
    return [Rule(m, UNIQUE, c, keys=keys) for m, c, keys in _UNIQUE]


def accepted_rules(competitions: Iterable[str]) -> list[Rule]:
    """Accepted values; the competition codes are those the deployment serves."""
    served = Rule("stg_matches", ACCEPTED, "competition_code", values=tuple(competitions))
    return [Rule(m, ACCEPTED, c, values=v) for m, c, v in _ACCEPTED] + [served]


def relationship_rules() -> list[Rule]:
    return [Rule(m, RELATION, c, keys=(_CLUB_KEY, c), parent="stg_teams", parent_keys=_CLUB) for m, c in _RELATIONS]


def model_rules(competitions: Iterable[str]) -> list[Rule]:
    """All 62 declarative checks of the published models."""
    return [
        *not_null_rules(), *unique_rules(), *accepted_rules(competitions), *relationship_rules(),
    ]


# Checks applied to freshly flattened tables, before anything is published.
FACT_RULES = [
    Rule("dim_team", NOT_EMPTY, "*"),
    Rule("dim_team", NOT_NULL, "team_id"),
    Rule("dim_team", UNIQUE, "team_id", keys=(_CLUB_KEY, "team_id")),
    Rule("fact_match", NOT_EMPTY, "*"),
    Rule("fact_match", NOT_NULL, "match_id"),
    Rule("fact_match", UNIQUE, "match_id"),
    Rule("fact_match", ROW_RULE, "home_team_id", condition="home_team_id <> away_team_id"),
    *[
        Rule("fact_match", RELATION, side, keys=(_CLUB_KEY, side), parent="dim_team", parent_keys=_CLUB)
        for side in ("home_team_id", "away_team_id")
    ],
    Rule("fact_standing_snapshot", NOT_EMPTY, "*"),
    Rule("fact_standing_snapshot", NOT_NULL, "team_id"),
    Rule("fact_standing_snapshot", UNIQUE, "team_id", keys=(*LEAGUE, "snapshot_date", "team_id")),
    Rule("fact_standing_snapshot", ROW_RULE, "played", condition="played = won + drawn + lost"),
    Rule(
        "fact_standing_snapshot", ROW_RULE, "goal_difference",
        condition="goal_difference = goals_for - goals_against",
    ),
    Rule("fact_standing_snapshot", RELATION, "team_id", keys=_CLUB, parent="dim_team", parent_keys=_CLUB),
]


def fact_rules(competitions: Iterable[str]) -> list[Rule]:
    """Fact checks, and rows for every served competition in each base table."""
    served = tuple(competitions)
    tables = ("dim_team", "fact_match", "fact_standing_snapshot")
    return [*FACT_RULES, *[Rule(t, COVERS, "competition_code", values=served) for t in tables]]


ROW_RULES = [rule for rule in FACT_RULES if rule.kind == ROW_RULE]
