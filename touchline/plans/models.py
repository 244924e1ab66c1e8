"""Model registry: names, layers and builders of the published models.

A model is a function of other models. ``Models`` builds each one lazily and once per
instance; nothing runs until a result is written or read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame

from touchline.operators import health
from touchline.operators.matches import match_explorer
from touchline.operators.participants import team_match_results
from touchline.operators.performance import team_performance
from touchline.operators.standings import current_standings, standings_reconciliation
from touchline.schemas import DIM_TEAM, FACT_MATCH, FACT_STANDING_SNAPSHOT, column_names

SOURCES = {
    "dim_team": DIM_TEAM,
    "fact_match": FACT_MATCH,
    "fact_standing_snapshot": FACT_STANDING_SNAPSHOT,
}

Ref = Callable[[str], DataFrame]


def _staging(source: str) -> Callable[[Ref], DataFrame]:
    """Explicit column list of a base table."""
    columns = column_names(SOURCES[source])
    return lambda ref: ref(source).select(*columns)


# model -> (layer, builder)
BUILDERS: dict[str, tuple[str, Callable[[Ref], DataFrame]]] = {
    "stg_teams": ("Staging", _staging("dim_team")),
    "stg_matches": ("Staging", _staging("fact_match")),
    "stg_standings": ("Staging", _staging("fact_standing_snapshot")),
    "int_team_match_results": (
        "Intermediate", lambda ref: team_match_results(ref("stg_matches"))
    ),
    "int_standings_reconciliation": (
        "Intermediate",
        lambda ref: standings_reconciliation(ref("stg_standings"), ref("int_team_match_results")),
    ),
    "mart_current_standings": (
        "Mart",
        lambda ref: current_standings(
            ref("stg_standings"), ref("int_team_match_results"), ref("stg_teams")
        ),
    ),
    "mart_team_performance": (
        "Mart", lambda ref: team_performance(ref("int_team_match_results"), ref("stg_teams"))
    ),
    "mart_match_explorer": (
        "Mart", lambda ref: match_explorer(ref("stg_matches"), ref("stg_teams"))
    ),
}
MARTS = [name for name, (layer, _) in BUILDERS.items() if layer == "Mart"]


class Models(Mapping):
    """Base tables (or their builders) plus every model derived from them, by name."""

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        missing = set(SOURCES) - set(tables)
        if missing:
            raise KeyError(f"missing base tables: {sorted(missing)}")
        self._tables = tables
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            given = self._tables.get(name)
            if given is None:
                given = BUILDERS[name][1](self.__getitem__)
            self._built[name] = given if isinstance(given, DataFrame) else given()
        return self._built[name]

    def __iter__(self):
        return iter([*SOURCES, *BUILDERS])

    def __len__(self) -> int:
        return len(SOURCES) + len(BUILDERS)

    def inventory(self) -> DataFrame:
        """Row counts of base tables and models in layer order."""
        listed = [("Warehouse", name, self[name]) for name in SOURCES]
        listed += [(layer, name, self[name]) for name, (layer, _) in BUILDERS.items()]
        return health.row_counts(listed)

    def create_views(self, names: Iterable[str] | None = None) -> None:
        """Register models as temporary views, for SQL users."""
        for name in names or list(self):
            self[name].createOrReplaceTempView(name)
