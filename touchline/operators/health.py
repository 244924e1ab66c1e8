"""Warehouse health: overview row and model inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.numbers import count_where, percentage

LAYERS = ["Warehouse", "Staging", "Intermediate", "Mart"]


def health_overview(matches: DataFrame, standings: DataFrame, current: DataFrame) -> DataFrame:
    """One row of freshness and reconciliation figures.

    One aggregate per table; the one-row results are stacked and folded instead of being
    cross joined. Rows collapse per snapshot date first, which keeps the text maximum off
    the wide aggregate.
    """
    loads = matches.groupBy("source_snapshot_date").agg(
        F.count(F.lit(1)).alias("rows"), F.max("loaded_at").alias("loaded_at")
    )
    parts = [
        loads.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("match_rows"),
            F.max("source_snapshot_date").alias("latest_source_snapshot"),
            F.max("loaded_at").alias("latest_warehouse_load"),
        ),
        standings.select("snapshot_date").distinct().agg(F.count("snapshot_date").alias("standing_snapshots")),
        current.agg(
            count_where(F.col("is_reconciled")).alias("reconciled_teams"),
            F.count(F.lit(1)).alias("total_teams"),
        ),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    columns = [
        "match_rows", "standing_snapshots", "latest_source_snapshot", "latest_warehouse_load",
        "reconciled_teams", "total_teams",
    ]
    row = stacked.agg(*[F.max(c).alias(c) for c in columns])
    return row.withColumn(
        "reconciliation_rate", percentage(F.col("reconciled_teams"), F.col("total_teams"))
    )


def row_counts(models: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Rows per model in layer order; ``models`` holds (layer, model, table)."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(LAYERS.index(layer) + 1).alias("layer_no"),
            F.lit(layer).alias("layer"),
            F.lit(name).alias("model"),
            "rows",
        )
        for layer, name, table in models
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("layer_no", "model")
