"""Processed Parquet tables and atomically published versions of them."""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from touchline.operators.contracts import Rule, failures, gate
from touchline.schemas import MANIFEST
from touchline.session import exists

SNAPSHOT = ["competition_code", "snapshot_date"]


def write_table(table: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table. Rebalancing splits hot partitions into even files."""
    if partition_by:
        table.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(
            *partition_by
        ).parquet(path)
    else:
        table.write.mode("overwrite").parquet(path)


def replace_partitions(table: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions present in ``table``; the others stay."""
    (
        table.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_snapshots(table: DataFrame, path: str) -> None:
    """Replace exactly the snapshots present in ``table``; other dates stay."""
    replace_partitions(table, path, SNAPSHOT)


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Parquet scan with a declared schema, also for the folder columns; no file is opened
    to infer one."""
    return spark.read.schema(schema).parquet(path)


# --- tables that lie together -----------------------------------------------------


def write_bucketed(table: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table in sorted buckets by key. Tables with the same buckets join and group by these
    keys without a shuffle. Each bucket is one file, so no key should hold many rows: reduce match
    rows to sums first."""
    (
        table.repartition(buckets, *keys)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    return table.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession, name: str, path: str, schema: StructType, keys: list[str], buckets: int
) -> DataFrame:
    """A table that another session has written in buckets; how it lies is stated, not read."""
    listed = ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet "
        f"CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def read_by_name(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet files united by column name; a column missing from a file is NULL.

    With a declared schema no footer is opened beforehand. Without one, the columns of all
    files are found from their footers, and the folder columns are text.
    """
    if schema is None:
        merged = spark.read.option("mergeSchema", True).parquet(path).schema
        schema = StructType([StructField(f.name, StringType()) if f.name in SNAPSHOT else f for f in merged])
    return read_table(spark, path, schema)


# --- published versions -----------------------------------------------------------


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    version: str,
    rules: list[Rule],
    partition_by: Mapping[str, list[str]] | None = None,
    context: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Write a complete new version, check it, and only then make it current.

    Each attempt writes to a folder of its own, which its manifest row names, so a repeated
    version never touches what readers see. Rules run on the written tables; ``context`` holds
    other tables the rules mention. The manifest row is appended last: a failed write or check
    leaves the previous attempt current and the rejected one behind for audit.
    """
    partition_by = partition_by or {}
    folder = f"{version}-{uuid4().hex}"
    for name, table in tables.items():
        write_table(table, f"{root}/{folder}/{name}", partition_by.get(name))
    written = {
        name: read_table(spark, f"{root}/{folder}/{name}", table.schema)
        for name, table in tables.items()
    }
    if rules:
        gate(failures({**(context or {}), **written}, rules))
    spark.range(1).select(
        F.lit(version).alias("version"), F.lit(folder).alias("folder"), F.current_timestamp().alias("published_at")
    ).write.mode("append").json(f"{root}/_manifest")
    return written


def _current(spark: SparkSession, root: str) -> Row | None:
    if not exists(spark, f"{root}/_manifest"):
        return None
    manifest = spark.read.schema(MANIFEST).json(f"{root}/_manifest")
    return manifest.agg(F.max_by(F.struct("version", "folder"), "published_at").alias("last")).first()["last"]


def current_version(spark: SparkSession, root: str) -> str | None:
    """Newest published version (NULL before the first publication)."""
    last = _current(spark, root)
    return last and last["version"]


def read_published(
    spark: SparkSession, root: str, schemas: Mapping[str, StructType | str]
) -> dict[str, DataFrame]:
    """Tables of the current version, by name and schema."""
    last = _current(spark, root)
    if last is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return {name: read_table(spark, f"{root}/{last['folder']}/{name}", s) for name, s in schemas.items()}
