"""Run events in numbered batches, with a compacted log of the older ones.

    events/batch=<n>/...        events as they came
    compacted (published)       the deciding events of all batches up to the version's number

Readers take the compacted log and the batches after it. A compaction reads the same, so it never
goes through the old events again. Folding an event twice changes nothing, hence a batch that was
written again or compacted twice does no harm; a compaction that fails leaves the one before.
Batches that the compacted log covers are never written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.operators.runlog import deciding_events
from touchline.sources.tables import current_version, publish, read_published, write_table

COMPACTED = "compacted"


def append_batch(events: DataFrame, root: str, batch: int) -> None:
    """Write a batch; a repeated one replaces itself."""
    write_table(events, f"{root}/events/batch={batch}")


def read_log(spark: SparkSession, root: str, schema: StructType, through: int | None = None) -> DataFrame:
    """Compacted events and the batches after them, up to ``through`` if given."""
    version = current_version(spark, root)
    known = StructType([*schema.fields]).add("batch", "long")
    tail = spark.read.schema(known).parquet(f"{root}/events")
    if through is not None:
        tail = tail.filter(F.col("batch") <= through)
    if version is None:
        return tail.drop("batch")
    older = read_published(spark, root, {COMPACTED: schema})[COMPACTED]
    return tail.filter(F.col("batch") > int(version)).drop("batch").unionByName(older)


def compact(spark: SparkSession, root: str, schema: StructType, through: int) -> None:
    """Publish the deciding events of all batches up to a number."""
    publish(spark, {COMPACTED: deciding_events(read_log(spark, root, schema, through))}, root, str(through), [])
