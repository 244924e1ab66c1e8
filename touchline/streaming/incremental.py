"""Process only newly landed snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.documents import (
    FLATTEN,
    SNAPSHOT,
    document_schema,
    only_snapshots,
    scan,
)
from touchline.sources.tables import write_snapshots

# Log beside the stream's own checkpoint: snapshots a batch has touched, and batches done.
PROGRESS = "kind string, batch_id bigint, competition_code string, snapshot_date string"
STARTED, CHANGED, DONE = "STARTED", "CHANGED", "DONE"


def ingest_new_snapshots(
    spark: SparkSession,
    raw_root: str,
    dataset: str,
    table_path: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> None:
    """Flatten snapshots landed since the last call and replace them in the table.

    The file stream remembers which files it has seen, and its batches only append the names
    of the snapshots that changed to a log. After the stream each changed snapshot is read
    whole and overwritten, once however many batches it was spread over. The batches count as
    done only then: a call that ends in between leaves them to the next one. A replayed batch
    and a re-landed date end in the same table; other snapshots are neither read nor written.
    """
    log = f"{checkpoint}/progress"

    def append(rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").json(log)

    def mark(kind: str, batch_id: int) -> None:
        append(spark.range(1).select(F.lit(kind).alias("kind"), F.lit(batch_id).alias("batch_id")))

    def note(batch: DataFrame, batch_id: int) -> None:
        changed = batch.select(*SNAPSHOT).distinct()
        append(changed.select(F.lit(CHANGED).alias("kind"), F.lit(batch_id).alias("batch_id"), *SNAPSHOT))

    mark(STARTED, -1)
    (
        spark.readStream.schema(document_schema(dataset))
        .option("maxFilesPerTrigger", files_per_batch)
        .option("mode", "FAILFAST")
        .json(f"{raw_root}/{dataset}")
        .writeStream.foreachBatch(note)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    progress = spark.read.schema(PROGRESS).json(log)
    last = progress.agg(
        F.max(F.when(F.col("kind") == CHANGED, F.col("batch_id"))).alias("seen"),
        F.max(F.when(F.col("kind") != CHANGED, F.col("batch_id"))).alias("done"),
    ).first()
    if last["seen"] is None or last["seen"] <= last["done"]:
        return
    changed = progress.filter((F.col("kind") == CHANGED) & (F.col("batch_id") > last["done"])).select(*SNAPSHOT)
    rows = FLATTEN[dataset](only_snapshots(scan(spark, raw_root, dataset), changed))
    if "snapshot_date" not in rows.columns:
        rows = rows.withColumn("snapshot_date", F.col("source_snapshot_date"))
    write_snapshots(rows, table_path)
    mark(DONE, last["seen"])
