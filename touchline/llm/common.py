"""Helpers shared by the text operators: settings, table reads, written intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterable
from pathlib import Path
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import shared_dir, tune

# Arrow batches are bounded by rows and by bytes, so that a batch of long texts fits a worker.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parent.parent
        archive = Path(tempfile.mkdtemp()) / package.name
        context.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    ship(spark)
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame) -> DataFrame:
    """Write ``frame`` below the shared folder and read it back.

    Cuts the lineage with files that survive a lost executor, and fixes row ids. Spark
    deletes the folder when the application ends.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/touchline-llm-{uuid4().hex}"
    frame.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    found = spark.read.schema(frame.schema).parquet(path)
    found.staged_at = path
    return found


def unstaged(frame: DataFrame) -> None:
    """Delete the files of a ``staged`` frame that nothing will read again."""
    spark = frame.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.staged_at)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def fresh(name: str, columns: Iterable[str]) -> str:
    """``name``, with underscores after it until it is none of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
