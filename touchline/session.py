"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import tempfile
import time
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Result-relevant (time zone) and plan-relevant (AQE) settings. The broadcast threshold stays
# whatever the cluster configured: it is the size check of every small join side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "local").startswith("local")


def tune(spark: SparkSession) -> SparkSession:
    """Apply the engine's runtime SQL settings to an existing session.

    Partition numbers are the cluster's to configure (``spark.sql.shuffle.partitions`` and
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``), the same way everywhere.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app_name: str = "touchline") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without the setting (tests) falls back to a fresh
    temporary folder; on a cluster the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="touchline-")


def _located(spark: SparkSession, path: str):
    """A path and its file system, which need not be a local one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _located(spark, path)
    return files.exists(folder)


def folders_of(spark: SparkSession, path: str, age_seconds: float = 0.0) -> list[str]:
    """Names of the folders in a folder that were last changed at least so long ago."""
    folder, files = _located(spark, path)
    if not files.exists(folder):
        return []
    latest = (time.time() - age_seconds) * 1000
    found = [f for f in files.listStatus(folder) if f.isDirectory() and f.getModificationTime() <= latest]
    return sorted(f.getPath().getName() for f in found)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    folder, files = _located(spark, path)
    files.delete(folder, True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below ``shared_dir``; it is deleted when the application ends."""
    path = f"{shared_dir(spark)}/touchline-{uuid4().hex}"
    folder, files = _located(spark, path)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def read_text(spark: SparkSession, path: str) -> str:
    """A short text file, by the driver alone."""
    file, files = _located(spark, path)
    stream = files.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write or replace a short text file."""
    file, files = _located(spark, path)
    stream = files.create(file, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a short text file with its whole content, unless it exists; of several callers at
    once one succeeds.

    The text is written apart and then takes its name: by a hard link on a local file system,
    whose rename would replace, and elsewhere by a rename that must not.
    """
    jvm = spark.sparkContext._jvm
    file, files = _located(spark, path)
    apart = f"{path}.{uuid4().hex}"
    write_text(spark, apart, text)
    written, _ = _located(spark, apart)
    try:
        if files.getScheme() == "file":
            java_path = lambda p: jvm.java.nio.file.Path.of(files.makeQualified(p).toUri())
            jvm.java.nio.file.Files.createLink(java_path(file), java_path(written))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri())
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(written, file, options)
        return True
    except Py4JJavaError:
        if not files.exists(file):
            raise
        return False
    finally:
        files.delete(written, False)
