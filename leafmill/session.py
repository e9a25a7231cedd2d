"""Session set-up and staged tables.

A staged table is a parquet copy of a frame below the shared checkpoint folder. It
cuts lineage and is columnar, so later passes read only the columns they need. It
survives the loss of executors, which a local checkpoint does not.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. A cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("leafmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; one of our own only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    set_before = spark.sparkContext.getCheckpointDir()
    if set_before:
        return set_before
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="leafmill-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir() or own


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/leafmill-staged/{label}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, label: str) -> DataFrame:
    """Write the frame once and return a scan of the written table."""
    spark = frame.sparkSession
    path = staging_path(spark, label)
    frame.write.mode("errorifexists").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


# Codec of wide tables: about two thirds of the usual one's bytes.
DENSE = "zstd"

# Whether the files of a query's exchanges go when it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_exchanges(spark: SparkSession) -> Iterator[None]:
    """The exchanges of each write in the block are removed when it ends. Otherwise they stay
    until the driver happens to collect its garbage, so a chain of writes holds them all."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


@contextmanager
def staged(frame: DataFrame, label: str) -> Iterator[DataFrame]:
    """As ``stage``, for a wide table that nothing reads after the block: its files go with it."""
    spark = frame.sparkSession
    path = staging_path(spark, label)
    try:
        with freed_exchanges(spark):
            frame.write.mode("errorifexists").option("compression", DENSE).parquet(path)
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        named = spark._jvm.org.apache.hadoop.fs.Path(path)
        named.getFileSystem(spark._jsc.hadoopConfiguration()).delete(named, True)


def clear_staged(spark: SparkSession) -> bool:
    """Remove all staged tables below the checkpoint folder; whether there were any.

    For the end of a job: frames that read staged tables cannot be computed afterwards, in
    this session or another that shares the folder. Indexes and corpora kept under a root of
    the caller's are not touched.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_folder(spark).rstrip('/')}/leafmill-staged")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(path, True)
