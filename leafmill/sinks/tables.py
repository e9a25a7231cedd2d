"""Tables: namespaces, rewrites, appended runs, and counts taken while writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULT_SCHEMAS = ("raw", "curated", "agents")


def ensure_schemas(spark: SparkSession, names: Sequence[str] = DEFAULT_SCHEMAS, root: str | None = None) -> None:
    """Create what is missing, below ``root`` if given, else in the warehouse."""
    for name in names:
        place = "" if root is None else f" LOCATION '{root.rstrip('/')}/{name}'"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def drop_schemas(spark: SparkSession, names: Sequence[str]) -> None:
    """Drop schemas of a finished run, with their tables."""
    for name in names:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def stamped(frame: DataFrame, column: str) -> DataFrame:
    """Time of writing. Only sinks stamp, so that results can be compared."""
    return frame.withColumn(column, F.current_timestamp())


def overwrite_table(frame: DataFrame, name: str) -> int:
    """Rewrite a table, taking the frame's schema; returns the rows written.

    The count is observed in the writing pass: the plan does not run twice.
    """
    seen = Observation()
    frame.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").saveAsTable(name)
    return seen.get["n"]


def write_counted(frame: DataFrame, path: str, counts: dict[str, Column] | None = None) -> dict[str, int]:
    """Write parquet and return counts observed on the way: ``rows`` and any extra."""
    seen = Observation()
    wanted = {"rows": F.count(F.lit(1)), **(counts or {})}
    observed = frame.observe(seen, *[expr.alias(label) for label, expr in wanted.items()])
    observed.write.mode("overwrite").parquet(path)
    return dict(seen.get)


def append_run(runs: DataFrame, path: str) -> None:
    """Append an evaluation run. One folder per run_id; writing a run again replaces
    that run only, so a retried job adds nothing twice."""
    (
        runs.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs; columns that later runs added are NULL in earlier ones."""
    runs = spark.read.option("mergeSchema", "true").parquet(path)
    return runs.withColumn("run_id", F.col("run_id").cast("string"))


def write_gated(gated: DataFrame, path: str) -> None:
    """Both sides of the gate in one pass, split by folder."""
    side = F.when(F.size("review_reasons") > 0, "review").otherwise("curated")
    gated.withColumn("side", side).write.mode("overwrite").partitionBy("side").parquet(path)
