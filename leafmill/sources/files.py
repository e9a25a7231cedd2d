"""File scans. Any URI scheme Spark can list works: local, object store, share."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.columns import KIND_ROUTES, UNKNOWN_KIND, path_id, route_kind


def identify(
    frame: DataFrame,
    routes: Sequence[tuple[str, str]] = KIND_ROUTES,
    default: str = UNKNOWN_KIND,
) -> DataFrame:
    """Add doc_id and source_kind to any frame with a ``path`` column.

    Landed tables (path, content) enter here and then look like scanned files.
    """
    return frame.withColumn("doc_id", path_id(F.col("path"))).withColumn(
        "source_kind", route_kind(F.col("path"), routes, default)
    )


def spread(frame: DataFrame) -> DataFrame:
    """Even out an input of fewer splits than the session has cores.

    A few large unsplittable files would otherwise be parsed by as few tasks. Inputs
    with enough splits, so any large table, pass unchanged.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores)


def scan_files(
    spark: SparkSession,
    directory: str,
    glob: str | None = None,
    recursive: bool = True,
    routes: Sequence[tuple[str, str]] = KIND_ROUTES,
) -> DataFrame:
    """One row per file: path, modificationTime, length, content, doc_id, source_kind."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return identify(reader.load(directory), routes)


def decode_text(files: DataFrame, name: str = "text") -> DataFrame:
    """Bytes to text. Files that are not UTF-8 get NULL instead of failing the job."""
    return files.withColumn(name, F.try_validate_utf8(F.col("content").cast("string")))


def split_decodable(decoded: DataFrame, name: str = "text") -> tuple[DataFrame, DataFrame]:
    """(readable rows, rejected rows without content)."""
    good = decoded.where(F.col(name).isNotNull()).drop("content")
    bad = decoded.where(F.col(name).isNull()).drop("content", name)
    return good, bad


# Byte-order marks, longer ones before those they begin with.
ENCODING_MARKS = (
    ("0000FEFF", "UTF-32BE"),
    ("FFFE0000", "UTF-32LE"),
    ("EFBBBF", "UTF-8"),
    ("FEFF", "UTF-16BE"),
    ("FFFE", "UTF-16LE"),
)


def encoding_mark(content: Column) -> Column:
    """The encoding that the first bytes announce; NULL without a mark."""
    head = F.hex(F.substring(content, 1, 4))
    found = F.lit(None).cast("string")
    for mark, encoding in reversed(ENCODING_MARKS):
        found = F.when(head.startswith(mark), encoding).otherwise(found)
    return found


def first_bad_byte(content: Column) -> Column:
    """How many bytes come before the first that is not UTF-8; NULL if all are, or there is no content."""

    @F.pandas_udf("bigint")
    def place(column: pd.Series) -> pd.Series:
        def of(raw):
            try:
                bytes(raw).decode("utf-8")
            except UnicodeDecodeError as problem:
                return problem.start
            return None

        return column.map(of, na_action="ignore").astype("Int64")

    return place(content)


def located_rejects(decoded: DataFrame, name: str = "text") -> DataFrame:
    """Rejected files as rows: all columns but content and text, with ``bad_at`` (the offset
    of the first byte that is not UTF-8) and ``encoding_mark``. Only rejected files are
    looked through again. A file without content is rejected with both NULL."""
    bad = decoded.where(F.col(name).isNull())
    return bad.withColumns(
        {"bad_at": first_bad_byte(F.col("content")), "encoding_mark": encoding_mark(F.col("content"))}
    ).drop("content", name)


def read_transcripts(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """Whole-file transcripts: source_path, transcript (NULL if unreadable), debrief_id."""
    files = decode_text(scan_files(spark, directory, glob), "transcript")
    return files.select(F.col("path").alias("source_path"), "transcript", F.col("doc_id").alias("debrief_id"))
