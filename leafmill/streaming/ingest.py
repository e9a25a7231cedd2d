"""Scheduled incremental ingest.

A run processes what arrived since the last one and stops (availableNow). Adapters
and filters are stateless, so the batch functions apply to a stream unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafmill.sources.elements import line_elements
from leafmill.sources.files import decode_text, identify


def file_stream(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """New files as rows: path, modificationTime, length, content, doc_id, source_kind.

    A file stream takes each path once. A changed document has to land under a new
    file name, or in a new file of a landed table (table_stream) that keeps its path
    in a column.
    """
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # Fixed by the binaryFile format.
    reader = reader.schema("path string, modificationTime timestamp, length bigint, content binary")
    return identify(reader.load(directory))


def table_stream(spark: SparkSession, directory: str, schema: str, glob: str | None = None) -> DataFrame:
    """New parquet files of a landing folder as rows.

    ``glob`` names files of the folder, or tables there that are folders of files.
    """
    reader = spark.readStream.schema(schema)
    # In braces a plain name is a pattern too, which may meet a single file: Spark takes any
    # other stream path for a folder.
    return reader.parquet(f"{directory.rstrip('/')}/{{{glob}}}" if glob else directory)


def ingest(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Append the transformed new rows to a parquet table, once each, then stop."""
    query = (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_text_files(spark: SparkSession, directory: str, out: str, checkpoint: str, glob: str | None = "*.txt") -> None:
    """Text files to element rows; unreadable files give no rows."""
    ingest(file_stream(spark, directory, glob), lambda files: line_elements(decode_text(files)), out, checkpoint)
