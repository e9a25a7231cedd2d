"""Landed tables in the file contract: path, text, doc_id, source_kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.sources.files import identify

# Kinds of the landed documents by their source folder; all others are unknown.
LANDED_ROUTES = (("/src0/", "oneline"), ("/src1/", "protection_study"))


def documents_as_files(documents: DataFrame, routes: Sequence[tuple[str, str]] = LANDED_ROUTES) -> DataFrame:
    """Rows (doc_id, source, text) as text files /corpus/{source}/{doc_id}."""
    path = F.concat(F.lit("/corpus/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    return identify(documents.select(path.alias("path"), "text", "lang"), routes)


def web_pages_as_files(pages: DataFrame) -> DataFrame:
    """Rows (url, html) as HTML files of kind web_page."""
    return identify(pages.select(F.col("url").alias("path"), "html"), (), "web_page")


def transcripts_as_files(transcripts: DataFrame) -> DataFrame:
    return identify(
        transcripts.select(F.col("source_path").alias("path"), F.col("transcript").alias("text")), (), "debrief"
    )
