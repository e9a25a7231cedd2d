"""Text files to the shared chunk table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from leafmill.operators.chunks import document_chunks, union_chunks
from leafmill.operators.consolidate import attach_fields_inline, attach_region
from leafmill.operators.debriefs import debrief_chunks
from leafmill.operators.fields import FieldRule, GateRule, extract_fields
from leafmill.operators.pages import canonical_copies, line_pages
from leafmill.sources.transcripts import assemble_transcripts


def canonical_pages(files: DataFrame) -> DataFrame:
    """Text files to pages without copies. The only shuffle is the one that matches
    copies; pages are cut inside each file's row."""
    return canonical_copies(line_pages(files))


def page_chunks(files: DataFrame) -> DataFrame:
    """Chunks of the canonical pages, for texts without fields: the field columns are NULL."""
    return document_chunks(canonical_pages(files).withColumnRenamed("path", "source_path"))


def document_table(
    files: DataFrame, rules: Sequence[FieldRule], gates: Sequence[GateRule], names: Sequence[str]
) -> DataFrame:
    """Canonical pages with the named fields; those of pages under review are NULL.

    Fields are read in the page's own row after the copies are gone, so the whole chain
    has the one shuffle that matches copies.
    """
    return attach_fields_inline(extract_fields(canonical_pages(files), rules), gates, names)


def fielded_chunks(
    files: DataFrame, rules: Sequence[FieldRule], gates: Sequence[GateRule], names: Sequence[str]
) -> DataFrame:
    """Text files to chunks that carry their page's accepted fields."""
    return document_chunks(document_table(files, rules, gates, names))


def regional_chunks(
    files: DataFrame,
    rules: Sequence[FieldRule],
    gates: Sequence[GateRule],
    names: Sequence[str],
    regions: DataFrame,
    on: str = "substation_name",
) -> DataFrame:
    """Text files to chunks with their page's fields and region (by the field ``on``)."""
    return document_chunks(attach_region(document_table(files, rules, gates, names), regions, on))


def corpus_chunks(files: DataFrame, turns: DataFrame) -> DataFrame:
    """Document chunks and transcript chunks in one table."""
    return union_chunks(page_chunks(files), debrief_chunks(assemble_transcripts(turns)))
