"""Pages and fields to one document table, from one or many sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators.fields import GateRule, gate

MATCH = ["doc_id", "page_number"]


def merge_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Union of adapted frames by name, each tagged; absent columns become NULL."""
    tagged = [frame.withColumn("source_system", F.lit(name)) for name, frame in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def attach_fields(pages: DataFrame, fields: DataFrame) -> DataFrame:
    """Left join on document and page. A page whose fields are under review stays,
    with NULL fields.

    There is one field row per page. Should a page have been delivered several times,
    its field rows are reduced to one first, so no page is multiplied.
    """
    extra = [c for c in fields.columns if c not in pages.columns and c != "extracted_at"]
    one = fields.groupBy(*MATCH).agg(F.min(F.struct(*extra)).alias("f")).select(*MATCH, "f.*")
    return pages.join(one, MATCH, "left").withColumnRenamed("path", "source_path")


def attach_fields_inline(extracted: DataFrame, rules: Sequence[GateRule], names: Sequence[str]) -> DataFrame:
    """The same result without join or shuffle, when the frame still has its
    extracted ``fields``: blank the named fields of rows that the gate holds back."""
    flat = extracted.select("*", *[F.col(f"fields.{n}").alias(n) for n in names])
    gated = gate(flat, rules)
    accepted = F.size("review_reasons") == 0
    kept = [c for c in extracted.columns if c != "fields"]
    return gated.select(*kept, *[F.when(accepted, F.col(n)).alias(n) for n in names]).withColumnRenamed(
        "path", "source_path"
    )


def attach_region(documents: DataFrame, regions: DataFrame, on: str = "substation_name", region: str = "region") -> DataFrame:
    """Region by name. A name with several regions gets none, so that only those who see
    all rows see it (``region_conflicts`` lists them). Spark broadcasts the mapping when
    its measured size allows, and splits hot names otherwise (AQE).

    Documents keep the region as a column of their contract, and so do their chunks and
    the index made of these. A region that documents had before is replaced."""
    one = F.when(F.min(region) == F.max(region), F.min(region))
    plain = documents.drop(region) if region != on else documents
    return plain.join(regions.groupBy(on).agg(one.alias(region)), on, "left")


def region_conflicts(regions: DataFrame, on: str = "substation_name", region: str = "region") -> DataFrame:
    """Names mapped to several regions, with the regions."""
    grouped = regions.groupBy(on).agg(F.sort_array(F.collect_set(region)).alias("regions"))
    return grouped.where(F.size("regions") > 1)
