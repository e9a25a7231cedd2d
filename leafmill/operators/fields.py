"""Typed fields by declared rules, the review gate, and promotion after review."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.typed import DATE_FORMATS, typed


@dataclass(frozen=True)
class FieldRule:
    """How to read one field. Patterns are tried in order; group 1 is the value.

    kind is string, double, int, date, or list (all distinct matches).
    """

    name: str
    patterns: tuple[str, ...]
    kind: str = "string"
    units: tuple[str, ...] = ()
    formats: tuple[str, ...] = DATE_FORMATS


# The shape of equipment codes (whole kV, a letter of L B C T, slot).
EQUIPMENT_PATTERN = r"\b(\d{2,3}[LBCT]-\d+)\b"

SUBSTATION_RULES = (
    FieldRule(
        "substation_name",
        (
            r"(?m)^\s*([A-Z][\w' ]*?) Substation\b",
            r"(?m)Protection Coordination Study\s+[—–-]\s+([^\n]+?)\s*$",
        ),
    ),
    FieldRule(
        "voltage_class_kv",
        (r"Nominal voltage:\s*(\d+(?:\.\d+)?\s*kV)", r"Scope:\s*(\d+(?:\.\d+)?\s*kV)"),
        "double",
        units=("kV",),
    ),
    FieldRule("equipment_ids", (EQUIPMENT_PATTERN,), "list"),
    FieldRule("study_date", (r"Study date:\s*([0-9/-]+)",), "date"),
    FieldRule("approving_engineer", (r"Approved:\s*(.+?)\s*(?:(?:&nbsp;|\s)*Date:|\n|$)",)),
    FieldRule("bus_arrangement", (r"Bus arrangement is ([^.\n]+)\.",)),
    FieldRule("scada_rtu_model", (r"SCADA RTU is ([^;\n]+);",)),
    FieldRule("last_thermal_inspection_year", (r"Last full thermal inspection:\s*(\d{4})",), "int"),
)


def mentions(text: Column, pattern: str = EQUIPMENT_PATTERN) -> Column:
    """Distinct codes of a text in order of first mention."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))


def field_column(text: Column, rule: FieldRule) -> Column:
    if rule.kind == "list":
        found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in rule.patterns])
        return F.array_distinct(found)
    raw = F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in rule.patterns])
    return typed(raw, rule.kind, rule.units, rule.formats)


def extract_fields(pages: DataFrame, rules: Sequence[FieldRule] = SUBSTATION_RULES, text: str = "page_text") -> DataFrame:
    """Add one struct column ``fields`` with a typed member per rule."""
    return pages.withColumn(
        "fields", F.struct(*[field_column(F.col(text), rule).alias(rule.name) for rule in rules])
    )


def typed_fields(
    pages: DataFrame,
    rules: Sequence[FieldRule] = SUBSTATION_RULES,
    text: str = "page_text",
    version: str = "rules",
) -> DataFrame:
    """Field table: page key, a column per rule, and the version that produced it."""
    keys = [c for c in ("doc_id", "path", "source_kind", "page_number") if c in pages.columns]
    return extract_fields(pages, rules, text).select(
        *keys, "fields.*", F.lit(version).alias("extraction_model_version")
    )


# A gate rule is a reason and the condition under which a row fails.
GateRule = tuple[str, Column]


def substation_gate() -> list[GateRule]:
    return [
        ("study without date", (F.col("source_kind") == "protection_study") & F.col("study_date").isNull()),
        ("no substation name", F.col("substation_name").isNull()),
    ]


def gate(fields: DataFrame, rules: Sequence[GateRule]) -> DataFrame:
    """Add ``review_reasons``: the reasons of all failing rules, empty if none.

    An unknown condition counts as not failing, so every row has a side.
    """
    reasons = F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(why)) for why, cond in rules])
    return fields.withColumn("review_reasons", F.array_compact(reasons))


def split_gate(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted without the reasons, to review with them): total and disjoint."""
    failing = F.size("review_reasons") > 0
    return gated.where(~failing).drop("review_reasons"), gated.where(failing)


def promote(review: DataFrame, curated: DataFrame, approved: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Move approved review rows to the curated table: (curated, still in review)."""
    wanted = approved.select(*keys).distinct()
    moved = review.join(wanted, list(keys), "left_semi").drop("review_reasons")
    rest = review.join(wanted, list(keys), "left_anti")
    return curated.unionByName(moved), rest
