"""Column contracts of the tables the operators pass on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ELEMENT = (
    "doc_id string, path string, source_kind string, element_id string, "
    "element_type string, element_text string, page_number int, bbox variant, pos int"
)
PAGE = "doc_id string, path string, source_kind string, page_number int, page_text string, content_hash string"
DOCUMENT = (
    "doc_id string, source_path string, source_kind string, page_number int, "
    "page_text string, content_hash string, substation_name string, "
    "voltage_class_kv double, equipment_ids array<string>, study_date date, "
    "approving_engineer string, region string"
)
CHUNK = (
    "chunk_id string, doc_id string, source_path string, source_kind string, "
    "page_number int, chunk_index int, chunk_text string, substation_name string, "
    "voltage_class_kv double, equipment_ids array<string>, region string"
)
STRUCTURED = (
    "struct<topics:array<string>,equipment_mentioned:array<string>,"
    "decisions:array<struct<decision:string,rationale:string>>,"
    "failure_modes:array<string>,cross_references:array<string>,"
    "handshake_relationships:array<string>>"
)
EVAL_SET = "request string, expected_kind string, expected_contains_any array<string>"
EVAL_RUN = EVAL_SET + ", response string, contains_score double, run_id string, run_ts timestamp"


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def conform(frame: DataFrame, ddl: str, values: dict[str, Column] | None = None) -> DataFrame:
    """Select the contract's columns in its order; missing ones become typed NULLs.

    ``values`` overrides or supplies columns (literals, renames). Extra columns of
    the frame are dropped.
    """
    values = values or {}
    have = set(frame.columns)
    picked = []
    for field in struct_of(ddl).fields:
        if field.name in values:
            source = values[field.name]
        elif field.name in have:
            source = F.col(field.name)
        else:
            source = F.lit(None)
        picked.append(source.cast(field.dataType).alias(field.name))
    return frame.select(*picked)
