"""A corpus pipeline in five stages; each works on all that the one before kept.

A stage takes (spark, docs, sf_dir); docs has the columns of ``documents``. All but the
last return these columns and no others. Rows without an id go through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.bpe import encoded
from leafmill.llm.common import numbered, table, without_keys
from leafmill.llm.leaks import leaks
from leafmill.llm.minmax import near_duplicates
from leafmill.llm.quality import THRESHOLD, fitted, scored
from leafmill.llm.repeats import without_repeats
from leafmill.session import stage, staging_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = fitted(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored(docs.select(*COLUMNS), model).where(F.col("score") >= THRESHOLD).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id; rows without an id come last.

    Rows are judged one by one: of rows that share an id, different texts all stay.
    """
    rows = numbered(docs.select(*COLUMNS, F.xxhash64("text").alias("hash")), "row")
    judged = stage(near_duplicates(rows, doc_id="row").select(F.col("doc_id").alias("row"), "component_id"), "pipeline-groups")
    # The order of a group's rows is found by narrow columns.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "hash", "row")
    first = judged.join(rows.select("row", "doc_id", "hash"), "row").groupBy("component_id").agg(F.min_by("row", order).alias("stays"))
    gone = stage(judged.join(first, "component_id").where("row <> stays").select("row"), "pipeline-gone")
    return without_keys(rows, "row", gone).select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of byte strings of 200; the first copy stays.

    A cut inside a character drops that character's remaining bytes.
    """
    marked = docs.select(*COLUMNS, F.col("text").isNull().alias("text_is_null"))
    cut = without_repeats(marked, as_text=True).withColumn("text", F.when(~F.col("text_is_null"), F.col("kept")))
    length = F.char_length("text").cast("bigint")
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars"))).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a leaked benchmark item, with or without an id."""
    named = docs.select(*COLUMNS, row_key().alias("row"))
    found = stage(leaks(named, table(spark, sf_dir, "benchmark"), doc_id="row").select(F.col("doc_id").alias("row")).distinct(), "pipeline-leaks")
    return without_keys(named, "row", found).select(*COLUMNS)


def row_key():
    """128 bits of id and text, never null; only rows equal in both share them, and their verdict."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")))))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of ids and of the decoded bytes."""
    return encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("repeats", repeats),
    ("decontaminate", decontaminate),
    ("byte_bpe", byte_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = staging_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
