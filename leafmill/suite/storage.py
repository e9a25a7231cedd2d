"""File scans and written tables, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leafmill.session import staging_path
from leafmill.sinks.tables import append_run, ensure_schemas, overwrite_table, read_runs, stamped
from leafmill.sources.files import decode_text, located_rejects, scan_files, split_decodable
from leafmill.suite.common import register, table

# Keeps a landed file small enough to be one row.
DOCUMENTS_PER_FILE = 2000


@register("file_scan_s1_s2_s5", "SELECT doc_id, text FROM documents")
def file_scan(spark, sf_dir):
    """Documents landed as files of JSON lines in the shared store, scanned as bytes, decoded."""
    path = staging_path(spark, "landed")
    lines = table(spark, sf_dir, "documents").select(F.to_json(F.struct("doc_id", "text")).alias("value"))
    lines.write.option("maxRecordsPerFile", DOCUMENTS_PER_FILE).text(path)
    readable, _ = split_decodable(decode_text(scan_files(spark, path, "*.txt")))
    line = readable.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return line.select(F.from_json("line", "doc_id bigint, text string").alias("r")).select("r.*")


@register(
    "undecodable_files_s2",
    "SELECT CAST(count(DISTINCT source) AS BIGINT) AS n_rejected FROM documents",
)
def undecodable_files(spark, sf_dir):
    """One file per source, in an encoding whose bytes are not UTF-8: all are rejected, none fails the job."""
    path = staging_path(spark, "landed-utf16")
    sources = table(spark, sf_dir, "documents").select("source", F.lit("ÿþ").alias("value")).distinct()
    sources.write.partitionBy("source").option("encoding", "UTF-16LE").option("lineSep", "\n").json(path)
    _, rejected = split_decodable(decode_text(scan_files(spark, path, "*.json")))
    return rejected.agg(F.count("*").alias("n_rejected"))


@register(
    "located_rejects_s2",
    """SELECT doc_id, lang <> 'de' AND lang <> 'fr' AS is_read,
      CASE lang WHEN 'de' THEN 0 WHEN 'fr' THEN octet_length(encode(coalesce(text, ''))) END::BIGINT AS bad_at,
      CASE lang WHEN 'de' THEN 'UTF-16LE' END AS encoding_mark,
      CASE WHEN lang <> 'de' AND lang <> 'fr' THEN sha256(coalesce(text, '')) END AS text_hash
    FROM documents""",
)
def rejects(spark, sf_dir):
    """Every document as a file: German ones in UTF-16, French ones with a byte at the end
    that is not UTF-8. The others are read, these are rejected, each with its reason."""
    docs = table(spark, sf_dir, "documents")
    body = F.coalesce("text", F.lit(""))
    content = (
        F.when(F.col("lang") == "de", F.concat(F.unhex(F.lit("FFFE")), F.encode(body, "UTF-16LE")))
        .when(F.col("lang") == "fr", F.concat(F.encode(body, "UTF-8"), F.unhex(F.lit("FF41"))))
        .otherwise(F.encode(body, "UTF-8"))
    )
    decoded = decode_text(docs.select("doc_id", content.alias("content")))
    good, _ = split_decodable(decoded)
    read = good.select("doc_id", F.lit(True).alias("is_read"), F.sha2("text", 256).alias("text_hash"))
    return read.unionByName(located_rejects(decoded).withColumn("is_read", F.lit(False)), allowMissingColumns=True)


@register(
    "written_table_k1_k2_k5_p7",
    "SELECT doc_id, lang, n_chars, true AS is_stamped, (SELECT count(*) FROM documents) AS n_written FROM documents",
)
def written_table(spark, sf_dir):
    """A table in a schema of its own, made from a query, then rewritten with other columns."""
    schema = f"curated_{uuid.uuid4().hex}"
    ensure_schemas(spark, [schema], staging_path(spark, "tables"))
    docs = table(spark, sf_dir, "documents")
    overwrite_table(docs.select("doc_id", "source"), f"{schema}.documents")
    written = overwrite_table(stamped(docs.select("doc_id", "lang", "n_chars"), "written_at"), f"{schema}.documents")
    return spark.table(f"{schema}.documents").select(
        "doc_id",
        "lang",
        "n_chars",
        F.col("written_at").isNotNull().alias("is_stamped"),
        F.lit(written).cast("bigint").alias("n_written"),
    )


@register(
    "appended_runs_k3",
    """SELECT CAST(item_id AS BIGINT) AS item_id, CAST(length(text) AS INTEGER) AS n, 'first' AS run_id, NULL::VARCHAR AS note
    FROM benchmark
    UNION ALL SELECT CAST(item_id AS BIGINT), CAST(length(text) + 1 AS INTEGER), 'second', 'n' || item_id FROM benchmark""",
)
def appended_runs(spark, sf_dir):
    """Two runs, the second with one more column; the first is written twice and stays single."""
    path = staging_path(spark, "runs")
    items = table(spark, sf_dir, "benchmark").select("item_id", F.length("text").alias("n"))
    first = items.withColumn("run_id", F.lit("first"))
    second = items.select(
        "item_id", (F.col("n") + 1).alias("n"), F.lit("second").alias("run_id"), F.concat(F.lit("n"), "item_id").alias("note")
    )
    for run in (first, second, first):
        append_run(run, path)
    return read_runs(spark, path).select("item_id", "n", "run_id", "note")
