"""Sources, elements, pages, typed fields, the review gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions.typed import to_date, to_double, to_int, variant_first
from leafmill.operators.fields import gate, mentions, promote, split_gate, typed_fields
from leafmill.operators.pages import assemble_pages, line_pages
from leafmill.schemas import DOCUMENT, conform
from leafmill.sinks.tables import write_counted
from leafmill.session import stage, staging_path
from leafmill.sources.elements import html_elements, line_elements, parse_payload, variant_elements
from leafmill.suite.common import (
    CODE_PATTERN,
    FILES_SQL,
    GENERIC_RULES,
    LINES_SQL,
    PAGES_SQL,
    WEB_SQL,
    files,
    generic_gate,
    register,
    table,
    web_files,
)


@register(
    "table_scan_s3",
    "SELECT doc_id, source, n_chars FROM documents",
)
def table_scan(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")


@register(
    "document_identity_p1_p2_s4",
    f"WITH {FILES_SQL} SELECT did AS doc_id, path, kind AS source_kind, CAST(length(text) AS INTEGER) AS n FROM files",
)
def document_identity(spark, sf_dir):
    return files(spark, sf_dir).select("doc_id", "path", "source_kind", F.length("text").alias("n"))


@register(
    "line_elements_s7a_f1",
    f"""WITH {LINES_SQL} SELECT did AS doc_id, CAST(pos AS INTEGER) AS pos, CAST(pos // 20 + 1 AS INTEGER) AS page_number,
    'line' AS element_type, line AS element_text FROM lines""",
)
def lines(spark, sf_dir):
    return line_elements(files(spark, sf_dir)).select("doc_id", "pos", "page_number", "element_type", "element_text")


@register(
    "html_elements_s7b",
    f"WITH {WEB_SQL} SELECT sha256(url) AS doc_id, pos, kind AS element_type, body AS element_text FROM web_elements WHERE body <> ''",
)
def html(spark, sf_dir):
    return html_elements(web_files(spark, sf_dir)).select("doc_id", "pos", "element_type", "element_text")


def payloads(spark, sf_dir):
    """Documents as parser output: keys of both parser versions in turn, pages as
    number or text, and no element list for Spanish documents."""
    line = F.transform(
        F.split("text", "\n"),
        lambda t, i: F.struct(
            i.cast("string").alias("id"),
            F.lit("line").alias("type"),
            F.when(i % 2 == 0, t).alias("content"),
            F.when(i % 2 == 1, t).alias("text"),
            F.when(i % 2 == 0, F.floor(i / 20) + 1).alias("page_number"),
            F.when(i % 2 == 1, (F.floor(i / 20) + 1).cast("string")).alias("page"),
        ),
    )
    body = F.when(F.col("lang") != "es", F.to_json(F.struct(F.struct(line.alias("elements")).alias("document"))))
    return parse_payload(
        files(spark, sf_dir).withColumn("payload", F.coalesce(body, F.lit('{"document":{}}'))), "payload"
    )


@register(
    "variant_elements_s7c_p3_g1",
    f"""WITH {LINES_SQL} SELECT did AS doc_id, CAST(pos AS INTEGER) AS pos, CAST(pos AS VARCHAR) AS element_id,
    'line' AS element_type, line AS element_text, CAST(pos // 20 + 1 AS INTEGER) AS page_number
    FROM lines WHERE lang <> 'es'""",
)
def variants(spark, sf_dir):
    return variant_elements(payloads(spark, sf_dir)).select(
        "doc_id", "pos", "element_id", "element_type", "element_text", "page_number"
    )


@register(
    "event_props_p3",
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def event_props(spark, sf_dir):
    parsed = table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("p"))
    return parsed.select("event_id", variant_first(F.col("p"), ["$.key", "$.k"], "int").alias("k"))


PAGE_OUT = "did AS doc_id, page AS page_number, kind AS source_kind, sha256(body) AS content_hash, CAST(length(body) AS INTEGER) AS n"


@register("page_text_a1_a2", f"WITH {PAGES_SQL} SELECT {PAGE_OUT} FROM page_rows")
def page_text(spark, sf_dir):
    """Pages from element rows, as any parser's output would give them."""
    return assemble_pages(line_elements(files(spark, sf_dir))).select(
        "doc_id", "page_number", "source_kind", "content_hash", F.length("page_text").alias("n")
    )


@register("page_text_narrow_a1", f"WITH {PAGES_SQL} SELECT {PAGE_OUT} FROM page_rows")
def page_text_narrow(spark, sf_dir):
    """The same pages cut inside each document's row, without a shuffle."""
    return line_pages(files(spark, sf_dir)).select(
        "doc_id", "page_number", "source_kind", "content_hash", F.length("page_text").alias("n")
    )


# Fields per page by the generic rules.
FIELDS_SQL = (
    PAGES_SQL
    + r""",
found AS (
  SELECT *,
    nullif(regexp_extract(body, '(?i)licensed under (?:the )?([^\n]*[^\n.])', 1), '') AS license,
    TRY_CAST(regexp_extract(body, '(?i)\bversion (\d+(?:\.\d+)?)', 1) AS DOUBLE) AS version,
    nullif(regexp_extract(body, '\b(\d{16})\b', 1), '') AS account,
    nullif(regexp_extract(body, '\b(\d{1,3}(?:\.\d{1,3}){3})\b', 1), '') AS address,
    regexp_extract_all(body, '\b(\d{3}-\d{4})\b', 1) AS codes,
    TRY_CAST(regexp_extract(body, '\b\d{3}-(\d{4})\b', 1) AS INTEGER) AS extension,
    nullif(regexp_extract(body, '([\w.+-]+@[\w-]+\.[\w.]*\w)', 1), '') AS email
  FROM page_rows),
judged AS (
  SELECT *, kind = 'protection_study' AND license IS NULL AS undated,
         address IS NULL AND len(codes) = 0 AS unnamed
  FROM found)"""
)

FIELD_OUT = """did AS doc_id, page AS page_number, license, version, account, address, extension, email,
    list_sort(list_distinct(codes))::VARCHAR AS codes"""


def fields(spark, sf_dir):
    return typed_fields(line_pages(files(spark, sf_dir)), GENERIC_RULES)


def gated_fields(spark, sf_dir):
    """Field rows with their review reasons, written once. Each side of the gate reads
    the table; from the text, its filter would extract all fields a second time."""
    return stage(gate(fields(spark, sf_dir), generic_gate()), "fields")


def as_text(codes="codes"):
    """Codes in the notation the SQL side uses for lists."""
    return F.concat(F.lit("["), F.array_join(F.array_sort(F.col(codes)), ", "), F.lit("]"))


@register("typed_fields_x1_x2_x3", f"WITH {FIELDS_SQL} SELECT {FIELD_OUT} FROM found")
def typed_page_fields(spark, sf_dir):
    return fields(spark, sf_dir).select(
        "doc_id", "page_number", "license", "version", "account", "address", "extension", "email",
        as_text().alias("codes"),
    )


@register(
    "code_mentions_x4",
    rf"""WITH {PAGES_SQL} SELECT DISTINCT did AS doc_id, page AS page_number,
    unnest(regexp_extract_all(body, '{CODE_PATTERN}', 1)) AS code FROM page_rows""",
)
def code_mentions(spark, sf_dir):
    pages = line_pages(files(spark, sf_dir))
    return pages.select("doc_id", "page_number", F.explode(mentions(F.col("page_text"), CODE_PATTERN)).alias("code"))


@register(
    "tolerant_types_x2",
    """WITH texts AS (
      SELECT o_orderkey,
        CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%-d/%-m/%Y')
             WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'n/a' END AS day,
        CASE o_orderstatus WHEN 'F' THEN o_custkey || ' kV' WHEN 'O' THEN o_custkey || '.50' ELSE '' END AS size
      FROM orders)
    SELECT o_orderkey, day AS day_text,
      coalesce(TRY_CAST(day AS DATE), CAST(try_strptime(day, '%d/%m/%Y') AS DATE)) AS day_value,
      TRY_CAST(replace(size, ' kV', '') AS DOUBLE) AS size_value,
      TRY_CAST(split_part(day, '/', 1) AS INTEGER) AS first_part
    FROM texts""",
)
def tolerant_types(spark, sf_dir):
    status, when = F.col("o_orderstatus"), F.col("o_orderdate")
    day = F.when(status == "F", F.date_format(when, "d/M/yyyy")).when(status == "O", F.date_format(when, "yyyy-MM-dd"))
    size = F.when(status == "F", F.concat("o_custkey", F.lit(" kV"))).when(status == "O", F.concat("o_custkey", F.lit(".50")))
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.coalesce(day, F.lit("n/a")).alias("day_text"), F.coalesce(size, F.lit("")).alias("size_text")
    )
    return texts.select(
        "o_orderkey", "day_text",
        to_date(F.col("day_text")).alias("day_value"),
        to_double(F.col("size_text"), ["kV"]).alias("size_value"),
        to_int(F.split_part("day_text", F.lit("/"), F.lit(1))).alias("first_part"),
    )


@register(
    "review_gate_f3",
    f"""WITH {FIELDS_SQL} SELECT did AS doc_id, page AS page_number, concat_ws('; ',
      CASE WHEN undated THEN 'study without license' END, CASE WHEN unnamed THEN 'no code or address' END) AS reasons,
      CASE WHEN undated OR unnamed THEN 'review' ELSE 'curated' END AS side FROM judged""",
)
def review_gate(spark, sf_dir):
    accepted, held = split_gate(gated_fields(spark, sf_dir))
    kept = accepted.select("doc_id", "page_number", F.lit("").alias("reasons"), F.lit("curated").alias("side"))
    return kept.unionByName(
        held.select("doc_id", "page_number", F.array_join("review_reasons", "; ").alias("reasons"), F.lit("review").alias("side"))
    )


@register(
    "promote_reviewed_k6_j5",
    f"""WITH {FIELDS_SQL}
    SELECT did AS doc_id, page AS page_number, license,
      CASE WHEN NOT (undated OR unnamed) OR raw_id IN (SELECT doc_id FROM labels WHERE quality = 1)
           THEN 'curated' ELSE 'review' END AS side
    FROM judged""",
)
def promote_reviewed(spark, sf_dir):
    """Reviewers approve the documents that carry a good quality label."""
    accepted, held = split_gate(gated_fields(spark, sf_dir))
    good = table(spark, sf_dir, "labels").where(F.col("quality") == 1)
    named = table(spark, sf_dir, "documents").select("doc_id", "source").join(good, "doc_id", "left_semi")
    path = F.concat(F.lit("/corpus/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    curated, rest = promote(held, accepted, named.select(F.sha2(path, 256).alias("doc_id")), ["doc_id"])
    shown = ["doc_id", "page_number", "license"]
    return curated.select(*shown, F.lit("curated").alias("side")).unionByName(
        rest.select(*shown, F.lit("review").alias("side"))
    )


@register(
    "canonical_schema_p4_p5_p6",
    f"""WITH {PAGES_SQL} SELECT did AS doc_id, path AS source_path, kind AS source_kind, page AS page_number,
    sha256(body) AS content_hash, CAST(NULL AS VARCHAR) AS substation_name, CAST(NULL AS DOUBLE) AS voltage_class_kv,
    CAST(NULL AS DATE) AS study_date, CAST(NULL AS VARCHAR) AS approving_engineer FROM page_rows""",
)
def canonical_schema(spark, sf_dir):
    pages = line_pages(files(spark, sf_dir)).withColumnRenamed("path", "source_path")
    return conform(pages, DOCUMENT).drop("page_text", "equipment_ids", "region")


@register(
    "write_counts_k7",
    f"""WITH {LINES_SQL} SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(length(line)) AS BIGINT) AS n_chars,
    CAST(count(CASE WHEN kind = 'unknown' THEN 1 END) AS BIGINT) AS n_unknown FROM lines""",
)
def write_counts(spark, sf_dir):
    counts = write_counted(
        line_elements(files(spark, sf_dir)).drop("bbox"),
        staging_path(spark, "elements"),
        {"chars": F.sum(F.length("element_text")), "unknown": F.count_if(F.col("source_kind") == "unknown")},
    )
    row = [(counts["rows"], counts["chars"], counts["unknown"])]
    return spark.createDataFrame(row, "n bigint, n_chars bigint, n_unknown bigint")
