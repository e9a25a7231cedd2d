"""Scores and runs, batch model calls, incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.operators.context import contexts
from leafmill.operators.evaluate import diff_runs, latest_run, score_run, summarise_runs
from leafmill.operators.hybrid import fuse, with_chunks
from leafmill.operators.keyword import keyword_top_k
from leafmill.operators.models import model_map
from leafmill.operators.pages import assemble_pages
from leafmill.plans.adapters import documents_as_files
from leafmill.plans.answers import semantic_top_k
from leafmill.session import stage, staging_path
from leafmill.sinks.tables import append_run, read_runs
from leafmill.sources.elements import line_elements
from leafmill.sources.files import spread
from leafmill.streaming.ingest import ingest, table_stream
from leafmill.streaming.refresh import current_corpus, full_corpus, refresh_corpus, refresh_from_stream
from leafmill.suite.common import CHUNKS_SQL, HYBRID_SQL, LINES_SQL, asked, files, register, table
from leafmill.suite.retrieval import search_index

RUN_TIMES = {"keyword": "2026-01-01", "semantic": "2026-01-02", "hybrid": "2026-01-03"}


def eval_questions(spark, sf_dir):
    """Benchmark passages as questions: the answer should hold the passage itself."""
    return table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("request"),
        F.when(F.length("text") > 200, "long").otherwise("short").alias("expected_kind"),
        F.array("text", F.lit("never in any text")).alias("expected_contains_any"),
    )


def eval_runs(spark, sf_dir):
    """Three runs, answered with the context of keyword, semantic and hybrid search."""
    questions = eval_questions(spark, sf_dir)
    queries = asked(spark, sf_dir)
    index = search_index(spark, sf_dir)
    lists = {
        "keyword": stage(keyword_top_k(queries, index.keyword, 50), "list"),
        "semantic": stage(semantic_top_k(queries, index, 50), "list"),
    }
    lists["hybrid"] = fuse(lists["keyword"], lists["semantic"])
    path = staging_path(spark, "eval-runs")
    for run, ranks in lists.items():
        found = with_chunks(ranks.where(F.col("rank") <= 6), index.chunks)
        request = F.concat(F.lit("item "), F.col("query_id").cast("string")).alias("request")
        responses = contexts(queries, found).select(request, F.col("context").alias("response"))
        append_run(score_run(questions, responses, run, F.lit(RUN_TIMES[run]).cast("timestamp")), path)
    return read_runs(spark, path)


EVAL_SQL = (
    HYBRID_SQL
    + """,
listed AS (
  SELECT 'keyword' AS run_id, 1 AS ord, query_id, chunk_id FROM kw WHERE pos <= 6
  UNION ALL SELECT 'semantic', 2, query_id, chunk_id FROM sem WHERE pos <= 6
  UNION ALL SELECT 'hybrid', 3, query_id, chunk_id FROM best),
runs AS (SELECT DISTINCT run_id, ord FROM listed),
scored AS (
  SELECT 'item ' || b.item_id AS request, r.run_id, r.ord,
    CASE WHEN length(b.text) > 200 THEN 'long' ELSE 'short' END AS expected_kind,
    CAST(coalesce(bool_or(contains(lower(c.body), lower(b.text))), false) AS DOUBLE) AS contains_score
  FROM benchmark b CROSS JOIN runs r
  LEFT JOIN listed l ON l.query_id = b.item_id AND l.run_id = r.run_id
  LEFT JOIN chunk_rows c ON c.chunk_id = l.chunk_id
  GROUP BY ALL)"""
)


@register(
    "eval_set_s6",
    """SELECT 'item ' || item_id AS request, CASE WHEN length(text) > 200 THEN 'long' ELSE 'short' END AS expected_kind,
    text || '|never in any text' AS expected FROM benchmark""",
)
def eval_set(spark, sf_dir):
    return eval_questions(spark, sf_dir).select(
        "request", "expected_kind", F.array_join("expected_contains_any", "|").alias("expected")
    )


@register(
    "eval_scores_e1_j3",
    f"WITH {EVAL_SQL} SELECT run_id, request, expected_kind, contains_score FROM scored",
)
def eval_scores(spark, sf_dir):
    return eval_runs(spark, sf_dir).select("run_id", "request", "expected_kind", "contains_score")


@register(
    "eval_summary_a4_e3",
    f"""WITH {EVAL_SQL} SELECT run_id, expected_kind, round(avg(contains_score), 9) AS contains_score_mean,
    count(*) AS n_eval_rows, CAST(0 AS BIGINT) AS n_errors FROM scored GROUP BY ALL""",
)
def eval_summary(spark, sf_dir):
    summary = summarise_runs(eval_runs(spark, sf_dir), "expected_kind")
    return summary.withColumn("contains_score_mean", F.round("contains_score_mean", 9))


@register(
    "latest_run_a7",
    f"WITH {EVAL_SQL} SELECT run_id, request, contains_score FROM scored WHERE ord = (SELECT max(ord) FROM runs)",
)
def newest_run(spark, sf_dir):
    return latest_run(eval_runs(spark, sf_dir)).select("run_id", "request", "contains_score")


@register(
    "run_diff_w2",
    f"""WITH {EVAL_SQL} SELECT request, run_id, contains_score AS score,
    lag(contains_score) OVER (PARTITION BY request ORDER BY ord) AS previous,
    contains_score - lag(contains_score) OVER (PARTITION BY request ORDER BY ord) AS delta FROM scored""",
)
def run_diff(spark, sf_dir):
    return diff_runs(eval_runs(spark, sf_dir)).drop("run_ts")


def word_count(texts):
    """A stand-in for a model: counts words, and fails on texts without any space."""
    counts = []
    for text in texts:
        if " " not in text:
            raise ValueError("too short")
        counts.append(text.count(" ") + 1)
    return counts


@register(
    "model_map_m1_e2",
    """SELECT doc_id, CASE WHEN contains(text, ' ') THEN CAST(length(text) - length(replace(text, ' ', '')) + 1 AS INTEGER) END AS n_words,
    CASE WHEN NOT contains(text, ' ') THEN 'ValueError: too short' END AS error FROM documents""",
)
def model_calls(spark, sf_dir):
    made = model_map(table(spark, sf_dir, "documents").select("doc_id", "text"), word_count, "text", "int")
    return made.select("doc_id", F.col("result.value").alias("n_words"), F.col("result.error").alias("error"))


DOCUMENT_ROWS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@register(
    "stream_ingest_n1",
    f"WITH {LINES_SQL} SELECT did AS doc_id, CAST(pos AS INTEGER) AS pos, line AS element_text FROM lines",
)
def stream_ingest(spark, sf_dir):
    """The documents table as a landing folder: streamed to element rows. A second
    run finds nothing new and adds nothing."""
    out, checkpoint = staging_path(spark, "elements"), staging_path(spark, "progress")
    for _ in range(2):
        stream = table_stream(spark, sf_dir, DOCUMENT_ROWS, "documents.parquet")
        ingest(stream, lambda rows: line_elements(documents_as_files(rows)).drop("bbox"), out, checkpoint)
    return spark.read.parquet(out).select("doc_id", "pos", "element_text")


REFRESHED_SQL = f"""WITH {CHUNKS_SQL} SELECT chunk_id, did AS doc_id, page AS page_number, idx AS chunk_index,
    sha256(body) AS text_hash FROM chunk_rows"""


@register("corpus_refresh_n2", REFRESHED_SQL)
def corpus_refresh(spark, sf_dir):
    """English documents first, the other languages after: equals one full run."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    arrivals = [documents.where(F.col("lang") == "en"), documents.where(F.col("lang") != "en")]
    first, second = [assemble_pages(line_elements(documents_as_files(part))) for part in arrivals]
    before = full_corpus(first)
    held = type(before)(*[stage(frame, "corpus") for frame in (before.pages, before.documents, before.chunks)])
    return refresh_corpus(held, stage(second, "pages")).chunks.select(
        "chunk_id", "doc_id", "page_number", "chunk_index", F.sha2("chunk_text", 256).alias("text_hash")
    )


@register("stream_refresh_n2", REFRESHED_SQL)
def stream_refresh(spark, sf_dir):
    """The documents table streamed into a versioned corpus."""
    root, checkpoint = staging_path(spark, "corpus"), staging_path(spark, "progress")
    stream = table_stream(spark, sf_dir, DOCUMENT_ROWS, "documents.parquet")
    refresh_from_stream(line_elements(documents_as_files(stream)), root, checkpoint)
    return current_corpus(spark, root).chunks.select(
        "chunk_id", "doc_id", "page_number", "chunk_index", F.sha2("chunk_text", 256).alias("text_hash")
    )
