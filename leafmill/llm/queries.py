"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import language
from leafmill.llm.archives import captures, page_rows, read_records, write_archives
from leafmill.llm.audit import interactions, text_failures
from leafmill.llm.bpe import encoded
from leafmill.llm.common import table
from leafmill.llm.counts import token_counts
from leafmill.llm.doubling import without_later_windows
from leafmill.llm.leaks import leaks
from leafmill.llm.minmax import near_duplicates
from leafmill.llm.phrases import neighbour_fingerprints
from leafmill.llm.quality import THRESHOLD, fitted, held_out, scored
from leafmill.llm.repeats import without_repeats
from leafmill.llm.shards import sharded
from leafmill.llm.whitening import whitened
from leafmill.session import stage, staging_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@register
def op3_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@register
def op9_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_first=False)
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@register
def op1_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))


@register
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


@register
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


@register
def op5_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return page_rows(captures(stage(read_records(spark, path), "warc-records")))


@register
def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The sum is taken before the exchange, so that texts stay out of it.
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    )
    return sharded(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encoded(docs, ranks, public_tokenizers.PATTERN, digests_only=True)


@register
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with all evidence, then documents, which have text only."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fitted(docs)
    pages = language.page_languages(table(spark, sf_dir, "pages"), model)
    none = F.lit(None)
    return pages.select(none.cast("bigint").alias("doc_id"), "*").unionByName(
        language.document_languages(docs, model).select(
            "doc_id",
            none.cast("bigint").alias("page_id"),
            "lang",
            "probability",
            F.col("lang").alias("text_lang"),
            none.cast("string").alias("declared"),
            none.cast("string").alias("host"),
        )
    )


@register
def op11_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


@register
def op12_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_later_windows(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op12_repeated_windows"] = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
starts AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM split WHERE len(words) >= 20
),
windows AS (
    SELECT doc_id, pos, md5(array_to_string(words[pos : pos + 19], ' ')) AS content FROM starts
),
first AS (
    SELECT content, min(struct_pack(d := doc_id, a := pos)) AS place FROM windows GROUP BY content
),
later AS (
    SELECT doc_id, pos FROM windows JOIN first USING (content) WHERE struct_pack(d := doc_id, a := pos) <> place
),
gone AS (
    SELECT doc_id, list(DISTINCT pos + step) AS places FROM later CROSS JOIN range(20) AS r(step) GROUP BY doc_id
),
flat AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split
),
listed AS (
    SELECT doc_id, unnest(places) AS pos FROM gone
),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS body, count(*) AS n
    FROM flat ANTI JOIN listed USING (doc_id, pos) GROUP BY doc_id
)
SELECT
    doc_id,
    CAST(len(words) AS BIGINT) AS n_words,
    CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(body, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""


@register
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an id in ``labels`` carry its marks: any label row of that id counts."""
    failures = text_failures(table(spark, sf_dir, "documents"), keep=("source",))
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    rows = failures.join(marks, "doc_id", "left").withColumn("part", F.coalesce("source", F.lit("")))
    return interactions(
        rows, "part", {name: F.col(name) for name in "ABCDE"}, {"good": F.col("good"), "toxic": F.col("toxic")}
    ).withColumnsRenamed({"lost_good": "good_lost", "lost_toxic": "toxic_lost"})


ORACLES["op13_filter_audit"] = r"""
WITH body AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
first AS (SELECT body, min(doc_id) AS least FROM body GROUP BY body),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
),
masks AS (
    SELECT part,
           CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN least < doc_id THEN 16 ELSE 0 END AS mask,
           coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
    FROM body JOIN first USING (body) LEFT JOIN marks USING (doc_id)
),
counted AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
),
steps AS (
    SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0)::INT AS before
    FROM orders CROSS JOIN range(1, 6) AS r(step)
),
sums AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM steps CROSS JOIN counted GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INT) AS step,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM sums
"""
