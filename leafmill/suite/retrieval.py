"""Indexes, ranking, context, messages, assets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leafmill.functions.columns import citation_title, display_path, display_score, file_name
from leafmill.operators.context import (
    asset_contexts,
    asset_hits,
    asset_prompt,
    chat_messages,
    citations,
    cited,
    contexts,
    last_message,
    message_lists,
    message_rows,
)
from leafmill.operators.hybrid import with_chunks
from leafmill.operators.keyword import build_index, joined_top_k, keyword_top_k
from leafmill.operators.vectors import (
    DIMS,
    dense_vectors,
    mean_vectors,
    text_vectors,
    vector_top_k,
    vector_top_k_within,
)
from leafmill.plans.answers import answer_hits, build_search_index, hybrid_top_k
from leafmill.session import stage, staging_path
from leafmill.sinks.tables import ensure_schemas, overwrite_table
from leafmill.suite.common import (
    CHUNKS_SQL,
    CODE_PATTERN,
    HYBRID_SQL,
    KEYWORD_SQL,
    SEMANTIC_SQL,
    TERMS_SQL,
    QUERY_TERMS_SQL,
    VECTORS_SQL,
    asked,
    chunks,
    files,
    register,
    table,
)

TOP_OUT = "query_id, chunk_id, score, CAST(pos AS INTEGER) AS rank"


@register(
    "keyword_postings_r1",
    f"WITH {TERMS_SQL} SELECT term, chunk_id, tf, len AS chunk_len FROM postings JOIN lens USING (chunk_id)",
)
def keyword_postings(spark, sf_dir):
    return build_index(chunks(spark, sf_dir), staged=False).postings


@register("keyword_top6_r2_t1", f"WITH {KEYWORD_SQL} SELECT {TOP_OUT} FROM kw WHERE pos <= 6")
def keyword_top6(spark, sf_dir):
    return keyword_top_k(asked(spark, sf_dir), build_index(chunks(spark, sf_dir)))


@register("keyword_top6_joined_r2", f"WITH {KEYWORD_SQL} SELECT {TOP_OUT} FROM kw WHERE pos <= 6")
def keyword_top6_joined(spark, sf_dir):
    """The join form, for question sets larger than a block."""
    return joined_top_k(asked(spark, sf_dir), build_index(chunks(spark, sf_dir)))


@register(
    "text_vectors_r3",
    f"WITH {TERMS_SQL}, {VECTORS_SQL} SELECT chunk_id, b AS bucket, round(w, 6) AS weight FROM vec",
)
def chunk_vectors(spark, sf_dir):
    vectors = text_vectors(chunks(spark, sf_dir), "chunk_id", "chunk_text")
    zipped = vectors.select("chunk_id", F.explode(F.arrays_zip("buckets", "weights")).alias("p"))
    return zipped.select("chunk_id", F.col("p.buckets").alias("bucket"), F.round("p.weights", 6).alias("weight"))


@register(
    "semantic_top6_r4",
    f"WITH {TERMS_SQL}, {QUERY_TERMS_SQL}, {SEMANTIC_SQL} SELECT {TOP_OUT} FROM sem WHERE pos <= 6",
)
def semantic_top6(spark, sf_dir):
    asked_vectors = text_vectors(asked(spark, sf_dir), "query_id", "query_text")
    return vector_top_k(asked_vectors, text_vectors(chunks(spark, sf_dir), "chunk_id", "chunk_text"), DIMS)


DENSE_SQL = """parts AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
means AS (SELECT label AS query_id, d, avg(x) AS m FROM parts GROUP BY ALL),
mean_norms AS (SELECT query_id, sqrt(sum(m * m)) AS norm FROM means GROUP BY 1),
norms AS (SELECT vec_id, sqrt(sum(x * x)) AS norm FROM parts GROUP BY 1),
dots AS (
  SELECT query_id, vec_id, label, sum(m * x) AS dot FROM means JOIN parts USING (d) GROUP BY ALL),
cosines AS (
  SELECT query_id, vec_id, label, round(dot / a.norm / b.norm, 6) AS score
  FROM dots JOIN mean_norms a USING (query_id) JOIN norms b USING (vec_id))"""


def label_means(spark, sf_dir):
    return mean_vectors(table(spark, sf_dir, "embeddings"), "label", "embedding")


@register(
    "dense_top6_r4",
    f"""WITH {DENSE_SQL} SELECT query_id, vec_id, score, CAST(pos AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS pos FROM cosines)
    WHERE pos <= 6""",
)
def dense_top6(spark, sf_dir):
    """The six vectors nearest to each label's mean, among all vectors."""
    given = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "chunk_id")
    hits = vector_top_k(label_means(spark, sf_dir), dense_vectors(given, "chunk_id", "embedding"), 64, positive=False)
    return hits.withColumnRenamed("chunk_id", "vec_id")


@register(
    "dense_top6_within_label_r4",
    f"""WITH {DENSE_SQL} SELECT query_id, vec_id, score, CAST(pos AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS pos FROM cosines
      WHERE label = query_id)
    WHERE pos <= 6""",
)
def dense_top6_within_label(spark, sf_dir):
    given = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "chunk_id")
    vectors = dense_vectors(given, "chunk_id", "embedding", ["label"])
    means = label_means(spark, sf_dir).withColumn("label", F.col("query_id"))
    return vector_top_k_within(means, vectors, "label").withColumnRenamed("chunk_id", "vec_id")


def search_index(spark, sf_dir):
    return build_search_index(chunks(spark, sf_dir))


@register("hybrid_top6_r5", f"WITH {HYBRID_SQL} SELECT {TOP_OUT} FROM best")
def hybrid_top6(spark, sf_dir):
    return hybrid_top_k(asked(spark, sf_dir), search_index(spark, sf_dir))


@register(
    "hits_r6_p10_t2",
    f"""WITH {HYBRID_SQL} SELECT query_id, CAST(pos AS INTEGER) AS rank, chunk_id, did AS doc_id, path AS source_path,
    kind AS source_kind, page AS page_number, body AS chunk_text, score FROM hits""",
)
def hits(spark, sf_dir):
    return answer_hits(asked(spark, sf_dir), search_index(spark, sf_dir))


CONTEXT_SQL = (
    HYBRID_SQL
    + """,
contexts AS (
  SELECT item_id AS query_id, coalesce(string_agg(
    '[doc:' || chunk_id || ']  source=' || split_part(path, '/', -1) || '  kind=' || kind || '  page=' || page
    || chr(10) || body, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY pos), '(no relevant results)') AS context
  FROM benchmark LEFT JOIN hits ON item_id = query_id GROUP BY item_id)"""
)


@register("contexts_c2", f"WITH {CONTEXT_SQL} SELECT query_id, context FROM contexts")
def question_contexts(spark, sf_dir):
    queries = asked(spark, sf_dir)
    return contexts(queries, answer_hits(queries, search_index(spark, sf_dir)))


def keyword_hits(spark, sf_dir):
    held = stage(chunks(spark, sf_dir), "chunks")
    return with_chunks(keyword_top_k(asked(spark, sf_dir), build_index(held)), held)


KEYWORD_HITS_SQL = (
    KEYWORD_SQL
    + """,
hits AS (
  SELECT k.query_id, k.pos, k.chunk_id, c.did, c.path, c.kind, c.page, c.body, k.score
  FROM kw k JOIN chunk_rows c USING (chunk_id) WHERE k.pos <= 6)"""
)


@register(
    "citations_c4_p11",
    f"""WITH {KEYWORD_HITS_SQL} SELECT query_id, CAST(count(*) AS INTEGER) AS n,
    string_agg(chunk_id || ' ' || did || ' ' || page || ' ' || left(body, 280), chr(10) ORDER BY pos) AS listed
    FROM hits GROUP BY query_id""",
)
def citation_lists(spark, sf_dir):
    """Citation arrays, written out as text so that they can be compared."""
    line = lambda c: F.concat_ws(" ", c["chunk_id"], c["doc_id"], c["page_number"].cast("string"), c["snippet"])
    made = citations(keyword_hits(spark, sf_dir))
    return made.select(
        "query_id", F.size("citations").alias("n"), F.array_join(F.transform("citations", line), "\n").alias("listed")
    )


@register(
    "cited_flags_c4",
    f"""WITH {KEYWORD_HITS_SQL} SELECT query_id, chunk_id, pos = 1 AS cited FROM hits""",
)
def cited_flags(spark, sf_dir):
    """An answer that names its best chunk: that one is cited, the others are not."""
    found = keyword_hits(spark, sf_dir)
    answer = F.concat(F.lit("See [doc:"), "chunk_id", F.lit("]."))
    answers = found.where(F.col("rank") == 1).select("query_id", answer.alias("answer"))
    return cited(found, answers).select("query_id", "chunk_id", "cited")


@register(
    "citation_display_p9_p12",
    f"""WITH {CHUNKS_SQL} SELECT chunk_id, split_part(path, '/', -1) AS file_name,
      split_part(path, '/', -1) || ' · p' || page AS title, 'dbfs' || path AS shown_path,
      printf('%.3f', CAST(idx + 1 AS DOUBLE) / 8) AS shown_score FROM chunk_rows""",
)
def citation_display(spark, sf_dir):
    path, page = F.col("source_path"), F.col("page_number")
    return chunks(spark, sf_dir).select(
        "chunk_id",
        file_name(path, F.col("chunk_id")).alias("file_name"),
        citation_title(path, F.col("chunk_id"), page).alias("title"),
        display_path(F.concat(F.lit("dbfs:dbfs"), path)).alias("shown_path"),
        display_score((F.col("chunk_index") + 1).cast("double") / 8).alias("shown_score"),
    )


@register("chat_messages_f5", "SELECT conv_id, turn, role FROM conversations WHERE role IN ('user', 'assistant')")
def chat(spark, sf_dir):
    return chat_messages(table(spark, sf_dir, "conversations")).select("conv_id", "turn", "role")


@register(
    "last_messages_a6",
    """SELECT conv_id, coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS last_user,
    coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '') AS last_assistant
    FROM conversations GROUP BY conv_id""",
)
def last_messages(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return last_message(turns, "user").join(last_message(turns, "assistant"), "conv_id")


MESSAGE_SQL = """asked AS (
  SELECT conv_id, coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS context
  FROM conversations GROUP BY conv_id),
msgs AS (
  SELECT conv_id, 0 AS place, CAST(0 AS BIGINT) AS turn, 'system' AS role, 'Rules.' AS content FROM asked
  UNION ALL SELECT conv_id, 1, turn, role, text FROM conversations WHERE role <> 'system'
  UNION ALL SELECT conv_id, 2, 0, 'system', 'Context:' || chr(10) || chr(10) || context FROM asked)"""


def model_input(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    context = last_message(turns, "user").withColumnRenamed("last_user", "context")
    return message_rows(turns, context, rules="Rules.", lead="Context:")


@register("message_rows_c3", f"WITH {MESSAGE_SQL} SELECT conv_id, place, turn, role, content FROM msgs")
def messages(spark, sf_dir):
    return model_input(spark, sf_dir)


def message_lists_sql(per_part: int) -> str:
    return f"""WITH {MESSAGE_SQL}, history AS (
      SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, content) - 1) // {per_part} AS part FROM msgs WHERE place = 1),
    tails AS (SELECT conv_id, max(part) AS tail FROM history GROUP BY 1),
    placed AS (
      SELECT * FROM history
      UNION ALL SELECT msgs.*, unnest(range(coalesce(tail, 0) + 1)) FROM msgs LEFT JOIN tails USING (conv_id) WHERE place <> 1)
    SELECT conv_id, CAST(part AS INTEGER) AS part,
      string_agg(role || ': ' || content, chr(10) ORDER BY place, turn, role, content) AS listed
    FROM placed GROUP BY conv_id, part"""


@register("message_lists_c3", message_lists_sql(4))
def message_parts(spark, sf_dir):
    """Message arrays of four turns each, written out as text."""
    return listed(spark, sf_dir, 4)


# More turns than the conversations here have, and no more than one list should hold.
LIST_TURNS = 1000


@register("message_lists_whole_c3", message_lists_sql(LIST_TURNS))
def whole_messages(spark, sf_dir):
    """One list per conversation, or one for every thousand turns of a longer one."""
    return listed(spark, sf_dir, LIST_TURNS)


def listed(spark, sf_dir, per_part):
    line = lambda m: F.concat(m["role"], F.lit(": "), m["content"])
    made = message_lists(model_input(spark, sf_dir), per_part)
    return made.select("conv_id", "part", F.array_join(F.transform("messages", line), "\n").alias("listed"))


ASSET_SQL = (
    CHUNKS_SQL
    + rf""",
    mentioned AS (
      SELECT chunk_id, code, count(*) AS n
      FROM (SELECT chunk_id, unnest(regexp_extract_all(body, '{CODE_PATTERN}', 1)) AS code FROM chunk_rows) GROUP BY ALL),
    assets AS (
      SELECT DISTINCT unnest(regexp_extract_all(text, '{CODE_PATTERN}', 1)) AS code FROM documents),
    placed AS (
      SELECT code, chunk_id, n, row_number() OVER (PARTITION BY code ORDER BY n DESC, chunk_id) AS pos FROM mentioned)"""
)


@register(
    "asset_context_j4_c5",
    f"""WITH {ASSET_SQL}
    SELECT 'asset ' || code AS asset_id, code, chunk_id, CAST(n AS DOUBLE) AS score, CAST(pos AS INTEGER) AS rank,
      'What is known about asset ' || code || ' at the plant?' AS prompt
    FROM assets JOIN placed USING (code) WHERE pos <= 6""",
)
def asset_context(spark, sf_dir):
    """For every code that occurs anywhere, the chunks that name it most often."""
    found = F.regexp_extract_all("text", F.lit(CODE_PATTERN), F.lit(1))
    codes = files(spark, sf_dir).select(F.explode(found).alias("code")).distinct()
    assets = codes.withColumn("asset_id", F.concat(F.lit("asset "), "code"))
    named = F.regexp_extract_all("chunk_text", F.lit(CODE_PATTERN), F.lit(1))
    best = asset_hits(chunks(spark, sf_dir), assets, named)
    prompt = asset_prompt(F.col("code"), F.lit("the plant"), "What is known about asset %s at %s?")
    return best.withColumn("prompt", prompt)


@register(
    "asset_table_j4",
    f"""WITH {ASSET_SQL},
    listed AS (SELECT 'asset ' || code AS asset_id, code FROM assets UNION ALL SELECT 'part ' || p_partkey, 'P' || p_partkey FROM part),
    best AS (SELECT p.code, p.pos, c.* FROM placed p JOIN chunk_rows c USING (chunk_id) WHERE pos <= 6)
    SELECT asset_id, code, count(chunk_id) AS n_citations, coalesce(string_agg(
      '[doc:' || chunk_id || ']  source=' || split_part(path, '/', -1) || '  kind=' || kind || '  page=' || page
      || chr(10) || body, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY pos), '(no relevant results)') AS context
    FROM listed LEFT JOIN best USING (code) GROUP BY asset_id, code""",
)
def asset_table(spark, sf_dir):
    """The written context table of all assets: codes of the documents, and parts that no document names."""
    found = F.regexp_extract_all("text", F.lit(CODE_PATTERN), F.lit(1))
    coded = files(spark, sf_dir).select(F.explode(found).alias("code")).distinct()
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("key"))
    assets = coded.select(F.concat(F.lit("asset "), "code").alias("asset_id"), "code").unionByName(
        parts.select(F.concat(F.lit("part "), "key").alias("asset_id"), F.concat(F.lit("P"), "key").alias("code"))
    )
    named = F.regexp_extract_all("chunk_text", F.lit(CODE_PATTERN), F.lit(1))
    schema = f"assets_{uuid.uuid4().hex}"
    ensure_schemas(spark, [schema], staging_path(spark, "tables"))
    overwrite_table(asset_contexts(chunks(spark, sf_dir), assets, named), f"{schema}.contexts")
    cited_chunks = F.coalesce(F.size("citations"), F.lit(0))
    return spark.table(f"{schema}.contexts").select(
        "asset_id", "code", F.greatest(cited_chunks, F.lit(0)).cast("bigint").alias("n_citations"), "context"
    )
