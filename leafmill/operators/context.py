"""From hits to what a model or a reader gets: context, messages, citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.columns import file_name, snippet
from leafmill.functions.text import counted
from leafmill.operators.hybrid import with_chunks
from leafmill.operators.order import with_positions
from leafmill.operators.topk import DEFAULT_K, ranked
from leafmill.session import stage

# The layout of a context block and the text for no hits.
BLOCK_SEPARATOR = "\n\n---\n\n"
NO_RESULTS = "(no relevant results)"
CITATION_TAG = r"\[doc:([^\]]+)\]"
CHAT_ROLES = ("user", "assistant")


def chat_messages(messages: DataFrame, role: str = "role") -> DataFrame:
    """Only user and assistant messages."""
    return messages.where(F.col(role).isin(*CHAT_ROLES))


def last_message(messages: DataFrame, role: str = "user", conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Last message of a role per conversation, '' where it has none. One partial
    aggregate, no sort."""
    latest = F.expr(f"max_by(text, {turn}) FILTER (WHERE role = '{role}')")
    return messages.groupBy(conversation).agg(F.coalesce(latest, F.lit("")).alias(f"last_{role}"))


def context_block(chunk_id: Column, path: Column, kind: Column, page: Column, text: Column) -> Column:
    return F.concat(
        F.lit("[doc:"), chunk_id,
        F.lit("]  source="), file_name(path, chunk_id),
        F.lit("  kind="), kind,
        F.lit("  page="), page.cast("string"),
        F.lit("\n"), text,
    )


def contexts(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """query_id, context: blocks in rank order; queries without hits say so.

    Hits are top-k rows, so a group holds at most k blocks.
    """
    block = context_block(
        F.col("chunk_id"), F.col("source_path"), F.col("source_kind"), F.col("page_number"), F.col("chunk_text")
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", block.alias("block"))))
    joined = hits.groupBy("query_id").agg(
        F.array_join(F.transform(ordered, lambda b: b["block"]), BLOCK_SEPARATOR).alias("context")
    )
    return (
        queries.select("query_id").join(joined, "query_id", "left")
        .select("query_id", F.coalesce(F.nullif("context", F.lit("")), F.lit(NO_RESULTS)).alias("context"))
    )


def message_rows(
    messages: DataFrame,
    context: DataFrame,
    rules: str,
    lead: str,
) -> DataFrame:
    """Model input as rows (conv_id, place, turn, role, content), ordered by (place,
    turn): the rules, the chat history, the retrieved context (conv_id, context).

    Rows rather than one array per conversation: no conversation has to fit a task.
    """
    ids = context.select("conv_id")
    first = ids.select(
        "conv_id", F.lit(0).alias("place"), F.lit(0).cast("bigint").alias("turn"),
        F.lit("system").alias("role"), F.lit(rules).alias("content"),
    )
    history = chat_messages(messages).select(
        "conv_id", F.lit(1).alias("place"), F.col("turn").cast("bigint").alias("turn"), "role",
        F.col("text").alias("content"),
    )
    last = context.select(
        "conv_id", F.lit(2).alias("place"), F.lit(0).cast("bigint").alias("turn"),
        F.lit("system").alias("role"), F.concat(F.lit(lead + "\n\n"), F.col("context")).alias("content"),
    )
    return first.unionByName(history).unionByName(last)


def message_lists(rows: DataFrame, per_part: int) -> DataFrame:
    """conv_id, part, messages array<struct<role,content>>, in order.

    A list holds ``per_part`` turns of the history, counted by position, between the
    rules and the context; longer histories continue in further lists, each with rules
    and context, so that each can be sent. No group grows beyond that and nothing is cut
    off. The history is staged when this is called.
    """
    names = ["conv_id", "place", "turn", "role", "content", "part"]
    history = with_positions(rows.where(F.col("place") == 1), ["conv_id"], ["turn", "role", "content"], "at")
    parts = history.withColumn("part", F.floor(F.col("at") / F.lit(per_part)).cast("int"))
    tails = parts.groupBy("conv_id").agg(F.max("part").alias("tail"))
    around = rows.where(F.col("place") != 1).join(tails, "conv_id", "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.coalesce("tail", F.lit(0))))
    )
    placed = parts.select(*names).unionByName(around.select(*names))
    ordered = F.array_sort(F.collect_list(F.struct("place", "turn", "role", "content")))
    return placed.groupBy("conv_id", "part").agg(
        F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages")
    )


def citations(hits: DataFrame) -> DataFrame:
    """query_id, citations: every retrieved chunk in rank order, with a snippet."""
    one = F.struct(
        "rank", "chunk_id", "doc_id", "source_path", "source_kind", "page_number",
        snippet(F.col("chunk_text")).alias("snippet"), "score",
    )
    ordered = F.array_sort(F.collect_list(one))
    return hits.groupBy("query_id").agg(F.transform(ordered, lambda c: c.dropFields("rank")).alias("citations"))


def cited(hits: DataFrame, answers: DataFrame) -> DataFrame:
    """Hits with ``cited``: whether the answer (query_id, answer) names the chunk. Of
    several answers to a query the smallest counts."""
    single = answers.groupBy("query_id").agg(F.min("answer").alias("answer"))
    tags = single.select("query_id", F.regexp_extract_all("answer", F.lit(CITATION_TAG), F.lit(1)).alias("_tags"))
    return hits.join(tags, "query_id", "left").withColumn(
        "cited", F.coalesce(F.array_contains("_tags", F.col("chunk_id")), F.lit(False))
    ).drop("_tags")


def asset_prompt(asset: Column, place: Column, template: str) -> Column:
    """The user's template with asset and place in its two places (%s)."""
    return F.format_string(template, asset, place)


def asset_hits(chunks: DataFrame, assets: DataFrame, codes: Column, k: int = DEFAULT_K, place: str | None = None) -> DataFrame:
    """Best k chunks per asset: those that mention its code most often, ties by id.

    ``codes`` gives all code mentions of a chunk. Mentions are counted inside the
    chunk's row and cut to k per code before the assets are joined, so a code named
    in a third of all chunks costs k rows per task. Codes repeat across places; with
    ``place`` (a column of both frames) the place is part of the key.
    """
    key = ["code"] if place is None else ["code", place]
    found = chunks.select("*", F.explode(counted(codes)).alias("m")).select(
        "*", F.col("m.value").alias("code"), F.col("m.n").cast("double").alias("score")
    ).drop("m")
    per_code = found.withColumn("query_id", F.to_json(F.struct(*key)) if place else F.col("code"))
    best = ranked(per_code.select("query_id", *key, "chunk_id", "score"), k)
    return assets.join(best, key).select("asset_id", *key, "chunk_id", "score", "rank")


def asset_contexts(chunks: DataFrame, assets: DataFrame, codes: Column, k: int = DEFAULT_K, place: str | None = None) -> DataFrame:
    """Every asset with ``context`` and ``citations`` of its best chunks (``asset_hits``).

    An asset that no chunk mentions stays; its context says so and its citations are
    NULL. The hits are staged when this is called.
    """
    best = asset_hits(chunks, assets, codes, k, place).withColumnRenamed("asset_id", "query_id")
    hits = stage(with_chunks(best, chunks), "asset-hits")
    queries = assets.select(F.col("asset_id").alias("query_id")).distinct()
    made = contexts(queries, hits).join(citations(hits), "query_id", "left")
    return assets.join(made.withColumnRenamed("query_id", "asset_id"), "asset_id", "left")
