"""Many questions at once: hybrid retrieval, context and citations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators.hybrid import LIST_DEPTH, fuse, with_chunks
from leafmill.operators.keyword import KeywordIndex, build_index, keyword_top_k
from leafmill.operators.topk import DEFAULT_K
from leafmill.operators.vectors import DIMS, text_vectors, vector_top_k
from leafmill.session import stage


@dataclass(frozen=True)
class SearchIndex:
    """What search reads: the chunks, their keyword index and their vectors."""

    chunks: DataFrame
    keyword: KeywordIndex
    vectors: DataFrame


def build_search_index(chunks: DataFrame, dims: int = DIMS) -> SearchIndex:
    """Stage the chunks once; index and vectors are derived from the staged table."""
    held = stage(chunks, "chunks")
    return SearchIndex(held, build_index(held), text_vectors(held, "chunk_id", "chunk_text", dims))


def semantic_top_k(queries: DataFrame, index: SearchIndex, k: int = DEFAULT_K, dims: int = DIMS) -> DataFrame:
    asked = text_vectors(queries, "query_id", "query_text", dims)
    return vector_top_k(asked, index.vectors, dims, k)


def hybrid_top_k(queries: DataFrame, index: SearchIndex, k: int = DEFAULT_K, depth: int = LIST_DEPTH) -> DataFrame:
    """query_id, chunk_id, score, rank by fused keyword and vector ranks. Each list is
    read to ``depth``, and never less than k deep."""
    depth = max(depth, k)
    return fuse(keyword_top_k(queries, index.keyword, depth), semantic_top_k(queries, index, depth), k=k)


def answer_hits(queries: DataFrame, index: SearchIndex, k: int = DEFAULT_K, depth: int = LIST_DEPTH) -> DataFrame:
    """Best chunks per question with their text and provenance."""
    return with_chunks(hybrid_top_k(queries, index, k, depth), index.chunks)


def questions(table: DataFrame, key: str, text: str) -> DataFrame:
    return table.select(F.col(key).cast("bigint").alias("query_id"), F.col(text).alias("query_text"))
