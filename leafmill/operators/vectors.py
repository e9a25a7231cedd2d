"""Vectors of chunks and exact top-k by cosine similarity.

Text becomes a hashed term-frequency vector of unit length, so a dot product is the
cosine. A user's own vectors enter as (id, array<double>) rows.

Nearest chunks are found in one scan of the vectors (operators.topk). More queries
than one block holds are answered block by block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import TOKEN_CHARACTER, hashed_vector, let
from leafmill.operators.chunks import arrived_rows, rows_not_among
from leafmill.operators.topk import (
    DEFAULT_K,
    QUERY_BLOCK,
    SCORE_DECIMALS,
    RunningBest,
    hit_schema,
    ranked,
    rows_at_a_time,
    tree_ranked,
)
from leafmill.session import stage, staging_path

DIMS = 1024


def text_vectors(frame: DataFrame, key: str, text: str, dims: int = DIMS) -> DataFrame:
    """key, buckets array<int>, weights array<double>; sparse, of unit length."""
    made = frame.where(F.col(text).rlike(TOKEN_CHARACTER)).select(key, hashed_vector(F.col(text), dims).alias("v"))
    return made.select(key, "v.buckets", "v.weights")


def dense_vectors(frame: DataFrame, key: str, vector: str, keep: Sequence[str] = ()) -> DataFrame:
    """Given vectors in the same form, scaled to unit length. Zero vectors drop out.
    ``keep`` names further columns to carry along."""
    wide = F.transform(F.col(vector), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda acc, x: acc + x * x))
    scaled = let(norm, lambda n: F.transform(wide, lambda x: x / n))
    return (
        frame.where(F.exists(vector, lambda x: x != 0))
        .select(key, *keep, scaled.alias("weights"))
        .select(key, *keep, F.sequence(F.lit(0), F.size("weights") - 1).alias("buckets"), "weights")
    )


def mean_vectors(frame: DataFrame, group: str, vector: str, key: str = "query_id") -> DataFrame:
    """Unit-length mean vector per group, by partial sums per (group, position)."""
    parts = frame.select(group, F.posexplode(vector).alias("at", "x"))
    means = parts.groupBy(group, "at").agg(F.avg(F.col("x").cast("double")).alias("m"))
    listed = means.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("at", "m"))).alias("row"))
    whole = listed.select(F.col(group).alias(key), F.transform("row", lambda p: p["m"]).alias("mean"))
    return dense_vectors(whole, key, "mean")


def one_per_query(query_vectors: DataFrame) -> DataFrame:
    """query_id, buckets, weights with distinct ids: of rows that share one, the smallest."""
    one = query_vectors.groupBy("query_id").agg(F.min(F.struct("buckets", "weights")).alias("v"))
    return one.select("query_id", "v.buckets", "v.weights")


@dataclass(frozen=True)
class QueryVectors:
    """Query vectors in flat form, small enough to travel with the task."""

    ids: list
    rows: np.ndarray
    buckets: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(records: list) -> QueryVectors:
        counts = [len(r["buckets"]) for r in records]
        return QueryVectors(
            [r["query_id"] for r in records],
            np.repeat(np.arange(len(records)), counts),
            np.concatenate([np.asarray(r["buckets"], dtype=np.int64) for r in records]),
            np.concatenate([np.asarray(r["weights"], dtype=np.float64) for r in records]),
        )

    def matrix(self, dims: int) -> np.ndarray:
        full = np.zeros((dims, len(self.ids)))
        full[self.buckets, self.rows] = self.weights
        return full


def _scan(block: QueryVectors, dims: int, k: int, positive: bool, types: tuple):
    """Task side: scores of all queries by matrix product, a piece of rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = block.matrix(dims)
        best = RunningBest(block.ids, k, positive)
        size = min(rows_at_a_time(len(block.ids)), rows_at_a_time(dims))
        for batch in batches:
            ids = np.asarray(batch.column("chunk_id").to_pylist())
            offsets = batch.column("buckets").offsets.to_numpy()
            buckets = batch.column("buckets").values.to_numpy(zero_copy_only=False)
            weights = batch.column("weights").values.to_numpy(zero_copy_only=False)
            for start in range(0, len(ids), size):
                stop = min(start + size, len(ids))
                dense = np.zeros((stop - start, dims))
                lo, hi = offsets[start], offsets[stop]
                owner = np.repeat(np.arange(stop - start), np.diff(offsets[start : stop + 1]))
                dense[owner, buckets[lo:hi]] = weights[lo:hi]
                best.add(dense @ matrix, ids[start:stop])
        yield best.batch(types)

    return run


def _answer_block(records: list, vectors: DataFrame, queries: DataFrame, dims: int, k: int, positive: bool) -> DataFrame:
    ddl, types = hit_schema(queries, vectors)
    if not records:
        return vectors.sparkSession.createDataFrame([], ddl)
    run = _scan(QueryVectors.of(records), dims, k, positive, types)
    return vectors.select("chunk_id", "buckets", "weights").mapInArrow(run, ddl)


def vector_top_k(
    query_vectors: DataFrame,
    vectors: DataFrame,
    dims: int,
    k: int = DEFAULT_K,
    positive: bool = True,
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, chunk_id, score, rank of the k best vectors per query, exact.

    ``positive`` leaves out chunks without similarity. Of rows that share a query id one
    counts, the same for any number of queries. The query vectors are read here, at most one
    block at a time; with more than a block, each block's answer is staged before the
    next is read.
    """
    columns = one_per_query(query_vectors)
    records = columns.limit(block + 1).collect()
    if len(records) <= block:
        return tree_ranked(_answer_block(records, vectors, query_vectors, dims, k, positive), k)
    spark = vectors.sparkSession
    held = stage(columns, "query-vectors")
    groups = -(-held.count() // block)
    path = staging_path(spark, "vector-hits")
    schema = None
    for g in range(groups):
        # Ids are distinct, so hash groups are even: about a block each.
        part = held.where(F.pmod(F.xxhash64("query_id"), F.lit(groups)) == g).collect()
        for begin in range(0, len(part), block):
            hits = tree_ranked(_answer_block(part[begin : begin + block], vectors, query_vectors, dims, k, positive), k)
            schema = hits.schema
            hits.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def vector_top_k_within(
    query_vectors: DataFrame, vectors: DataFrame, on: str, k: int = DEFAULT_K
) -> DataFrame:
    """As vector_top_k, but a query meets only the vectors of its own group: an equi
    join on the group with one query row per group, ranked with a limit per task."""
    left = vectors.select(on, "chunk_id", F.col("weights").alias("a"))
    right = query_vectors.select(on, "query_id", F.col("weights").alias("b"))
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    scored = left.join(right, on).select("query_id", "chunk_id", F.round(dot, SCORE_DECIMALS).alias("score"))
    return ranked(scored, k)


def vector_changes(old: DataFrame, changes: DataFrame, new_chunks: DataFrame, dims: int = DIMS) -> DataFrame:
    """Vector table after a change feed; equals vectors of the new chunk table. The three
    tables are read several times and should be stored."""
    arrived = arrived_rows(new_chunks.select("chunk_id", "chunk_text"), changes)
    return rows_not_among(old, "chunk_id", changes).unionByName(text_vectors(arrived, "chunk_id", "chunk_text", dims))
