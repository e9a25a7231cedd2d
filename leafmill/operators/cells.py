"""Vectors in cells, and exact nearest neighbours that skip cells.

A bounded number of vectors, drawn by a hash of their ids, are pivots. Every vector lies in
the cell of its nearest pivot, and a cell knows the largest angle between its pivot and a
member. No member is nearer to a question than the angle to the pivot less that angle, so a
cell whose best possible score is below the k-th score found is left out: by proof, not by
guess. Cells are folders, so what is left out is not read.

A block of questions is answered in two scans: of each question's nearest cell, which
gives the mark to beat, and of the cells that may hold something better.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators.topk import (
    DEFAULT_K,
    QUERY_BLOCK,
    RunningBest,
    hit_schema,
    ranked,
    rows_at_a_time,
    tree_ranked,
)
from leafmill.operators.vectors import QueryVectors, one_per_query
from leafmill.session import stage, staging_path

# Pivots, so cells at most: bounds what tasks receive and how many folders there are.
CELLS = 256

# Bounds and scores are doubles rounded at six decimals; ties must not be skipped.
MARGIN = 2e-6


@dataclass(frozen=True)
class CellIndex:
    """vectors: cell, chunk_id, buckets, weights. pivots: unit rows. reach: per cell the least
    cosine of a member with its pivot, above one for empty cells."""

    vectors: DataFrame
    pivots: np.ndarray
    reach: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(queries, cells): no member of the cell scores higher. queries: unit rows."""
        near = np.arccos(np.clip(queries @ self.pivots.T, -1, 1))
        angle = np.maximum(near - np.arccos(np.clip(self.reach, -1, 1)), 0)
        out = np.cos(angle)
        out[:, self.reach > 1] = -np.inf
        return out


def dense(offsets: np.ndarray, buckets: np.ndarray, weights: np.ndarray, dims: int) -> np.ndarray:
    """Rows of sparse vectors; offsets has one more entry than rows."""
    out = np.zeros((len(offsets) - 1, dims))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out[owner, buckets[offsets[0] : offsets[-1]]] = weights[offsets[0] : offsets[-1]]
    return out


def _pieces(batch: pa.RecordBatch, dims: int, size: int):
    """(first row, last row, dense rows) of a batch, ``size`` rows at a time."""
    offsets = batch.column("buckets").offsets.to_numpy()
    buckets, weights = (batch.column(n).values.to_numpy(zero_copy_only=False) for n in ("buckets", "weights"))
    for start in range(0, batch.num_rows, size):
        stop = min(start + size, batch.num_rows)
        yield start, stop, dense(offsets[start : stop + 1], buckets, weights, dims)


def build_cells(vectors: DataFrame, dims: int, cells: int = CELLS) -> CellIndex:
    """Cells of (chunk_id, buckets, weights) rows, unit vectors; staged below one folder per cell.

    Of equal vectors one at most is a pivot. The pivots are read here, ``cells`` at most. The
    vectors are staged once; pivots are drawn by hashes, so no vector is exchanged for that.
    """
    spark = vectors.sparkSession
    vectors = stage(vectors.select("chunk_id", "buckets", "weights"), "cell-vectors")
    hashed = vectors.select("buckets", "weights", F.xxhash64("buckets", "weights").alias("v"), F.xxhash64("chunk_id").alias("h"))
    least = hashed.groupBy("v").agg(F.min("h").alias("h")).orderBy("h").limit(cells)
    met = hashed.join(F.broadcast(least), ["v", "h"])
    drawn = met.groupBy("v", "h").agg(F.first(F.struct("buckets", "weights")).alias("p")).orderBy("h").select("p.*").collect()
    pivots = np.zeros((len(drawn), dims))
    for i, row in enumerate(drawn):
        pivots[i, row["buckets"]] = row["weights"]
    kind = vectors.schema["chunk_id"].dataType.simpleString()
    if not drawn:
        empty = spark.createDataFrame([], f"cell int, chunk_id {kind}, buckets array<int>, weights array<double>")
        return CellIndex(empty, pivots, np.zeros(0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = min(rows_at_a_time(len(pivots)), rows_at_a_time(dims))
        for batch in batches:
            for start, stop, rows in _pieces(batch, dims, size):
                cosines = rows @ pivots.T
                cell = cosines.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell.astype(np.int32)),
                        *(batch.column(n).slice(start, stop - start) for n in ("chunk_id", "buckets", "weights")),
                        pa.array(cosines[np.arange(len(cell)), cell]),
                    ],
                    names=["cell", "chunk_id", "buckets", "weights", "cosine"],
                )

    schema = f"cell int, chunk_id {kind}, buckets array<int>, weights array<double>, cosine double"
    placed = vectors.select("chunk_id", "buckets", "weights").mapInArrow(assign, schema)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A cell that holds many vectors spreads over tasks by their ids.
    spread = F.pmod(F.xxhash64("chunk_id"), F.lit(max(1, 4 * parts // len(pivots))))
    path = staging_path(spark, "cells")
    placed.repartition(parts, "cell", spread).sortWithinPartitions("cell").write.partitionBy("cell").parquet(path)
    held = spark.read.schema(schema).parquet(path)
    least = {r["cell"]: r["c"] for r in held.groupBy("cell").agg(F.min("cosine").alias("c")).collect()}
    # Rounding may have made the least cosine a little too high.
    reach = np.array([least.get(i, 3.0) - 1e-9 for i in range(len(pivots))])
    return CellIndex(held.drop("cosine"), pivots, reach)


def _scan(block: QueryVectors, dims: int, k: int, positive: bool, types: tuple, active: np.ndarray):
    """Task side: scores of the questions that a row's cell is active for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = block.matrix(dims)
        best = RunningBest(block.ids, k, positive)
        size = min(rows_at_a_time(len(block.ids)), rows_at_a_time(dims))
        for batch in batches:
            ids = np.asarray(batch.column("chunk_id").to_pylist())
            cells = batch.column("cell").to_numpy()
            for start, stop, rows in _pieces(batch, dims, size):
                part = cells[start:stop]
                for cell in np.unique(part).tolist():
                    asked = np.flatnonzero(active[:, cell])
                    if len(asked):
                        here = np.flatnonzero(part == cell)
                        scores = np.full((len(here), len(block.ids)), -np.inf)
                        scores[:, asked] = rows[here] @ matrix[:, asked]
                        best.add(scores, ids[start:stop][here])
        yield best.batch(types)

    return run


def cell_top_k(
    query_vectors: DataFrame, index: CellIndex, k: int = DEFAULT_K, positive: bool = True, block: int = QUERY_BLOCK
) -> DataFrame:
    """query_id, chunk_id, score, rank of the k best vectors per query, exact.

    The same rows as vectors.vector_top_k. Of rows that share a query id one counts. Question
    sets beyond a block are answered block by block, each staged.
    """
    spark, dims = query_vectors.sparkSession, index.pivots.shape[1]
    ddl, types = hit_schema(query_vectors, index.vectors)
    held = stage(one_per_query(query_vectors), "query-vectors")
    count = held.count()
    if not count or not len(index.pivots):
        return ranked(spark.createDataFrame([], ddl), k)
    groups = -(-count // block)
    path = staging_path(spark, "cell-hits")
    for g in range(groups):
        # Ids are distinct, so hash groups are even: about a block each.
        part = held.where(F.pmod(F.xxhash64("query_id"), F.lit(groups)) == g).collect()
        for begin in range(0, len(part), block):
            asked = QueryVectors.of(part[begin : begin + block])
            wanted = _wanted(asked, index, k, positive, ddl, types)
            hits = _hits(asked, index, wanted, k, positive, ddl, types)
            hits.write.mode("append").parquet(path)
    return spark.read.schema(f"{ddl}, rank int").parquet(path)


def _hits(asked: QueryVectors, index: CellIndex, active: np.ndarray, k: int, positive: bool, ddl: str, types: tuple) -> DataFrame:
    """Ranked hits in the active (question, cell) pairs; other cells are not read."""
    cells = np.flatnonzero(active.any(axis=0)).tolist()
    rows = index.vectors.where(F.col("cell").isin(cells)).select("cell", "chunk_id", "buckets", "weights")
    return tree_ranked(rows.mapInArrow(_scan(asked, index.pivots.shape[1], k, positive, types, active), ddl), k)


def _wanted(asked: QueryVectors, index: CellIndex, k: int, positive: bool, ddl: str, types: tuple) -> np.ndarray:
    """Which cells may hold one of a question's k best, given the k best of its best cell."""
    bounds = index.bounds(asked.matrix(index.pivots.shape[1]).T)
    first = np.zeros(bounds.shape, bool)
    first[np.arange(len(bounds)), bounds.argmax(axis=1)] = True
    found = _hits(asked, index, first, k, positive, ddl, types).where(F.col("rank") == k).select("query_id", "score").collect()
    place = {q: i for i, q in enumerate(asked.ids)}
    mark = np.full(len(bounds), 0.0 if positive else -np.inf)
    for row in found:
        mark[place[row["query_id"]]] = row["score"]
    return bounds + MARGIN >= mark[:, None]
