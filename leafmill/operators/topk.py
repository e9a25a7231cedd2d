"""Top-k per query while a task reads its rows.

A block of queries of checked size goes to every task. The task keeps its k best
rows per query and hands out only those, so no (query, row) pair is shuffled and a
row that matches every query costs no more than the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_K = 6

# Scores are compared at six decimals, ties by id, so results do not depend on the
# order of additions.
SCORE_DECIMALS = 6

# Queries per pass: bounds what the driver holds and what each task receives.
QUERY_BLOCK = 2048

# Scores a task holds at a time.
SCORES_AT_A_TIME = 4_000_000

ARROW_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}


def ranked(scored: DataFrame, k: int) -> DataFrame:
    """Best k rows per query with ``rank``; equal scores are ordered by chunk id.

    Spark limits each group before and after the shuffle, so a query with very many
    scored chunks sends k rows per task.
    """
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("chunk_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# Tasks whose best rows of a query are merged at a time.
MERGE_TASKS = 256


def tree_ranked(scored: DataFrame, k: int, by: tuple[str, ...] = ("query_id",), tie: str = "chunk_id") -> DataFrame:
    """As ``ranked`` for rows that tasks hand out, merged in two levels.

    First the best k of every MERGE_TASKS tasks, then of these. So of one query no task
    reads more than MERGE_TASKS * k rows up to MERGE_TASKS**2 tasks.
    """
    order = [F.col("score").desc(), F.col(tie)]
    group = (F.spark_partition_id() / F.lit(MERGE_TASKS)).cast("int")
    first = Window.partitionBy(*by, "_tasks").orderBy(*order)
    near = scored.withColumn("_tasks", group).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    last = Window.partitionBy(*by).orderBy(*order)
    return near.drop("_tasks", "rank").withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)


def hit_schema(queries: DataFrame, rows: DataFrame) -> tuple[str, tuple[pa.DataType, pa.DataType]]:
    """Spark and Arrow types of (query_id, chunk_id, score)."""
    names = [queries.schema["query_id"].dataType.simpleString(), rows.schema["chunk_id"].dataType.simpleString()]
    for name in names:
        if name not in ARROW_TYPES:
            raise ValueError("ids must be string, bigint or int")
    ddl = f"query_id {names[0]}, chunk_id {names[1]}, score double"
    return ddl, (ARROW_TYPES[names[0]], ARROW_TYPES[names[1]])


def rows_at_a_time(queries: int) -> int:
    return max(1, SCORES_AT_A_TIME // max(1, queries))


class RunningBest:
    """The k best (score, id) of each query so far."""

    def __init__(self, query_ids: list, k: int, positive: bool):
        self.query_ids = query_ids
        self.k = k
        self.positive = positive
        self.floor = np.full(len(query_ids), -np.inf)
        self.best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(query_ids)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some rows (rows by queries) against all queries.

        With ``positive``, a row is a hit if its score is above zero before rounding.
        """
        if not len(ids):
            return
        hit = scores > 0 if self.positive else None
        scores = np.round(scores, SCORE_DECIMALS)
        if hit is not None:
            scores[~hit] = -np.inf
        # Only queries for which these rows hold something good enough.
        for q in np.flatnonzero(scores.max(axis=0) >= self.floor):
            column = scores[:, q]
            near = (column >= self.floor[q]) & (column > -np.inf)
            kept, names = column[near], ids[near]
            held = self.best[q]
            if held is not None:
                kept, names = np.concatenate([held[0], kept]), np.concatenate([held[1], names])
            if not len(kept):
                continue
            if len(kept) > self.k:
                kth = np.partition(kept, len(kept) - self.k)[len(kept) - self.k]
                near = kept >= kth
                kept, names = kept[near], names[near]
            order = np.lexsort((names, -kept))[: self.k]
            self.best[q] = (kept[order], names[order])
            if len(order) == self.k:
                self.floor[q] = kept[order[-1]]

    def batch(self, types: tuple[pa.DataType, pa.DataType]) -> pa.RecordBatch:
        ids, names, scores = [], [], []
        for q, held in enumerate(self.best):
            if held is not None:
                scores += held[0].tolist()
                names += held[1].tolist()
                ids += [self.query_ids[q]] * len(held[0])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, types[0]), pa.array(names, types[1]), pa.array(scores, pa.float64())],
            names=["query_id", "chunk_id", "score"],
        )
