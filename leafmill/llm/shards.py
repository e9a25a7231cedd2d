"""Sharding by histogram sort: equal bytes per shard, equal texts side by side.

Rows are ordered by a hash of the text, then by id. Each round counts exact bytes and
rows in the cells of every open interval, and an interval shrinks to the cell that
holds its splitter, until the cell is within the tolerance or holds one key. Counts are
summed in the tasks; a round sends a bounded number of cells to the driver. Then the
rows are exchanged once, in pieces finer than shards, so no task holds a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.session import stage

SHARDS = 16
PIECES = 64
CELLS = 256
FIRST_CELLS = 4096


@dataclass(frozen=True)
class Interval:
    """Keys from low to high: text hashes, or ids under one hash."""

    hash: int | None
    low: int
    high: int

    def step(self, cells: int) -> int:
        return -(-(self.high - self.low + 1) // cells)

    def inside(self) -> Column:
        key = F.col("k1").between(self.low, self.high) if self.hash is None else F.col("k2").between(self.low, self.high)
        return key if self.hash is None else key & (F.col("k1") == self.hash)

    def cell(self, cells: int) -> Column:
        key = "k1" if self.hash is None else "k2"
        return F.expr(f"({key} - ({self.low}L)) div {self.step(cells)}L")


def with_keys(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """docs with k1 (60 bits of the text's MD5), k2 (the id; -1 if null) and size added."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns(
        {
            "k1": F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("bigint"),
            "k2": F.coalesce(F.col(doc_id), F.lit(-1)).cast("bigint"),
            "size": F.octet_length(whole).cast("bigint") + 1,
        }
    )


def splitters(keys: DataFrame, shards: int, pieces: int, tolerance: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Last keys before each shard, and before each piece, by exact counts of (k1, k2, size)."""
    total = keys.agg(F.sum("size"), F.count("*"), F.min("k1"), F.max("k1")).first()
    if not total[1]:
        return [], []
    whole = Interval(None, total[2], total[3])
    # A target: (0, bytes) or (1, rows) that must lie before the splitter.
    goals = {(0, -(-s * total[0] // shards)) for s in range(1, shards)} | {(1, -(-p * total[1] // pieces)) for p in range(1, pieces)}
    open_goals = {goal: (whole, 0) for goal in goals}
    found: dict[tuple[int, int], tuple[int, int]] = {}
    first = True
    while open_goals:
        intervals = sorted({i for i, _ in open_goals.values()}, key=lambda i: (i.hash is not None, i.hash or 0, i.low))
        cells = FIRST_CELLS if first else CELLS
        first = False
        place = F.lit(None).cast("struct<interval:int,cell:bigint>")
        for number, interval in enumerate(intervals):
            value = F.struct(F.lit(number).alias("interval"), interval.cell(cells).alias("cell"))
            place = F.when(interval.inside(), value).otherwise(place)
        key = F.struct("k1", "k2")
        counted = (
            keys.select("size", "k1", "k2", place.alias("p")).where("p IS NOT NULL")
            .groupBy("p")
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))
            .collect()
        )
        of: dict[int, list] = {}
        for row in sorted(counted, key=lambda r: (r.p.interval, r.p.cell)):
            of.setdefault(row.p.interval, []).append(row)
        for goal, (interval, before) in list(open_goals.items()):
            for row in of[intervals.index(interval)]:
                amount = row.rows if goal[0] else row.bytes
                if before < goal[1] <= before + amount:
                    low, high = tuple(row.low), tuple(row.high)
                    if low == high or amount <= tolerance:
                        found[goal] = high
                        del open_goals[goal]
                    elif low[0] == high[0]:
                        open_goals[goal] = (Interval(low[0], low[1], high[1]), before)
                    else:
                        open_goals[goal] = (Interval(None, low[0], high[0]), before)
                    break
                before += amount
    by_bytes = [found[0, -(-s * total[0] // shards)] for s in range(1, shards)]
    return by_bytes, sorted(set(found.values()))


def above(splitter: tuple[int, int]) -> Column:
    return ((F.col("k1") > splitter[0]) | ((F.col("k1") == splitter[0]) & (F.col("k2") > splitter[1]))).cast("int")


def sharded(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    pieces: int = PIECES,
    tolerance: int = 0,
) -> DataFrame:
    """docs with ``size``, ``shard``, ``slot`` added; clashing columns of docs are replaced.

    A row's size is its text's UTF-8 bytes (none for null) plus 1; its shard is
    floor(shards * bytes before it / all bytes), up to the tolerance in bytes. Slots
    number a shard's rows from 0 without gaps. Rows with equal text and id share a shard.
    Runs when called: stages the keys and counts over them.
    """
    added = ("size", "shard", "slot", "k1", "k2", "piece", "start")
    base = docs.select(*(c for c in docs.columns if c not in added or c in (doc_id, text)))
    keyed = with_keys(base, doc_id, text)
    keys = stage(keyed.select("k1", "k2", "size"), "shard-keys")
    by_bytes, cuts = splitters(keys, shards, pieces, tolerance)
    count = lambda marks: sum((above(m) for m in marks), F.lit(0))
    marked = {"shard": count(by_bytes), "piece": count(cuts)}
    held = keys.withColumns(marked).groupBy("piece", "shard").agg(F.count("*").alias("rows")).collect()
    starts, so_far = {}, {}
    for row in sorted(held, key=lambda r: r.piece):
        starts[row.piece] = so_far.get(row.shard, 0)
        so_far[row.shard] = starts[row.piece] + row.rows
    start = F.lit(0).cast("bigint")
    for piece, rows in starts.items():
        start = F.when(F.col("piece") == piece, F.lit(rows)).otherwise(start)
    order = Window.partitionBy("piece").orderBy("k1", "k2")
    slot = (F.row_number().over(order) - 1 + F.col("start")).cast("bigint")
    return (
        keyed.withColumns(marked).withColumn("start", start).withColumn("slot", slot)
        .drop("k1", "k2", "piece", "start")
    )
