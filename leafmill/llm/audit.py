"""Interaction of filters, audited over sorted posting lists.

For every part of a table and every filter there is the list of the ids that fail it.
The lists are kept per range of ids, sorted, so each is bounded and no part's whole list
ever lies in one task. What a filter removes after some others is the size of its list
less the union of theirs: a k-way merge within the range that gallops over the ids
between two heads. Sizes add up over the ranges, and any order of the filters is read
off the sums for (filters before, filter).
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.session import stage

# Rows of a range of ids: the longest list that a merge holds.
RANGE = 1 << 14


def gallop(ids: list[int], at: int, target: int) -> int:
    """The first place from ``at`` on whose id is ``target`` or more, by steps that double."""
    end, step = at, 1
    while end < len(ids) and ids[end] < target:
        at, end, step = end + 1, end + step, step * 2
    return bisect_left(ids, target, at, min(end, len(ids)))


def left(base: list[int], others: list[list[int]]) -> int:
    """How many ids of ``base`` are in none of the ``others``; all lists ascend without repeats."""
    heads = [0] * len(others)
    at = count = 0
    while at < len(base):
        target, barrier = base[at], None
        for k, ids in enumerate(others):
            heads[k] = place = gallop(ids, heads[k], target)
            if place < len(ids) and (barrier is None or ids[place] < barrier):
                barrier = ids[place]
        if barrier == target:
            at += 1
            continue
        # No other list has an id before the barrier: the whole run is left.
        end = len(base) if barrier is None else gallop(base, at, barrier)
        count, at = count + end - at, end
    return count


def postings(rows: DataFrame, part: str, filters: dict[str, Column], marks: dict[str, Column]) -> DataFrame:
    """(part, range, failing, marked): sorted lists of row numbers, staged.

    One row per part and range of rows: ``failing`` has a list per filter, ``marked`` a list
    per mark, both in the order given; ``rows`` is how many rows of the part the range has.
    A condition that is null counts as not failed, or not marked. Rows are numbered where
    they lie, so lists are made without an exchange; ranges follow the numbers.
    """
    flags = [F.coalesce(c, F.lit(False)) for c in (*filters.values(), *marks.values())]
    # Written first: the numbers must not change when a task is repeated.
    listed = stage(
        rows.select(F.col(part).alias("part"), F.monotonically_increasing_id().alias("row"), F.array(*flags).alias("flags")),
        "audit-rows",
    )
    schema = f"part {listed.schema['part'].dataType.simpleString()}, range bigint, rows bigint, failing array<array<bigint>>, marked array<array<bigint>>"
    n_filters, n_marks = len(filters), len(marks)

    def gather(batches):
        for batch in batches:
            groups: dict = {}
            for p, row, flags_of in zip(*(batch.column(i).to_pylist() for i in range(3))):
                key = (p, row // RANGE)
                if key not in groups:
                    groups[key] = [0, [[] for _ in range(n_filters + n_marks)]]
                group = groups[key]
                group[0] += 1
                for ids, flag in zip(group[1], flags_of):
                    if flag:
                        ids.append(row)
            # Numbers ascend within a file; a range cut in two makes two shorter ranges.
            lists = [[sorted(ids) for ids in group[1]] for group in groups.values()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in groups], batch.column(0).type),
                    pa.array([r for _, r in groups], pa.int64()),
                    pa.array([group[0] for group in groups.values()], pa.int64()),
                    pa.array([x[:n_filters] for x in lists], pa.list_(pa.list_(pa.int64()))),
                    pa.array([x[n_filters:] for x in lists], pa.list_(pa.list_(pa.int64()))),
                ],
                names=["part", "range", "rows", "failing", "marked"],
            )

    return stage(listed.mapInArrow(gather, schema), "audit-postings")


def marginals(lists: DataFrame, n_filters: int, marks: tuple[str, ...]) -> DataFrame:
    """(part, before, filter, removed, lost_<mark> ...): ``before`` has a bit for each filter already applied.

    How many rows the filter then removes, and how many of them have each mark. Cells in
    which the filter removes nothing are left out.
    """
    names = ["removed", *(f"lost_{m}" for m in marks)]

    def merge(batches):
        for batch in batches:
            at, cells = [], []
            for i, (failing, marked) in enumerate(zip(batch.column("failing").to_pylist(), batch.column("marked").to_pylist())):
                known = [set(ids) for ids in marked]
                bases = [[ids, *([i for i in ids if i in mark] for mark in known)] for ids in failing]
                for before in range(1 << n_filters):
                    others = [failing[k] for k in range(n_filters) if before >> k & 1]
                    for f in range(n_filters):
                        if not before >> f & 1 and (removed := left(bases[f][0], others)):
                            at.append(i)
                            cells.append((before, f, removed, *(left(base, others) for base in bases[f][1:])))
            columns = list(zip(*cells)) if cells else [()] * (2 + len(names))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("part").take(pa.array(at, pa.int64())),
                    *(pa.array(c, pa.int32()) for c in columns[:2]),
                    *(pa.array(c, pa.int64()) for c in columns[2:]),
                ],
                names=["part", "before", "filter", *names],
            )

    kind = lists.schema["part"].dataType.simpleString()
    schema = f"part {kind}, before int, filter int, " + ", ".join(f"{n} bigint" for n in names)
    cells = lists.select("part", "failing", "marked").mapInArrow(merge, schema)
    return cells.groupBy("part", "before", "filter").agg(*(F.sum(n).alias(n) for n in names))


def interactions(rows: DataFrame, part: str, filters: dict[str, Column], marks: dict[str, Column]) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, lost_<mark> ..., shapley).

    A row per part, order of all filters (names joined) and step, zeros included. ``filters``
    says which rows fail, ``marks`` which rows are counted among the removed; both are
    columns over ``rows``, null meaning no. A null part is a part of its own; rows that are
    equal in all columns count one by one; no rows give no rows. Other columns of ``rows``
    are not read, whatever their names. The size of the result is parts times n! times n.

    removed counts the rows that fail the step's filter and none before; redundant those
    that fail it but are gone already; unique_fails those that fail no other filter; kept
    those left after the step; shapley sums the filter's removed over all orders. Stages tables.
    """
    spark, names, n = rows.sparkSession, list(filters), len(filters)
    lists = postings(rows, part, filters, marks)
    cells = stage(marginals(lists, n, tuple(marks)), "audit-cells")
    parts = lists.groupBy("part").agg(F.sum("rows").alias("rows"))
    zero = lambda name: F.coalesce(name, F.lit(0).cast("bigint"))

    # Orders in which exactly these filters come before this one, by their number.
    weight = F.element_at(F.array(*(F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n))), F.bit_count("before") + 1)
    alone = F.bit_count("before") == n - 1
    totals = cells.groupBy("part", "filter").agg(
        F.max(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.max(F.when(alone, F.col("removed"))).alias("alone"),
        F.sum(F.col("removed") * weight).alias("shapley"),
    )

    # Every part meets the same n! * n steps; their table is bounded by the filters.
    steps = [
        ("".join(names[f] for f in order), place + 1, order[place], sum(1 << f for f in order[:place]))
        for order in permutations(range(n))
        for place in range(n)
    ]
    listed = parts.select("part", "rows", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))).alias("turn"))
    turns = spark.createDataFrame([(t, *s) for t, s in enumerate(steps)], "turn int, filter_order string, step int, filter int, before int")
    listed = listed.join(F.broadcast(turns), "turn")
    same = F.col("l.part").eqNullSafe(F.col("r.part")) & (F.col("l.filter") == F.col("r.filter"))
    met = (
        listed.alias("l")
        .join(cells.alias("r"), same & (F.col("l.before") == F.col("r.before")), "left")
        .select("l.*", zero("removed").alias("removed"), *(zero(f"lost_{m}").alias(f"lost_{m}") for m in marks))
    )
    full = (
        met.alias("l")
        .join(totals.alias("r"), same, "left")
        .select("l.*", zero("fails").alias("fails"), zero("alone").alias("unique_fails"), zero("shapley").alias("shapley"))
    )
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    return full.select(
        "part",
        "filter_order",
        "step",
        (F.col("rows") - F.sum("removed").over(so_far)).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        *(f"lost_{m}" for m in marks),
        "shapley",
    )


def text_failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, A, B, C, D, E, ``keep`` ...): which of five text filters each row fails.

    A: under 50 words; B: distinct words below 65 % of all; C: capitals A-Z above 5 % of the
    code points; D: any of ``#$%&*|``; E: a smaller id has the same text. Words are runs
    without space and control characters 9 to 13. A null text reads as empty. A null id is
    smaller than none, and no id is smaller than it. ``keep`` names further columns to carry.
    Stages a narrow table of repeated texts.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    known = docs.select(
        F.col(doc_id).alias("doc_id"),
        *(F.col(f"`{k}`") for k in keep),
        body.alias("__body"),
        words.alias("__words"),
    ).select(
        "doc_id",
        *keep,
        F.size("__words").cast("bigint").alias("__n"),
        F.size(F.array_distinct("__words")).cast("bigint").alias("__distinct"),
        F.char_length(F.regexp_replace("__body", "[^A-Z]+", "")).cast("bigint").alias("__capitals"),
        F.char_length("__body").cast("bigint").alias("__points"),
        F.col("__body").rlike(r"[#$%&*|]").alias("D"),
        F.unhex(F.sha2("__body", 256)).alias("__hash"),
    )
    rows = stage(known, "audit-texts")
    # A text that repeats, and its smallest id; both sides are plain tables, so that the
    # join can split the rows of a very common text.
    first = stage(
        rows.groupBy("__hash").agg(F.min("doc_id").alias("__first"), F.max("doc_id").alias("__last")).where("__first < __last"),
        "audit-repeated",
    )
    return rows.join(first, "__hash", "left").select(
        "doc_id",
        *keep,
        (F.col("__n") < 50).alias("A"),
        (100 * F.col("__distinct") < 65 * F.col("__n")).alias("B"),
        (100 * F.col("__capitals") > 5 * F.col("__points")).alias("C"),
        "D",
        F.coalesce(F.col("__first") < F.col("doc_id"), F.lit(False)).alias("E"),
    ).drop("__hash")
