"""Keyword index over chunks and exact top-k by BM25.

The index keeps each chunk's counted terms in one row (chunk_id, chunk_len, terms).
Counting happens inside the row, so building the index shuffles nothing, and ranking
needs no shuffle to bring a chunk's terms together. Postings (term, chunk_id, tf,
chunk_len) are a view of it.

Ranking a block of questions reads the index twice: once for how many chunks hold
each question term, once for scores (operators.topk). Question sets beyond one block
are ranked by joins instead, also exact; see ``joined_top_k``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import term_counts, tokens
from leafmill.operators.chunks import arrived_rows, rows_not_among
from leafmill.operators.topk import (
    DEFAULT_K,
    QUERY_BLOCK,
    SCORE_DECIMALS,
    RunningBest,
    hit_schema,
    ranked,
    tree_ranked,
)
from leafmill.session import stage, staging_path

# Usual BM25 constants.
K1 = 1.2
B = 0.75

# Terms of all questions of a block together: bounds what travels to each task.
TERM_BLOCK = 500_000

# Scores, and weights before they are summed, that a task of the scan holds at a time.
ENTRIES_AT_A_TIME = 1_000_000

# The margin keeps every chunk that could tie after rounding.
MARGIN = 1e-5

# In the join form, a term counts as frequent when it occurs in more than this share
# of the chunks.
FREQUENT_SHARE = 0.05

# In the join form, (question, chunk) sums that a task holds at most.
PAIRS_PER_TASK = 1_000_000


@dataclass(frozen=True)
class KeywordIndex:
    """chunk_id, chunk_len (tokens), terms array<struct<value:string,n:int>>."""

    rows: DataFrame

    @property
    def postings(self) -> DataFrame:
        """term, chunk_id, tf, chunk_len.

        The outer form with a check behind it: for a plain explode Spark adds a
        filter on the array's size, and, pushed down to the text, that filter would
        count all terms a second time.
        """
        each = self.rows.select("chunk_id", "chunk_len", F.explode_outer("terms").alias("t")).where("t is not null")
        return each.select(F.col("t.value").alias("term"), "chunk_id", F.col("t.n").alias("tf"), "chunk_len")

    def write(self, path: str) -> None:
        self.rows.write.mode("overwrite").parquet(path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> KeywordIndex:
        return KeywordIndex(spark.read.parquet(path))


def build_index(chunks: DataFrame, text: str = "chunk_text", staged: bool = True) -> KeywordIndex:
    """Index of a chunk table. ``staged`` writes it once, since ranking reads it
    several times."""
    rows = chunks.select("chunk_id", term_counts(F.coalesce(F.col(text), F.lit(""))).alias("terms")).withColumn(
        "chunk_len", F.aggregate("terms", F.lit(0), lambda acc, t: acc + t["n"])
    )
    return KeywordIndex(stage(rows, "keyword-index") if staged else rows)


def refresh_index(index: KeywordIndex, changes: DataFrame, new_chunks: DataFrame) -> KeywordIndex:
    """Index after a change feed (operators.chunks.diff_chunks): rows of touched
    chunks go, rows of inserted and updated chunks come. Equals a full rebuild. What
    need not meet the feed stays in place, so the index, the feed and the chunks are
    read several times and should be stored."""
    kept = rows_not_among(index.rows, "chunk_id", changes)
    arrived = arrived_rows(new_chunks.select("chunk_id", "chunk_text"), changes)
    return KeywordIndex(kept.unionByName(build_index(arrived, staged=False).rows))


def query_terms(queries: DataFrame, text: str = "query_text") -> DataFrame:
    """Distinct terms of each query: query_id, term."""
    return queries.select("query_id", F.explode(F.array_distinct(tokens(F.col(text)))).alias("term"))


@dataclass(frozen=True)
class _Block:
    """Questions of one pass: terms, their rarity, and which questions use them."""

    ids: list
    terms: list[str]
    rarity: np.ndarray
    users: np.ndarray
    starts: np.ndarray
    mean_len: float

    @staticmethod
    def of(uses: list, holders: dict[str, int], chunks: int, mean_len: float) -> _Block:
        """From (query_id, term) rows sorted by term, and chunks per term. Terms that
        no chunk holds play no part."""
        ids = sorted({u["query_id"] for u in uses})
        place = {q: i for i, q in enumerate(ids)}
        used = [u for u in uses if u["term"] in holders]
        terms, starts = [], []
        for at, use in enumerate(used):
            if not terms or terms[-1] != use["term"]:
                terms.append(use["term"])
                starts.append(at)
        df = np.array([holders[t] for t in terms], dtype=np.float64)
        rarity = np.log(1 + (chunks - df + 0.5) / (df + 0.5))
        users = np.array([place[u["query_id"]] for u in used], dtype=np.int64)
        return _Block(ids, terms, rarity, users, np.array([*starts, len(used)], dtype=np.int64), mean_len)


def _scan(block: _Block, k: int, types: tuple):
    """Task side: weights of the questions' terms in each chunk, summed per question."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = RunningBest(block.ids, k, positive=True)
        wanted = pa.array(block.terms, pa.string())
        uses = np.diff(block.starts)
        width = len(block.ids)
        for batch in batches:
            ids = np.asarray(batch.column("chunk_id").to_pylist())
            lens = batch.column("chunk_len").to_numpy().astype(np.float64)
            offsets = batch.column("words").offsets.to_numpy()
            found = pc.index_in(batch.column("words").values, value_set=wanted)
            place = found.fill_null(-1).to_numpy(zero_copy_only=False)
            tf = batch.column("counts").values.to_numpy(zero_copy_only=False).astype(np.float64)
            # Scores and entries up to each row.
            entries = np.concatenate([[0], np.cumsum(np.where(place >= 0, uses[place], 0))])
            cost = entries[offsets] + width * np.arange(len(offsets))
            stop = 0
            while stop < len(ids):
                start = stop
                stop = max(start + 1, int(np.searchsorted(cost, cost[start] + ENTRIES_AT_A_TIME, side="right")) - 1)
                lo, hi = offsets[start], offsets[stop]
                owner = np.repeat(np.arange(stop - start), np.diff(offsets[start : stop + 1]))
                hit = np.flatnonzero(place[lo:hi] >= 0)
                if not len(hit):
                    continue
                term, row, n = place[lo:hi][hit], owner[hit], tf[lo:hi][hit]
                norm = K1 * (1 - B + B * lens[start:stop][row] / block.mean_len)
                weight = block.rarity[term] * n * (K1 + 1) / (n + norm)
                # One entry per question that uses the term.
                times = uses[term]
                first = np.cumsum(times) - times
                step = np.arange(times.sum()) - np.repeat(first, times)
                user = block.users[np.repeat(block.starts[term], times) + step]
                cell = np.repeat(row, times) * width + user
                scores = np.bincount(cell, np.repeat(weight, times), (stop - start) * width)
                best.add(scores.reshape(stop - start, width), ids[start:stop])
        yield best.batch(types)

    return run


def keyword_top_k(
    queries: DataFrame,
    index: KeywordIndex,
    k: int = DEFAULT_K,
    text: str = "query_text",
    block: int = QUERY_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """query_id, chunk_id, score, rank of the k best chunks per query by BM25.

    The questions' terms are read here, up to the block's bounds; a larger question
    set goes to ``joined_top_k``.
    """
    terms = query_terms(queries, text)
    uses = terms.limit(term_block + 1).collect()
    if len(uses) > term_block or len({u["query_id"] for u in uses}) > block:
        return joined_top_k(queries, index, k, text=text)
    ddl, types = hit_schema(queries, index.rows)
    wanted = F.broadcast(queries.sparkSession.createDataFrame([(t,) for t in {u["term"] for u in uses}], "term string"))
    # At most term_block rows, one per distinct term of the block.
    holders = {r["term"]: r["df"] for r in index.postings.join(wanted, "term").groupBy("term").agg(F.count("*").alias("df")).collect()}
    if not holders:
        return ranked(queries.sparkSession.createDataFrame([], ddl), k)
    total = index.rows.agg(F.count("*").alias("n"), F.avg("chunk_len").alias("mean")).first()
    made = _Block.of(sorted(uses, key=lambda u: (u["term"], u["query_id"])), holders, total["n"], total["mean"])
    rows = index.rows.select("chunk_id", "chunk_len", F.col("terms.value").alias("words"), F.col("terms.n").alias("counts"))
    return tree_ranked(rows.mapInArrow(_scan(made, k, types), ddl), k)


def joined_top_k(
    queries: DataFrame,
    index: KeywordIndex,
    k: int = DEFAULT_K,
    frequent_share: float = FREQUENT_SHARE,
    text: str = "query_text",
    block: int = QUERY_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """As ``keyword_top_k`` for question sets of any size, by joins on terms.

    The index is dealt by chunk once; a block of questions' terms then travels to the
    postings, so a (question, chunk) pair is summed in the task that has the chunk, and no
    pair is shuffled. A task has at most PAIRS_PER_TASK of them. The k-th best sum of a
    question's rarer terms alone is a mark that its k best chunks reach; pairs below it
    leave before the ranking. Exact for any ``frequent_share``. Question sets beyond a block
    are answered block by block, each staged.
    """
    spark = queries.sparkSession
    terms = stage(query_terms(queries, text).where(F.col("query_id").isNotNull()), "joined-terms")
    held = index.postings.select("term").join(terms.select("term").distinct(), "term", "left_semi")
    df = held.groupBy("term").agg(F.count("*").alias("df"))
    total = index.rows.agg(F.count("*").alias("n"), F.avg("chunk_len").alias("mean")).first()
    n = F.lit(float(total["n"]))
    rarity = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    frequent = F.col("df") > frequent_share * n
    asked = stage(terms.join(df, "term").select("query_id", "term", rarity.alias("rarity"), frequent.alias("frequent")), "joined-asked")
    sizes = asked.agg(F.count_distinct("query_id").alias("questions"), F.count("*").alias("uses")).first()
    groups = max(1, ceil(sizes["questions"] / block), ceil(sizes["uses"] / term_block))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, ceil(total["n"] * ceil(sizes["questions"] / groups) / PAIRS_PER_TASK))
    dealt = KeywordIndex(index.rows.select("chunk_id", "chunk_len", "terms").repartition(parts, "chunk_id"))
    if groups == 1:
        return _joined_block(asked, dealt, total["mean"], k)
    path = staging_path(spark, "joined-hits")
    for g in range(groups):
        hits = _joined_block(asked.where(F.pmod(F.xxhash64("query_id"), F.lit(groups)) == g), dealt, total["mean"], k)
        hits.write.mode("append").parquet(path)
    return spark.read.schema(hits.schema).parquet(path)


def _joined_block(asked: DataFrame, dealt: KeywordIndex, mean_len: float, k: int) -> DataFrame:
    """Ranked hits of a block of (query_id, term, rarity, frequent) rows in an index dealt by chunk."""
    norm = K1 * (1 - B + B * F.col("chunk_len") / F.lit(mean_len))
    held = dealt.postings.select("term", "chunk_id", (F.col("tf") * (K1 + 1) / (F.col("tf") + norm)).alias("w"))

    def summed(uses: DataFrame) -> DataFrame:
        """The sums of a chunk are in one task, so this needs no exchange."""
        pairs = held.join(F.broadcast(uses.select("query_id", "term", "rarity")), "term")
        return pairs.groupBy("query_id", "chunk_id").agg(F.sum(F.col("rarity") * F.col("w")).alias("s"))

    rare = summed(asked.where(~F.col("frequent"))).withColumnRenamed("s", "score")
    marks = ranked(rare, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("mark"))
    reached = F.col("mark").isNull() | (F.col("s") >= F.col("mark") - MARGIN)
    near = summed(asked).join(F.broadcast(marks), "query_id", "left").where(reached)
    return ranked(near.select("query_id", "chunk_id", F.round("s", SCORE_DECIMALS).alias("score")), k)
