"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A mask takes some of a few consecutive words and ignores the rest. Test items and
documents are hashed under the same masks at every word; equal hashes name a document,
an item and the shift between their words. Around each such hit the item's words are
laid beside the document's: an item is leaked if some stretch of WINDOW words (of all
words, for shorter items) agrees in SHARE of its places, so single words may be
replaced. Every item has masks that no allowed replacement escapes: two for most
lengths, more or shorter ones for items of up to 12 words (documents are hashed under
these only if such items are there).

Test items are dealt into blocks of a bounded number of seeds. A block is broadcast, and
a hit takes the document's words around it along, so texts are never exchanged.

Words are runs of letters and digits, in lower case.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.session import stage

MASKS = ("111011", "1101011")
WINDOW = 13
SHARE = 0.8

# By the number of an item's words: masks for the lengths that MASKS alone do not serve.
# Found by trying all placements of the replaced words.
SHORT_MASKS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("111", "1101"),
    6: ("1111", "110011"),
    7: (*MASKS, "11111"),
    10: (*MASKS, "11100111"),
    11: (*MASKS, "11110011"),
    12: (*MASKS, "11111001"),
}

# Seeds of a broadcast block (about 40 bytes each); a larger test set has more blocks.
BLOCK_SEEDS = 500_000


def masks_of(size: int) -> tuple[str, ...]:
    """Masks for an item of ``size`` words."""
    return SHORT_MASKS.get(size, MASKS)


def words(text: Column) -> Column:
    """Hashes of the words of a text; null reads as empty."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(hashes: Column, mask: str) -> Column:
    """The masked hash at every word where the mask fits."""
    taken = [i for i, c in enumerate(mask) if c == "1"]
    last = F.size(hashes) - len(mask)
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.lit(mask), *(F.get(hashes, i + F.lit(t)) for t in taken))
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def seeded(frame: DataFrame, masks: tuple[str, ...], keep: tuple[str, ...]) -> DataFrame:
    """(``keep`` ..., seed, at): every seed of every row of (w, ...) under the masks."""
    listed = frame.select(*keep, F.size("w").alias("__n"), F.concat(*(seeds(F.col("w"), m) for m in masks)).alias("__seeds"))
    # Outer: for the plain form Spark infers a filter that would hash every text again at each word.
    spread = listed.select(*keep, "__n", F.posexplode_outer("__seeds").alias("__at", "seed"))
    # Places of a mask follow those of the masks before it.
    at, before = F.col("__at"), F.lit(0)
    for mask in masks:
        at = F.when(F.col("__at") >= before, F.col("__at") - before).otherwise(at)
        before = before + F.greatest(F.col("__n") - (len(mask) - 1), F.lit(0))
    return spread.select(*keep, "seed", at.alias("at"))


def blocks_of(items: DataFrame, most: int) -> tuple[DataFrame, int]:
    """(item, item_id, w, n, block) with at most ``most`` seeds a block (or one item), and how many blocks."""
    weight = F.col("n") * 3
    total = items.agg(F.sum(weight)).first()[0] or 0
    count = max(1, ceil(total / most))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(count)).cast("int"))
        sizes = dealt.groupBy("block").agg(F.sum(weight).alias("seeds"), F.count("*").alias("items"))
        if count == 1 or sizes.where((F.col("seeds") > 2 * most) & (F.col("items") > 1)).isEmpty():
            return dealt, count
        count *= 2


def leaks(
    docs: DataFrame,
    tests: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    test_text: str = "text",
    block_seeds: int = BLOCK_SEEDS,
) -> DataFrame:
    """(doc_id, item_id, matched_words, item_words, at_word): a row per document and leaked item.

    matched_words counts the agreeing words at the best shift, at_word where the item's
    first word falls in the document (below zero if its head is missing). Items of any
    number of words but none are searched for. Rows of docs without an id count as one document;
    items without an id are left out; of rows with equal ids, all texts count. Null texts
    read as empty, equal rows change nothing, and no row is given for clean documents or
    empty tables. Other columns are not read. Stages the items and the hits.
    """
    items = stage(
        tests.where(F.col(item_id).isNotNull())
        .select(F.col(item_id).alias("item_id"), words(F.col(test_text)).alias("w"))
        .where(F.size("w") > 0)
        .distinct()
        .select(F.monotonically_increasing_id().alias("item"), "item_id", "w", F.size("w").alias("n")),
        "leaks-items",
    )
    lengths = {r["n"] for r in items.select(F.least("n", F.lit(WINDOW)).alias("n")).distinct().collect()}
    masks = tuple(sorted({m for n in lengths for m in masks_of(n)})) or MASKS
    dealt, count = blocks_of(items, block_seeds)
    named = docs.select(F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("w"))
    found = None
    for block in range(count):
        mine = dealt.where(F.col("block") == block)
        known = None
        for mask in masks:
            served = [n for n in lengths if mask in masks_of(n)]
            part = seeded(mine.where(F.least("n", F.lit(WINDOW)).isin(served)), (mask,), ("item", "n"))
            known = part if known is None else known.unionByName(part)
        known = known.where("seed IS NOT NULL").select("item", "n", "seed", F.col("at").alias("item_at"))
        shift = F.col("at") - F.col("item_at")
        begin = F.greatest(shift, F.lit(0))
        hits = (
            seeded(named.withColumn("words", F.col("w")), masks, ("doc_id", "words"))
            .join(F.broadcast(known), "seed")
            .select(
                "doc_id",
                "item",
                shift.alias("shift"),
                F.slice("words", begin + 1, F.col("n") + F.least(shift, F.lit(0))).alias("part"),
            )
        )
        found = hits if found is None else found.unionByName(hits)
    # A shift is hit by many seeds; rows that share an id may have other words there.
    once = stage(found.groupBy("doc_id", "item", "shift", F.xxhash64("part").alias("h")).agg(F.first("part").alias("part")), "leaks-hits")
    skipped = F.greatest(-F.col("shift"), F.lit(0))
    zeros = lambda n: F.array_repeat(F.lit(0), n)
    agree = F.zip_with(F.slice("w", skipped + 1, F.size("part")), "part", lambda a, b: F.when(a == b, 1).otherwise(0))
    window = F.least(F.col("n"), F.lit(WINDOW))
    total = lambda values: F.aggregate(values, F.lit(0), lambda x, y: x + y)
    return (
        once.join(items, "item")
        .select("doc_id", "item_id", "n", "shift", F.concat(zeros(skipped), agree, zeros(F.col("n") - skipped - F.size("part"))).alias("same"))
        .select(
            "doc_id",
            "item_id",
            "n",
            "shift",
            total("same").alias("matched"),
            F.array_max(F.transform(F.sequence(F.lit(0), F.col("n") - window), lambda i: total(F.slice("same", i + 1, window)))).alias("best"),
        )
        .where(F.col("best") >= SHARE * window)
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("matched", -F.col("shift"), F.col("n"))).alias("top"))
        .select("doc_id", "item_id", F.col("top.matched").alias("matched_words"), F.col("top.n").alias("item_words"), (-F.col("top.col2")).alias("at_word"))
    )
