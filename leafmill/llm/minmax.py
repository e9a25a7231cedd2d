"""Near duplicates by min-max hashing.

A text's set: its distinct five-word shingles. Every permutation gives two signature
values, its minimum and its maximum over the set, so half the hash evaluations serve
a signature of the same length. Bands of a few values each, taken from different
permutations, propose pairs; whole sets confirm them.

Pairs are proposed without listing groups: in each bucket every member is held
against the one that meets most others. What this joins is contracted; in a bucket that still has
several components, members outside its largest component are held against all
others. Pairs inside one component need no test, so components are those of all
proposed pairs. A node is a distinct set (its 64-bit hash), so copies cost nothing.

With the production banding, a pair at similarity 0.75 shares no bucket with a
probability of about one in a million, one at 0.85 less than one in 10**13.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import (
    ascii_lower,
    letters,
    mixed,
    packed,
    powers,
    slices,
    space_table,
    span_hashes,
    text_bytes,
    tidy,
    told_apart,
    unpacked,
    word_spans,
)
from leafmill.session import stage

SHINGLE_WORDS = 5
PERCENT = 75
PERMUTATIONS = 128
BAND_VALUES = 5

# Rows whose texts are open at a time.
OPEN_ROWS = 256

# Words of the bitmaps that hold a set's differences from its bucket's leader.
BIT_WORDS = 8


def shingle_sets(column: pa.Array, width: int, kit: tuple) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words make one shingle, none make none."""
    lower, spaces = ascii_lower(), space_table()
    data, offsets = text_bytes(column)
    for first, last in slices(offsets):
        part = lower[data[offsets[first] : offsets[last]]]
        begins, ends, counts = word_spans(part, offsets[first : last + 1] - offsets[first], spaces)
        words = span_hashes(part, begins, ends, kit)
        with np.errstate(over="ignore"):
            runs = words.copy()
            for k in range(1, width):
                step = mixed(words + np.uint64(k * 0x632BE59BD9B4E019 & (1 << 64) - 1))
                runs[: max(0, len(runs) - k)] += step[k:]
            runs = mixed(runs)
        at = 0
        for n in counts.tolist():
            if n == 0:
                yield np.zeros(0, np.uint64)
            elif n < width:
                with np.errstate(over="ignore"):
                    place = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
                    yield mixed(np.array([mixed(words[at : at + n] ^ place).sum(dtype=np.uint64) + np.uint64(n)]))
            else:
                yield np.unique(runs[at : at + n - width + 1])
            at += n


def signature(values: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of the set under every permutation."""
    low = np.full(len(factors), (1 << 64) - 1, np.uint64)
    high = np.zeros(len(factors), np.uint64)
    with np.errstate(over="ignore"):
        for begin in range(0, len(values), 2048):
            image = values[begin : begin + 2048] * factors[:, None]
            image += shifts[:, None]
            np.minimum(low, image.min(axis=1), out=low)
            np.maximum(high, image.max(axis=1), out=high)
    return np.concatenate([low, high])


def sketches(docs: DataFrame, doc_id: str, text: str, width: int, permutations: int, band_values: int) -> DataFrame:
    """(doc_id, n_shingles, node, bands) per row."""
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_shingles bigint, node bigint, bands array<bigint>"
    bands = 2 * permutations // band_values

    def sketch(batches):
        import xxhash

        kit = (letters(), *powers())
        draws = mixed(np.arange(1, 2 * permutations + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))
        factors, shifts = draws[:permutations] | np.uint64(1), draws[permutations:]
        # Value j of a band is signature value band + j * bands: all of different permutations.
        picks = np.arange(bands)[:, None] + bands * np.arange(band_values)[None, :]
        salt = mixed(np.arange(bands, dtype=np.uint64))
        for batch in batches:
            counts, nodes, keys = [], [], []
            for values in shingle_sets(batch.column(1), width, kit):
                counts.append(len(values))
                nodes.append(xxhash.xxh3_64_intdigest(values.tobytes()))
                if len(values):
                    row, key = signature(values, factors, shifts)[picks], salt
                    with np.errstate(over="ignore"):
                        for j in range(band_values):
                            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + row[:, j])
                    keys.append(key)
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            sizes = np.where(np.array(counts, np.int64) > 0, bands, 0)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(np.array(nodes, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["doc_id", "n_shingles", "node", "bands"],
            )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(tidy(sketch), schema)


def with_sets(pairs: DataFrame, docs: DataFrame, sketch: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """Pairs (a, b) of nodes with their whole sets items_a and items_b, ascending as unsigned numbers."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = stage(
        sketch.select("doc_id", "node").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")),
        "minmax-chosen",
    )

    def sets(batches):
        import xxhash
        import zstandard

        kit = (letters(), *powers())
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for begin in range(0, batch.num_rows, OPEN_ROWS):
                part = batch.slice(begin, OPEN_ROWS)
                texts = pa.array([unpacked(pack.as_py(), opener) for pack in part.column(1)], pa.large_binary())
                # Rows that share an id may have other texts, which are not the node's.
                values = list(shingle_sets(texts, width, kit))
                hashes = np.array([xxhash.xxh3_64_intdigest(v.tobytes()) for v in values], np.uint64).view(np.int64)
                own = hashes == part.column(0).to_numpy()
                values = [v for v, mine in zip(values, own.tolist()) if mine]
                offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.uint64), *values]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[own]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["node", "items"]
                )

    # Only texts that may be asked for are exchanged, compressed.
    asked, _ = told_apart(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", chosen)
    # Stored in between, lest a task hold a Python worker that packs and another that makes sets:
    # those that packed would wait, with their memory, through the steps that follow.
    texts = stage(packed(asked, "text", "pack").join(chosen, "doc_id"), "minmax-texts")
    whole = texts.select("node", "pack").mapInArrow(tidy(sets), "node bigint, items array<bigint>")
    return pairs.join(whole.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b").join(
        whole.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a"
    )


def measured(pairs: DataFrame) -> DataFrame:
    """(a, b, shared, total) of pairs with sets: sizes of intersection and union."""
    both = pairs.withColumn("shared", F.size(F.array_intersect("items_a", "items_b")).cast("bigint"))
    return both.select("a", "b", "shared", (F.size("items_a") + F.size("items_b") - F.col("shared")).alias("total"))


def bit_words(values: np.ndarray) -> np.ndarray:
    """A bitmap of 64 * BIT_WORDS bits with the bit of every value."""
    flags = np.zeros(64 * BIT_WORDS, np.uint8)
    flags[(values & np.uint64(64 * BIT_WORDS - 1)).astype(np.int64)] = 1
    return np.packbits(flags).view(np.int64)


def compared(pairs: DataFrame) -> DataFrame:
    """``measured``, and bitmaps only_a and only_b of what one set has and the other lacks."""

    def compare(batches):
        for batch in batches:
            left, right = batch.column("items_a"), batch.column("items_b")
            values_a, values_b = (c.values.to_numpy(zero_copy_only=False).view(np.uint64) for c in (left, right))
            ends_a, ends_b = left.offsets.to_numpy(), right.offsets.to_numpy()
            n = batch.num_rows
            shared, total = np.empty(n, np.int64), np.empty(n, np.int64)
            bits = np.empty((2, n, BIT_WORDS), np.int64)
            for i in range(n):
                a, b = values_a[ends_a[i] : ends_a[i + 1]], values_b[ends_b[i] : ends_b[i + 1]]
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                in_b = b[at] == a
                in_a = np.zeros(len(b), bool)
                in_a[at[in_b]] = True
                shared[i] = int(in_b.sum())
                total[i] = len(a) + len(b) - shared[i]
                bits[0, i], bits[1, i] = bit_words(a[~in_b]), bit_words(b[~in_a])
            offsets = pa.array(np.arange(0, (n + 1) * BIT_WORDS, BIT_WORDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("a"),
                    batch.column("b"),
                    pa.array(shared),
                    pa.array(total),
                    *(pa.ListArray.from_arrays(offsets, pa.array(side.reshape(-1))) for side in bits),
                ],
                names=["a", "b", "shared", "total", "only_a", "only_b"],
            )

    schema = "a bigint, b bigint, shared bigint, total bigint, only_a array<bigint>, only_b array<bigint>"
    return pairs.select("a", "b", "items_a", "items_b").mapInArrow(tidy(compare), schema)


def bits_in(combine, x: str, y: str) -> Column:
    """How many bits combine(word of x, word of y) has set over all words."""
    return sum((F.bit_count(combine(F.get(x, F.lit(i)), F.get(y, F.lit(i)))) for i in range(BIT_WORDS)), F.lit(0))


def most_shared() -> Column:
    """No two sets of one bucket, compared with its leader, share more than this.

    Of the leader's shingles neither lacks any that they share. Of the others, each has
    at least one for every bit that the other does not have.
    """
    inside = F.least("shared", "shared2", F.col("size") - bits_in(lambda x, y: x.bitwiseOR(y), "lacks", "lacks2"))
    alone = bits_in(lambda x, y: x.bitwiseAND(F.bitwise_not(y)), "adds", "adds2")
    alone2 = bits_in(lambda x, y: y.bitwiseAND(F.bitwise_not(x)), "adds", "adds2")
    outside = F.least(F.col("n") - F.col("shared") - alone, F.col("n2") - F.col("shared2") - alone2)
    return inside + outside


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected edges (a, b): label is the smallest reachable.

    Large-star and small-star steps, each one aggregate and one join; every round is
    written to the shared folder.
    """
    spark = edges.sparkSession
    edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        edges = stage(
            small.select(F.col("e.m").alias("a"), F.col("e.v").alias("b")).where("a <> b").distinct(), "edges"
        )
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select("a").distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).union(
        roots.select(F.col("a").alias("node"), F.col("a").alias("label"))
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    permutations: int = PERMUTATIONS,
    band_values: int = BAND_VALUES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Texts without words (null, empty, white space only) have no shingles and are their
    own components. Rows without an id get no component_id and kept = true. Equal rows
    get equal results. Other columns are not read. Stages several tables.
    """
    sketch = stage(sketches(docs, doc_id, text, width, permutations, band_values), "minmax-sketch")
    usable = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    rows = usable.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    near = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)

    # Buckets that hold more than one set. Tables are written where a join must be able to
    # split a hot key, which it can't if an aggregate has dealt the rows by that key.
    shared = stage(
        rows.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("bucket"),
        "minmax-buckets",
    )
    members = stage(rows.join(shared, "bucket").distinct(), "minmax-members")
    # The member that meets most others leads: in a group of edited copies, their original.
    sizes = stage(members.groupBy("bucket").agg(F.count("*").alias("size")), "minmax-sizes")
    weights = members.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("weight"))
    lead = stage(
        members.join(weights, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node", "n")).alias("lead")), "minmax-leads"
    )
    first = stage(
        members.join(lead, "bucket")
        .where((F.col("node") != F.col("lead.node")) & near(F.col("n"), F.col("lead.n")))
        .select(F.least("lead.node", "node").alias("a"), F.greatest("lead.node", "node").alias("b"))
        .distinct(),
        "minmax-pairs",
    )
    linked = F.expr(f"100 * shared >= {percent} * total")
    tested = stage(compared(with_sets(first, docs, usable, doc_id, text, width)), "minmax-tested")
    edges = tested.where(linked).select("a", "b")
    labels = stage(components(edges), "minmax-labels")

    # Buckets that still hold several components.
    placed = (
        members.join(labels, "node", "left")
        .select("bucket", "node", "n", F.coalesce("label", "node").alias("label"))
    )
    per_label = placed.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    largest = (
        per_label.groupBy("bucket")
        .agg(F.max(F.struct("size", "label")).alias("main"), F.sum("size").alias("total"), F.count("*").alias("parts"))
        .where("parts > 1 AND total > 2")
        .select("bucket", F.col("main.label").alias("main"))
    )
    # Most pairs of edited copies that are not alike are ruled out by what each has and
    # lacks against the leader; the leader's own pairs are tested already.
    is_a = F.col("node") == F.col("a")
    open_rows = stage(
        placed.join(stage(largest, "minmax-mixed"), "bucket")
        .join(lead, "bucket")
        .where(F.col("node") != F.col("lead.node"))
        .withColumns({"a": F.least("lead.node", "node"), "b": F.greatest("lead.node", "node")})
        .join(tested, ["a", "b"], "left")
        .select(
            "bucket",
            "node",
            "n",
            "label",
            "main",
            F.col("lead.n").alias("size"),
            "shared",
            F.when(is_a, F.col("only_a")).otherwise(F.col("only_b")).alias("adds"),
            F.when(is_a, F.col("only_b")).otherwise(F.col("only_a")).alias("lacks"),
        ),
        "minmax-open",
    )
    other = open_rows.select("bucket", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "label", "shared", "adds", "lacks")))
    enough = (100 + percent) * most_shared() >= percent * (F.col("n") + F.col("n2"))
    second = stage(
        open_rows.where("label <> main")
        .join(other, "bucket")
        .where(
            (F.col("label") != F.col("label2"))
            # Where neither is in the largest component, once is enough.
            & ((F.col("label2") == F.col("main")) | (F.col("node") < F.col("node2")))
            & near(F.col("n"), F.col("n2"))
            & F.coalesce(enough, F.lit(True))
        )
        .select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti"),
        "minmax-pairs",
    )
    if not second.isEmpty():
        more = stage(measured(with_sets(second, docs, usable, doc_id, text, width)).where(linked).select("a", "b"), "minmax-links")
        if not more.isEmpty():
            # Contracted: components so far are single nodes now.
            labelled = labels.union(more.select("a", "a")).union(more.select("b", "b"))
            edges = labelled.select(F.col("label").alias("a"), F.col("node").alias("b")).union(more)
            labels = stage(components(edges), "minmax-labels")

    named = sketch.select("doc_id", "n_shingles", "node").join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("label", "node")).alias("label")
    )
    smallest = named.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    groups = stage(smallest.where("rows > 1").select("label", "least"), "minmax-groups")
    component = F.coalesce("least", "doc_id")
    return named.join(groups, "label", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
