"""Repeated byte strings by suffix order and longest-previous-factor arrays.

A start is repeated if the ``length`` bytes from there also start elsewhere.

1. Every start belongs to an anchor: the leftmost smallest hash among the short grams
   of its string. Equal strings have equal anchors at equal distances. Starts that
   follow each other and share the anchor make a block, the bytes their strings cover.
   Equal blocks that follow each other, as in text of a short period, are one row, a run.
2. Anchors seen once are done. Equal blocks of seen anchors are repeated as a whole;
   each distinct block stays once, at its first place.
3. Distinct blocks of an anchor are compared by suffix order: a task joins blocks to one
   text in corpus order, sorts its suffixes by prefix doubling, and takes for each
   suffix the longest common prefix with the previous and next smaller positions
   (longest previous factor) and with the previous and next larger ones (longest next
   factor), up to ``length``. Factors of ``length`` bytes mark repeated starts.
4. An anchor with more distinct blocks than one sort should hold has its blocks cut again
   by longer grams, with steps 2 and 3 for the smaller blocks. At the last gram, as long
   as the strings, blocks are single starts and equal ones are one.

No group is collected whole: step 2 aggregates, step 3 holds bounded groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import PIECE, letters, mixed, numbered, opened, packed, powers, slices, text_bytes, tidy, told_apart, unpacked
from leafmill.session import stage

LENGTH = 200
GRAM = 64

# Distinct blocks of one anchor that are sorted together; more are cut by longer grams.
SORTED_BLOCKS = 256

# Bytes sorted at a time.
SORT_BYTES = 1 << 17

# Rows whose texts are open at a time.
CUT_ROWS = 256


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` keys, by block-wise running minima."""
    count = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(-1, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def blocks(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, kit: tuple):
    """(anchor hash, anchor place, first start, last start) of every block of the texts.

    Runs over PIECE starts at a time, so a text of any length takes the same memory
    beside its bytes and its blocks.
    """
    codes, up, down = kit
    width = length - gram + 1
    starts = len(data) - length + 1
    found = []
    low = np.uint64((1 << 18) - 1)
    for begin in range(0, starts, PIECE):
        count = min(PIECE, starts - begin)
        raw = data[begin : begin + count + length - 1]
        with np.errstate(over="ignore"):
            sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(codes[raw] * up[: len(raw)], out=sums[1:])
            grams = mixed((sums[gram:] - sums[:-gram]) * down[: len(raw) - gram + 1])
        least = window_minima((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width)
        place = (least & low).astype(np.int64)
        # Strings do not cross texts.
        at = np.arange(begin, begin + count)
        valid = np.flatnonzero(at + length <= offsets[np.searchsorted(offsets, at, side="right")])
        if not len(valid):
            continue
        owner = place[valid]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(valid) != 1)]))
        last = np.concatenate([new[1:], [len(valid)]]) - 1
        found.append((grams[owner[new]], owner[new] + begin, valid[new] + begin, valid[last] + begin))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    anchor, owner, first, last = (np.concatenate(column) for column in zip(*found))
    # A block that goes on in the next piece.
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (first[1:] != last[:-1] + 1)]))
    end = np.concatenate([new[1:], [len(owner)]]) - 1
    return anchor[new].view(np.int64), owner[new], first[new], last[end]


def run_heads(row: np.ndarray, anchor: np.ndarray, content: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Places of blocks, in order, that do not go on from an equal block of the same text."""
    goes_on = begin[1:] == end[:-1] + 1
    for column in (row, anchor, content, end - begin):
        goes_on &= column[1:] == column[:-1]
    return np.flatnonzero(~np.concatenate([[False], goes_on])) if len(begin) else np.zeros(0, np.int64)


def anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc, anchor, content, at, starts, run): a row per run of equal blocks of (doc, pack) rows.

    starts is that of one block; the run's blocks begin at ``at``, ``at + starts`` and so on.
    """

    def cut(batches):
        import xxhash

        kit = (letters(), *powers(PIECE + length + 1))
        for batch in batches:
            for ids, part, local in opened(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)):
                anchor, _, begin, end = blocks(part, local, length, gram, kit)
                row = np.searchsorted(local, begin, side="right") - 1
                view = memoryview(part)
                content = np.fromiter(
                    (xxhash.xxh3_64_intdigest(view[a : b + length]) for a, b in zip(begin.tolist(), end.tolist())),
                    np.uint64,
                    len(begin),
                )
                head = run_heads(row, anchor, content, begin, end)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row[head]]),
                        pa.array(anchor[head]),
                        pa.array(content.view(np.int64)[head]),
                        pa.array((begin - local[row])[head]),
                        pa.array((end - begin + 1).astype(np.int32)[head]),
                        pa.array(np.diff(head, append=len(begin)).astype(np.int32)),
                    ],
                    names=["doc", "anchor", "content", "at", "starts", "run"],
                )

    return docs.mapInArrow(tidy(cut), "doc bigint, anchor bigint, content bigint, at bigint, starts int, run int")


def suffix_order(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``length`` values, and whether each but the first
    shares them with the one before. Prefix doubling: from four values to half the length,
    then two overlapping halves. Values are below 2**15; length is 4 or more."""
    n = len(text)
    padded = np.concatenate([text + 1, np.zeros(3, np.int64)])
    key = ((padded[:n] << 15 | padded[1 : n + 1]) << 15 | padded[2 : n + 2]) << 15 | padded[3 : n + 3]
    step, shift = 4, 0
    while True:
        order = np.argsort(key)
        ordered = key[order]
        same = ordered[1:] == ordered[:-1]
        if shift or step == length:
            return order, same
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[1], 1 + np.cumsum(~same)])
        shift = 0 if 2 * step < length else length - step
        ahead = np.zeros(n, np.int64)
        ahead[: n - (shift or step)] = rank[shift or step :]
        key, step = rank * (n + 1) + ahead, 2 * step


def factors(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts whose longest previous factor, and whose longest next factor, reach ``length``.

    A previous factor is the longest common prefix with the previous or next smaller place
    in suffix order. In a run of neighbours that share ``length`` values one of the two is
    in the run for all places but the smallest; outside the run they share fewer. Next
    factors likewise, with larger places.
    """
    if len(text) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, same = suffix_order(text, length)
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    sizes = np.diff(np.concatenate([heads, [len(order)]]))
    least = np.repeat(np.minimum.reduceat(order, heads), sizes)
    most = np.repeat(np.maximum.reduceat(order, heads), sizes)
    return np.sort(order[order > least]), np.sort(order[order < most])


def found_by_sorting(contents: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """(doc, begin, end): bytes of distinct blocks that have a factor before, or any factor.

    contents: (anchor, doc, at, bytes); the blocks of an anchor arrive together.
    """

    def mark(batches):
        held, size, last = [], 0, None

        def flush():
            held.sort(key=lambda x: x[:2])
            pieces, begins, at = [], [], 0
            for k, (_, _, raw) in enumerate(held):
                begins.append(at)
                pieces += [np.frombuffer(raw, np.uint8).astype(np.int64), np.array([256 + k])]
                at += len(raw) + 1
            earlier, later = factors(np.concatenate(pieces), length)
            rows = earlier if keep_first else np.union1d(earlier, later)
            # Runs of starts; separators lie between blocks, so no run crosses one.
            cuts = np.flatnonzero(np.diff(rows) != 1)
            first = rows[np.concatenate([[0], cuts + 1])] if len(rows) else rows
            last = rows[np.concatenate([cuts, [len(rows) - 1]])] if len(rows) else rows
            block = np.searchsorted(begins, first, side="right") - 1
            doc = np.array([h[0] for h in held], np.int64)
            move = np.array([h[1] for h in held], np.int64) - np.array(begins, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc[block]), pa.array(first + move[block]), pa.array(last + move[block] + length)],
                names=["doc", "begin", "end"],
            )

        for batch in batches:
            for anchor, doc, at, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if anchor != last and size >= SORT_BYTES and held:
                    yield flush()
                    held, size = [], 0
                held.append((doc, at, raw))
                size, last = size + len(raw), anchor
        if held:
            yield flush()

    parts = contents.repartition(int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions")), "anchor").sortWithinPartitions("anchor")
    return parts.mapInArrow(tidy(mark), "doc bigint, begin bigint, end bigint")


def cut_again(contents: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, content, doc, at, bytes): the blocks' own blocks by a longer gram."""

    def cut(batches):
        import xxhash

        kit = (letters(), *powers(PIECE + length + 1))
        for batch in batches:
            doc, at = batch.column("doc").to_numpy(), batch.column("at").to_numpy()
            raw = batch.column("bytes").cast(pa.large_binary())
            data, offsets = text_bytes(raw)
            for first, last in slices(offsets):
                part, local = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                anchor, _, begin, end = blocks(part, local, length, gram, kit)
                row = np.searchsorted(local, begin, side="right") - 1
                pieces = [part[a : b + length].tobytes() for a, b in zip(begin.tolist(), end.tolist())]
                content = np.array([xxhash.xxh3_64_intdigest(x) for x in pieces], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.astype(np.int64)),
                        pa.array(content),
                        pa.array(doc[first:last][row]),
                        pa.array(at[first:last][row] + begin - local[row]),
                        pa.array(pieces, pa.binary()),
                    ],
                    names=["anchor", "content", "doc", "at", "bytes"],
                )

    return contents.mapInArrow(tidy(cut), "anchor bigint, content bigint, doc bigint, at bigint, bytes binary")


def found(contents: DataFrame, length: int, keep_first: bool, grams: tuple[int, ...]) -> DataFrame:
    """(doc, begin, end) of the blocks in (anchor, doc, at, bytes, blocks), which are distinct."""
    few = contents.where(F.col("blocks") <= SORTED_BLOCKS).drop("blocks")
    many = contents.where(F.col("blocks") > SORTED_BLOCKS).drop("blocks")
    spans = found_by_sorting(few, length, keep_first)
    if not grams or many.isEmpty():
        return spans
    smaller = stage(cut_again(many, length, grams[0]), "repeats-blocks")
    distinct = stage(
        smaller.groupBy("anchor", "content").agg(F.count("*").alias("times"), F.min(F.struct("doc", "at", "bytes")).alias("first")),
        "repeats-distinct",
    )
    again = distinct.where("times > 1").select("anchor", "content", F.col("first.doc").alias("doc1"), F.col("first.at").alias("at1"))
    whole = smaller.join(again, ["anchor", "content"])
    whole = whole.where("doc <> doc1 OR at <> at1") if keep_first else whole
    whole = whole.select("doc", F.col("at").alias("begin"), (F.col("at") + F.length("bytes")).alias("end"))
    several = stage(distinct.groupBy("anchor").agg(F.count("*").alias("blocks")).where("blocks > 1"), "repeats-several")
    rest = stage(distinct.join(several, "anchor").select("anchor", "first.*", "blocks"), "repeats-contents")
    return spans.union(whole).union(found(rest, length, keep_first, grams[1:]))


def repeated_spans(
    docs: DataFrame, doc: Column, pack: Column, length: int = LENGTH, keep_first: bool = False, gram: int = GRAM
) -> DataFrame:
    """(doc, begin, end): byte ranges covered by repeated strings, not yet merged.

    keep_first: the first occurrence in order of (doc, place) stays; otherwise every
    occurrence counts. doc is a bigint without nulls that no two rows share, pack the text
    as ``packed`` gives it. Stages tables.
    """
    named = docs.select(doc.alias("doc"), pack.alias("pack"))
    all_blocks = anchored(named, length, gram)
    # Written, so that the join has plain exchanges on both sides and can split a hot anchor.
    seen = stage(
        all_blocks.groupBy("anchor").agg(F.sum("run").alias("times")).where("times > 1").select("anchor"), "repeats-seen"
    )
    known = stage(all_blocks.join(seen, "anchor"), "repeats-blocks")

    distinct = stage(
        known.groupBy("anchor", "content").agg(
            F.sum("run").alias("times"), F.min(F.struct("doc", "at", "starts")).alias("first")
        ),
        "repeats-distinct",
    )
    # Whole blocks that occur again. A run meets one row, that of its block; the run that has
    # the first block goes from its second.
    whole = known.join(distinct.where("times > 1"), ["anchor", "content"])
    begin = F.col("at")
    if keep_first:
        whole = whole.where("doc <> first.doc OR at <> first.at OR run > 1")
        begin = F.when(F.expr("doc = first.doc AND at = first.at"), F.col("at") + F.col("starts")).otherwise(begin)
    whole = whole.select(
        "doc", begin.alias("begin"), (F.col("at") + F.col("starts").cast("bigint") * F.col("run") + (length - 1)).alias("end")
    )

    # Anchors with several distinct blocks.
    several = distinct.groupBy("anchor").agg(F.count("*").alias("blocks"), F.min("times").alias("least"))
    several = several.where("blocks > 1") if keep_first else several.where("blocks > 1 AND least = 1")
    wanted = stage(
        distinct.join(several, "anchor").select("anchor", "blocks", "first.*"), "repeats-open"
    )
    asked = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "blocks", "at", "starts")).alias("asked"))

    def fetch(batches):
        import zstandard

        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for doc_value, pack, rows in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                raw = unpacked(pack.as_py(), opener)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["anchor"] for r in rows], pa.int64()),
                        pa.array([doc_value] * len(rows), pa.int64()),
                        pa.array([r["at"] for r in rows], pa.int64()),
                        pa.array([raw[r["at"] : r["at"] + r["starts"] + length - 1] for r in rows], pa.binary()),
                        pa.array([r["blocks"] for r in rows], pa.int64()),
                    ],
                    names=["anchor", "doc", "at", "bytes", "blocks"],
                )

    texts = told_apart(named, "doc", wanted)[0].join(asked, "doc").select("doc", "pack", "asked")
    contents = stage(
        texts.mapInArrow(tidy(fetch), "anchor bigint, doc bigint, at bigint, bytes binary, blocks bigint"), "repeats-contents"
    )
    longer = tuple(length - (length - gram) // part for part in (3, 12)) + (length,)
    return whole.union(found(contents, length, keep_first, longer))


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching ranges."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], begins[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:], [len(begins)]]) - 1
    return begins[new], reach[last]


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    keep_first: bool = True,
    as_text: bool = False,
) -> DataFrame:
    """docs with columns ``kept``, ``n_bytes``, ``n_removed``, ``n_spans`` in place of the text.

    kept has the remaining bytes; with as_text it is a string, in which a cut inside a
    character drops that character's remaining bytes. A null text reads as empty. Every
    row counts by itself, with or without an id of its own: with keep_first rows follow
    each other by id (null first), those of one id by a hash of the text. An empty table
    gives no rows. Other columns stay as they are, but for columns of docs with the four
    names above, which are replaced. Stages tables, one of them with the texts, compressed.
    """
    results = ("kept", "n_bytes", "n_removed", "n_spans")
    rest = [name for name in docs.columns if name != text and name not in results]
    # Texts are compressed before rows are dealt by their order: it sorts keys and packs.
    renamed = docs.select(
        *(F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(rest)),
        F.col(f"`{doc_id}`").cast("bigint").alias("__id"),
        F.xxhash64(text).alias("__hash"),
        F.col(f"`{text}`").alias("__text"),
    )
    order = (F.col("__id").asc_nulls_first(), F.col("__hash")) if keep_first else ()
    rows = numbered(packed(renamed, "__text", "__pack"), "__doc", *order)
    spans = stage(repeated_spans(rows, F.col("__doc"), F.col("__pack"), length, keep_first), "repeats-spans")
    listed = spans.groupBy("doc").agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))
    listed = listed.withColumnRenamed("doc", "__doc")
    # Texts without any span stay where they are.
    touched, whole = told_apart(rows, "__doc", spans.select(F.col("doc").alias("__doc")))
    none = F.lit(None).cast("array<bigint>")
    joined = touched.join(listed, "__doc", "left").unionByName(whole.withColumns({"begins": none, "ends": none}))
    fields = [(f"c{i}", docs.schema[n].dataType.simpleString()) for i, n in enumerate(rest)]
    kept_kind = "string" if as_text else "binary"
    schema = "".join(f"{n} {t}, " for n, t in fields) + f"kept {kept_kind}, n_bytes bigint, n_removed bigint, n_spans bigint"

    def cut(batches):
        import zstandard

        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            # Some rows at a time: opened texts are larger than their packs.
            for begin in range(0, batch.num_rows, CUT_ROWS):
                part = batch.slice(begin, CUT_ROWS)
                kept, sizes, removed, spans_of = [], [], [], []
                for pack, begins, ends in zip(part.column("__pack"), part.column("begins"), part.column("ends")):
                    raw = unpacked(pack.as_py(), opener)
                    sizes.append(len(raw))
                    left = raw
                    if begins.is_valid:
                        first, last = merged(begins.values.to_numpy(), ends.values.to_numpy())
                        edges = np.concatenate([[0], np.stack([first, last], 1).ravel(), [len(raw)]]).tolist()
                        left = b"".join(raw[a:b] for a, b in zip(edges[0::2], edges[1::2]))
                    spans_of.append(len(first) if begins.is_valid else 0)
                    removed.append(len(raw) - len(left))
                    kept.append(left.decode("utf-8", "ignore") if as_text else left)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n, _ in fields),
                        pa.array(kept, pa.string() if as_text else pa.binary()),
                        *(pa.array(x, pa.int64()) for x in (sizes, removed, spans_of)),
                    ],
                    names=[*(n for n, _ in fields), *results],
                )

    picked = joined.select(*(n for n, _ in fields), "__pack", "begins", "ends")
    return picked.mapInArrow(tidy(cut), schema).select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(rest)), *results)
