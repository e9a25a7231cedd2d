"""Helpers of the corpus operators: tables, byte buffers, hashes of spans, packed texts.

Task functions take Arrow batches, which Spark bounds in rows and bytes. They work on
slices of about a megabyte, so a task's memory does not depend on the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.session import stage

SLICE_BYTES = 1 << 20

# Positions hashed at a time.
PIECE = 1 << 16

# Of the bitmap that keeps rows out of an exchange; a word is a broadcast row of 16 bytes.
BITMAP_WORDS = 1 << 18

WORD = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered(docs: DataFrame, name: str, *order: Column) -> DataFrame:
    """docs, staged, with a bigint ``name`` that no two rows share; it ascends along ``order``.

    Rows equal in ``order`` follow a hash of all their columns but maps. Equal rows are
    dealt by place, so they need not share a task. Rows travel whole: pack their texts first.
    """
    if order:
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        plain = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
        keys = dict(zip(("__tie", "__place"), (F.xxhash64(*plain), F.monotonically_increasing_id())))
        ranged = docs.withColumns(keys).repartitionByRange(parts, *order, *keys)
        docs = ranged.sortWithinPartitions(*order, *keys).drop(*keys)
    # Ascends inside a partition and from one to the next, as the ranges do.
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and its n + 1 offsets; null reads as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES):
    """Row ranges of about ``most`` bytes; a longer row stands alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, end
        row = end


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def letters() -> np.ndarray:
    """A fixed 64-bit word per byte value."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(count: int = PIECE + 1) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64."""

    def run(base: int) -> np.ndarray:
        out = np.full(count, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(BASE), run(pow(BASE, -1, 1 << 64))


def sums_at(data: np.ndarray, cuts: np.ndarray, codes: np.ndarray, up: np.ndarray, down: np.ndarray):
    """Sum of codes[data[i]] * BASE**i over i < cut, and BASE**-cut, at ascending cuts.

    Runs piece by piece and carries the sum, so texts of any length fit.
    """
    sums, inverse = np.empty(len(cuts), np.uint64), np.empty(len(cuts), np.uint64)
    done, base, scale, unscale = 0, 0, 1, 1
    with np.errstate(over="ignore"):
        for begin in range(0, max(1, len(data)), PIECE):
            part = codes[data[begin : begin + PIECE]] * up[: len(data[begin : begin + PIECE])]
            run = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part, out=run[1:])
            last = begin + PIECE >= len(data)
            end = len(cuts) if last else int(np.searchsorted(cuts, begin + PIECE, side="left"))
            local = cuts[done:end] - begin
            sums[done:end] = np.uint64(base) + np.uint64(scale) * run[local]
            inverse[done:end] = np.uint64(unscale) * down[local]
            base = (base + scale * int(run[-1])) & WORD
            scale, unscale = scale * int(up[PIECE]) & WORD, unscale * int(down[PIECE]) & WORD
            done = end
    return sums, inverse


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, kit: tuple) -> np.ndarray:
    """A 64-bit hash of each span's bytes; spans ascend and do not overlap.

    kit: (letters(), *powers()), made once per task.
    """
    codes, up, down = kit
    cuts = np.empty(2 * len(begins), np.int64)
    cuts[0::2], cuts[1::2] = begins, ends
    sums, inverse = sums_at(data, cuts, codes, up, down)
    with np.errstate(over="ignore"):
        value = (sums[1::2] - sums[0::2]) * inverse[0::2]
        return mixed(value + (ends - begins).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_space: np.ndarray):
    """Begins and ends of the words of each text, and how many words each text has.

    is_space: 256 booleans. Words do not cross texts.
    """
    inside = ~is_space[data]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    if len(data):
        before[1:], before[0] = ~inside[:-1], True
        after[:-1], after[-1] = ~inside[1:], True
        before[starts] = True
        after[starts[1:] - 1] = True
    begins = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    counts = np.diff(np.searchsorted(begins, offsets))
    return begins, ends, counts


def space_table() -> np.ndarray:
    """Space and the control characters from tab to carriage return."""
    out = np.zeros(256, bool)
    out[[32, *range(9, 14)]] = True
    return out


def ascii_lower() -> np.ndarray:
    """Byte values with A-Z mapped to a-z."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def shipped(spark: SparkSession, value):
    """A function for tasks that returns ``value``: broadcast by value, so executors need not
    have this package. Only for values of a proven size."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get():
        import pickle

        return pickle.loads(held.value)

    return get


def tidy(run):
    """A task function that gives the memory it no longer needs back to the system at its end.

    Python workers serve one task after another; what allocators keep for later would add
    up over the stages of a long job.
    """

    def tidied(batches):
        yield from run(batches)
        import ctypes
        import gc

        import pyarrow

        gc.collect()
        pyarrow.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return tidied


def maybe_among(frame: DataFrame, key: str, keys: DataFrame, flag: str) -> DataFrame:
    """frame with a boolean ``flag``: false if ``key`` is not in keys (a column of that name).

    A broadcast bitmap of at most BITMAP_WORDS * 64 bits tells; hashes that meet flag some
    other keys too, at any number of keys. Null is a key like others.
    """
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(64 * BITMAP_WORDS))
    words = keys.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("__word"))
    bitmap = words.agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("__bits"))
    placed = frame.withColumn("__p", place).withColumn("__word", F.shiftright("__p", 6))
    bit = F.expr("coalesce(shiftright(__bits, cast(__p & 63 as int)) & 1L, 0L) = 1")
    return placed.join(F.broadcast(bitmap), "__word", "left").select(*frame.columns, bit.alias(flag))


def told_apart(frame: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of frame whose ``key`` may be among those of keys, and rows whose key is not.

    The first part still needs an exact join; nothing is lost.
    """
    flagged = maybe_among(frame, key, keys, "__maybe")
    return tuple(flagged.where(F.col("__maybe") == F.lit(want)).drop("__maybe") for want in (True, False))


def without_keys(frame: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of frame whose ``key`` is not among those of keys. Rows that are surely not stay
    where they are; only the others meet the keys. Nulls are among no keys."""
    maybe, rest = told_apart(frame, key, keys)
    return maybe.join(keys.select(key), key, "left_anti").select(*frame.columns).unionByName(rest)


def packed(frame: DataFrame, text: str, to: str) -> DataFrame:
    """The frame with a text column compressed as binary ``to``, for exchanges of whole texts.

    Null becomes null. The text column goes.
    """
    kept = [name for name in frame.columns if name != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != text)

    def pack(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            column = batch.column(text).cast(pa.large_binary())
            values = [None if not v.is_valid else press.compress(v.as_buffer()) for v in column]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), pa.array(values, pa.binary())], names=[*kept, to]
            )

    return frame.select(*kept, text).mapInArrow(tidy(pack), f"{schema}, `{to}` binary")


def unpacked(value: bytes | None, opener) -> bytes:
    """Bytes of a packed text; null reads as empty. opener: a zstandard.ZstdDecompressor."""
    return b"" if value is None else opener.decompress(value)


def opened(keys: np.ndarray, packs: pa.Array, most: int = SLICE_BYTES):
    """(keys, bytes, offsets) of packed texts, about ``most`` bytes at a time; a longer text stands alone."""
    import zstandard

    opener = zstandard.ZstdDecompressor()
    begin, held, size = 0, [], 0
    for at, pack in enumerate(packs):
        raw = unpacked(pack.as_py(), opener)
        if held and size + len(raw) > most:
            yield part_of(keys[begin:at], held)
            begin, held, size = at, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield part_of(keys[begin:], held)


def part_of(keys: np.ndarray, texts: list[bytes]):
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return keys, np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)])
