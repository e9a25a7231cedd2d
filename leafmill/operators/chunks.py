"""Overlapping chunks, the shared chunk table, and changes between two versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.columns import chunk_key
from leafmill.functions.text import let
from leafmill.schemas import CHUNK, conform

# Chunk length and overlap in characters.
CHUNK_CHARS = 1200
OVERLAP_CHARS = 200

# Chunks cut from one piece of a text. A substring is found by counting characters
# from the start, so cutting a very long text directly would take quadratic time.
CHUNKS_PER_PIECE = 256

# Of a bitmap of keys; a word is a broadcast row of 16 bytes.
BITMAP_WORDS = 1 << 18


def chunk_text(
    documents: DataFrame,
    text: str = "page_text",
    size: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    drop_contained_tail: bool = False,
) -> DataFrame:
    """Explode each text into chunks of ``size`` characters every ``size - overlap``.

    Adds chunk_index (from 0) and chunk_text; texts that are NULL or empty give no
    row. The last chunk can lie wholly inside the one before; ``drop_contained_tail``
    leaves it out. Narrow: no shuffle.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and smaller than size")
    step = size - overlap
    length = F.length(text)
    reach = length - overlap if drop_contained_tail else length
    count = F.greatest(F.ceil(reach / F.lit(step)).cast("int"), F.lit(1))

    def piece(p: Column) -> Column:
        first = p * F.lit(CHUNKS_PER_PIECE)
        body = F.substring(F.col(text), first * F.lit(step) + 1, F.lit(CHUNKS_PER_PIECE * step + overlap))
        last = F.least(count - first, F.lit(CHUNKS_PER_PIECE)) - 1
        return let(
            body,
            lambda b: F.transform(
                F.sequence(F.lit(0), last), lambda i: F.substring(b, i * F.lit(step) + 1, F.lit(size))
            ),
        )

    pieces = F.sequence(F.lit(0), F.floor((count - 1) / F.lit(CHUNKS_PER_PIECE)).cast("int"))
    cut = F.flatten(F.transform(pieces, piece))
    return documents.select("*", F.posexplode(cut).alias("chunk_index", "chunk_text")).where(F.length("chunk_text") > 0)


def document_chunks(documents: DataFrame, size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Document pages to chunk rows of the shared contract."""
    chunks = chunk_text(documents, "page_text", size, overlap)
    return conform(
        chunks,
        CHUNK,
        {"chunk_id": chunk_key(F.col("doc_id"), F.col("page_number"), F.col("chunk_index"))},
    )


def union_chunks(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, duplicates kept, matched by column name."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def diff_chunks(old: DataFrame, new: DataFrame, key: str = "chunk_id", columns: Sequence[str] | None = None) -> DataFrame:
    """Changes that turn ``old`` into ``new``: key, change (insert, update, delete).

    All columns that both have are compared, or only those named (for an index of the
    text: its text). Only key and hash are shuffled. Equal NULLs count as unchanged. Should a
    key occur several times, its rows are compared as a whole: each side is reduced to
    one row per key before the join, on the join's own partitioning.
    """

    compared = [c for c in (columns or new.columns) if c != key and c in old.columns]

    def reduced(frame: DataFrame, name: str) -> DataFrame:
        hashed = frame.select(key, F.sha2(F.to_json(F.struct(*compared)), 256).alias("h"))
        spread_sum = F.sum(F.xxhash64("h").cast("decimal(38,0)"))
        state = F.struct(F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"), spread_sum.alias("all"))
        return hashed.groupBy(key).agg(state.alias(name))

    change = (
        F.when(F.col("before").isNull(), "insert")
        .when(F.col("after").isNull(), "delete")
        .when(F.col("before") != F.col("after"), "update")
    )
    return (
        reduced(old, "before")
        .join(reduced(new, "after"), key, "full")
        .select(key, change.alias("change"))
        .where(F.col("change").isNotNull())
    )


def maybe_among(frame: DataFrame, key: str, keys: DataFrame, flag: str) -> DataFrame:
    """frame with a boolean ``flag``: false if ``key`` is surely not in keys. A broadcast bitmap
    of fixed size tells, at any number of keys; null is a key like others."""
    place = F.pmod(F.xxhash64(key), F.lit(64 * BITMAP_WORDS))
    words = keys.select(place.alias("_p")).groupBy(F.shiftright("_p", 6).alias("_word"))
    bitmap = words.agg(F.expr("bit_or(shiftleft(1L, cast(_p & 63 as int)))").alias("_bits"))
    placed = frame.withColumns({"_p": place, "_word": F.shiftright(place, 6)})
    bit = F.expr("coalesce(shiftright(_bits, cast(_p & 63 as int)) & 1L, 0L) = 1")
    return placed.join(F.broadcast(bitmap), "_word", "left").select(*frame.columns, bit.alias(flag))


def told_apart(frame: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of frame whose ``key`` is in keys, rows whose key is not, and rows still to be joined.

    Wide rows stay where they are, if two bitmaps tell them apart: one of the keys, and one of
    the frame's own keys that the first takes for such without need. Only keys are exchanged
    for these. The frame is read three times, once for its keys alone, so it should be stored.
    """
    wrong = maybe_among(frame.select(key), key, keys, "_in").where("_in").select(key).join(keys, key, "left_anti")
    flagged = maybe_among(maybe_among(frame, key, keys, "_in"), key, wrong, "_wrong")
    told = ("_in and not _wrong", "not _in", "_in and _wrong")
    return tuple(flagged.where(rows).select(*frame.columns) for rows in told)


def rows_among(frame: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The left semi join, by ``told_apart``."""
    keys = keys.select(key)
    inside, _, unsure = told_apart(frame, key, keys)
    return inside.unionByName(unsure.join(keys, key, "left_semi"))


def rows_not_among(frame: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The left anti join, by ``told_apart``."""
    keys = keys.select(key)
    _, outside, unsure = told_apart(frame, key, keys)
    return outside.unionByName(unsure.join(keys, key, "left_anti"))


def apply_changes(old: DataFrame, new: DataFrame, changes: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Old rows whose key did not change, and the new rows of changed keys.

    The three tables are read several times and should be stored.
    """
    return rows_not_among(old, key, changes).unionByName(arrived_rows(new, changes, key))


def arrived_rows(new: DataFrame, changes: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The new rows of inserted and updated keys."""
    return rows_among(new, key, changes.where(F.col("change") != "delete"))
