"""Tokens, counts inside a row, hashed vectors and sentences.

All of it stays inside one row: counting terms of a chunk needs no explode and no
shuffle, because a chunk's text is in one place already. Terms are counted in Arrow, many
rows at a time, and a term is hashed once for all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens are letters and digits of any script; hyphens between two of them belong to
# the token, so codes such as 138L-1 stay whole. The pattern is of what lies between
# tokens: matching the tokens themselves would need a repeated group, which overflows
# the stack of Java's matcher on texts such as a-a-a-... of some ten thousand parts.
# What comes before a hyphen is looked at behind it, not at every character.
BETWEEN_TOKENS = r"[^\p{L}\p{N}-]+|-(?:(?![\p{L}\p{N}])|(?<![\p{L}\p{N}]-))"

# A text holds a token exactly if it holds one of these.
TOKEN_CHARACTER = r"[\p{L}\p{N}]"

SENTENCE_MARK = "\u0001"

# Bytes of text whose tokens a task counts at a time; a longer text stands alone.
COUNTED_TOGETHER = 1 << 22


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once, so that a lambda does not compute it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BETWEEN_TOKENS), "")


def counted(values: Column) -> Column:
    """array<T> to array<struct<value:T, n:int>>, sorted by value.

    Equal values are neighbours after sorting, so a value's count is the distance
    between its first position and the next value's. One sort and linear passes.
    """

    def over_sorted(ordered: Column) -> Column:
        positions = F.transform(ordered, lambda v, i: i)
        starts = F.filter(positions, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))

        def over_starts(first: Column) -> Column:
            return F.transform(
                first,
                lambda s, j: F.struct(
                    F.get(ordered, s).alias("value"),
                    (F.coalesce(F.get(first, j + 1), F.size(ordered)) - s).alias("n"),
                ),
            )

        return let(starts, over_starts)

    return let(F.sort_array(values), over_sorted)


def hash_bucket(term: Column, dims: int) -> Column:
    """Bucket of a term: first 32 bits of its MD5, modulo the vector size."""
    head = F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(dims)).cast("int")


def texts_together(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Neighbouring texts of about ``most`` bytes; at least one part, if without rows."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(texts) or begin == 0:
        before = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(begin, stop - begin)
        begin = stop


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of every word between spaces: its row, its code, and the words of the codes."""
    lists = pc.split_pattern(texts, " ")
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    words = lists.flatten().dictionary_encode()
    rows, codes = np.repeat(np.arange(len(texts), dtype=np.int64), sizes), words.indices.to_numpy()
    there = pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False)[codes]
    return rows[there], codes[there], words.dictionary


def summed_rows(texts: pa.Array, rows: np.ndarray, values: np.ndarray, most: int):
    """Distinct values of each row, ascending, how often each occurs, its row, and offsets of the
    rows, null where the text is. values: below ``most``."""
    keys = np.sort(rows * most + values)
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    row, value = np.divmod(keys[starts], most)
    offsets = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
    absent = np.append(pc.is_null(texts).to_numpy(zero_copy_only=False), False)
    return value, np.diff(starts, append=len(keys)), row, pa.array(offsets, mask=absent)


def spaced_tokens(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), BETWEEN_TOKENS, " ")


def term_counts(text: Column) -> Column:
    """The tokens of a text as ``counted`` gives them."""

    @F.arrow_udf("array<struct<value:string,n:int>>")
    def count(texts: pa.Array) -> pa.Array:
        def of(part: pa.Array) -> pa.Array:
            rows, codes, words = coded_words(part)
            # Strings ascend by their bytes, as Spark's do.
            order = pc.sort_indices(words)
            place = np.empty(len(order), np.int64)
            place[order.to_numpy()] = np.arange(len(order))
            value, n, _, offsets = summed_rows(part, rows, place[codes], max(1, len(words)))
            columns = [words.take(order.take(pa.array(value))), pa.array(n.astype(np.int32))]
            return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, names=["value", "n"]))

        return pa.concat_arrays([of(part) for part in texts_together(texts, COUNTED_TOGETHER)])

    return count(spaced_tokens(text))


def hashed_vector(text: Column, dims: int) -> Column:
    """Counts of hash buckets (``hash_bucket``) over the tokens of a text, scaled to Euclidean
    length one: buckets array<int>, ascending, and weights array<double>."""

    @F.arrow_udf("struct<buckets:array<int>,weights:array<double>>")
    def vector(texts: pa.Array) -> pa.Array:
        def of(part: pa.Array) -> pa.Array:
            rows, codes, words = coded_words(part)
            heads = [hashlib.md5(word.encode()).digest()[:4] for word in words.to_pylist()]
            buckets = np.array([int.from_bytes(head, "big") % dims for head in heads], np.int64)
            bucket, n, row, offsets = summed_rows(part, rows, buckets[codes], dims)
            norms = np.sqrt(np.bincount(row, (n * n).astype(float), len(part)))
            lists = [pa.array(bucket.astype(np.int32)), pa.array(n / norms[row])]
            return pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(offsets, values) for values in lists], names=["buckets", "weights"]
            )

        return pa.concat_arrays([of(part) for part in texts_together(texts, COUNTED_TOGETHER)])

    return vector(spaced_tokens(text))


def unit_weights(counts: Column) -> Column:
    """Counts scaled to Euclidean length one, in the order of the counts."""
    squares = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c["n"] * c["n"])
    return let(F.sqrt(squares), lambda norm: F.transform(counts, lambda c: c["n"] / norm))


def sentences(text: Column) -> Column:
    """Trimmed non-empty sentences. A full stop ends one only before white space."""
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1" + SENTENCE_MARK)
    parts = F.split(marked, "[" + SENTENCE_MARK + "\n]+")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: F.length(s) > 0)
