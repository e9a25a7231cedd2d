"""Byte-level BPE encoding and decoding in padded numpy matrices.

Pre-tokens not seen before are sorted into matrices by length. In a round every row
merges its leftmost pair of least rank; pair ranks come from a hash table; rows that
have no pair left drop out. Results stay in a cache of fixed size per task.
"""

import base64
import hashlib
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import shipped, slices, tidy
from leafmill.llm.pretokens import portions

NONE = np.iinfo(np.int32).max

# Pre-tokens of more bytes merge one by one with a heap: a matrix would be quadratic.
MATRIX_BYTES = 256
MATRIX_ROWS = 1 << 13

CACHED = 1 << 18
CACHED_CHARS = 64

# Characters whose pre-tokens are looked up, and if new encoded, together.
TOGETHER_CHARS = 1 << 18

PAIR_SLOTS = 1 << 19

# Text whose ids a task holds at a time.
BATCH_BYTES = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file."""
    rows = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in rows}


class PairTable:
    """Rank of the token that two token ids make together: open addressing in numpy."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.bits = max(PAIR_SLOTS, 1 << (2 * len(pairs) + 1).bit_length()).bit_length() - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys = np.array([k for k, _ in pairs], np.int64)
        values = np.array([v for _, v in pairs], np.int32)
        slots, self.probes = self._slots(keys), 0
        while len(keys):
            self.probes += 1
            free = self.keys[slots] == -1
            # Of several keys for a slot the last written stays; the others go on.
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slots = (slots[~placed] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, NONE where there is no such token."""
        keys = (left.astype(np.int64) << 32) | right
        slots = self._slots(keys)
        out = np.where(self.keys[slots] == keys, self.values[slots], NONE)
        rest = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] != -1))
        for probe in range(1, self.probes):
            if not len(rest):
                break
            at = (slots[rest] + probe) & ((1 << self.bits) - 1)
            hit = self.keys[at] == keys[rest]
            out[rest[hit]] = self.values[at[hit]]
            rest = rest[~hit & (self.keys[at] != -1)]
        return out


def merge_matrix(ids: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> list[bytes]:
    """Final ids, as little-endian unsigned words, of each row of a padded matrix."""
    done: list[bytes] = [b""] * len(ids)
    rows = np.arange(len(ids))
    width = ids.shape[1]
    inside = np.arange(width - 1)[None, :] < lengths[:, None] - 1
    ranks = np.full((len(ids), width - 1), NONE, np.int32)
    ranks[inside] = pairs.find(ids[:, :-1][inside], ids[:, 1:][inside])
    while len(ids):
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(ids)), at]
        ended = best == NONE
        if ended.any():
            for row, n, line in zip(rows[ended].tolist(), lengths[ended].tolist(), ids[ended].astype("<u4")):
                done[row] = line[:n].tobytes()
            go = ~ended
            ids, lengths, ranks, rows, at, best = ids[go], lengths[go], ranks[go], rows[go], at[go], best[go]
            if not len(ids):
                break
        each = np.arange(len(ids))
        # Close the gap behind the merged pair.
        columns = np.arange(ids.shape[1] - 1)[None, :]
        ids[each, at] = best
        shifted = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
        columns = columns[:, :-1]
        ranks = np.take_along_axis(ranks, columns + (columns > at[:, None]), axis=1)
        ids, lengths = shifted, lengths - 1
        if not ranks.shape[1]:
            ranks = np.full((len(ids), 1), NONE, np.int32)
            continue
        for place in (at - 1, at):
            fits = np.flatnonzero((place >= 0) & (place + 1 < lengths))
            ranks[fits, place[fits]] = pairs.find(ids[fits, place[fits]], ids[fits, place[fits] + 1])
        at_end = np.flatnonzero((at + 1 >= lengths) & (at < ranks.shape[1]))
        ranks[at_end, at[at_end]] = NONE
    return done


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> bytes:
    """The same for one long pre-token, with a heap of pairs."""
    n = len(piece)
    ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(ranks[piece[i : i + 2]], i, i + 1, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, middle, end = heapq.heappop(heap)
        j = after[i] if ends[i] == middle else -1
        if j != middle or j < 0 or ends[j] != end:
            continue
        ends[i], ends[j], after[i] = end, -1, after[j]
        if after[i] >= 0:
            before[after[i]] = i
            last = ends[after[i]]
            if piece[i:last] in ranks:
                heapq.heappush(heap, (ranks[piece[i:last]], i, end, last))
        if before[i] >= 0:
            first = before[i]
            if piece[first:end] in ranks:
                heapq.heappush(heap, (ranks[piece[first:end]], first, i, end))
    out, i = [], 0
    while i >= 0 and n:
        out.append(ranks[piece[i : ends[i]]])
        i = after[i]
    return np.array(out, "<u4").tobytes()


class Encoder:
    """Pre-tokens to ids and back, for one task."""

    def __init__(self, ranks: dict[bytes, int], pairs: PairTable):
        self.ranks, self.pairs = ranks, pairs
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.cache: dict[str, bytes] = {}

    def encode(self, lists: list[list[str]]) -> list[bytes]:
        """Ids of each list's pre-tokens, end to end, as little-endian unsigned 32-bit words."""
        cache, wanted = self.cache, set().union(*lists)
        missed = [p for p in wanted if p not in cache]
        if missed and len(cache) + len(missed) > CACHED:
            cache.clear()
            missed = list(wanted)
        found = dict(zip(missed, self._encode([p.encode() for p in missed])))
        long = {p: ids for p, ids in found.items() if len(p) > CACHED_CHARS}
        cache.update((p, ids) for p, ids in found.items() if p not in long)
        if long:
            return [b"".join([long[p] if p in long else cache[p] for p in pieces]) for pieces in lists]
        return [b"".join(map(cache.__getitem__, pieces)) for pieces in lists]

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if piece in self.ranks:
                out[i] = self.ranks[piece].to_bytes(4, "little")
            elif len(piece) > MATRIX_BYTES:
                out[i] = merge_long(piece, self.ranks)
            else:
                by_width.setdefault(max(4, -(-len(piece) // 4) * 4), []).append(i)
        for width, members in by_width.items():
            step = max(1, MATRIX_ROWS * 16 // width)
            for first in range(0, len(members), step):
                chosen = members[first : first + step]
                raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in chosen), np.uint8)
                lengths = np.array([len(pieces[i]) for i in chosen])
                for i, ids in zip(chosen, merge_matrix(self.single[raw].reshape(-1, width), lengths, self.pairs)):
                    out[i] = ids
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoded(docs: DataFrame, ranks_file: str, pattern: str, text: str = "text", digests_only: bool = False) -> DataFrame:
    """docs with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` added, and with
    ``token_ids`` (array of int) unless digests_only; ``text`` goes.

    Each match of the pattern is encoded by itself, without special tokens. Null reads
    as empty. Columns of the added names are replaced.
    """
    ranks = read_ranks(ranks_file)
    # Fixed in size by the vocabulary.
    shared = shipped(docs.sparkSession, (ranks, PairTable(ranks)))
    added = ("n_tokens", "ids_sha256", "decoded_sha256", "token_ids")
    rest = [f for f in docs.schema if f.name != text and f.name not in added]
    fields = [(f"c{i}", f.dataType.simpleString()) for i, f in enumerate(rest)]
    fields += [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    fields += [] if digests_only else [("token_ids", "array<int>")]

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Neighbouring rows of about BATCH_BYTES of text: their ids are held until all are encoded."""
        sizes = pc.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        for begin, end in slices(offsets, BATCH_BYTES):
            yield batch.slice(begin, end - begin)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        coder, matcher = Encoder(*shared()), regex.compile(pattern)
        for batch in (part for whole in batches for part in cut(whole)):
            rows = batch.num_rows
            of_ids, of_text = [hashlib.sha256() for _ in range(rows)], [hashlib.sha256() for _ in range(rows)]
            counts, kept = [0] * rows, [[] for _ in range(rows)]

            def take(held):
                for (row, _), ids in zip(held, coder.encode([pieces for _, pieces in held])):
                    of_ids[row].update(ids)
                    of_text[row].update(coder.decode(ids))
                    counts[row] += len(ids) // 4
                    if not digests_only:
                        kept[row].append(ids)

            # New pre-tokens of many texts are encoded together.
            held, chars = [], 0
            for row, value in enumerate(batch.column(batch.num_columns - 1)):
                for pieces in portions(matcher, value.as_py() or ""):
                    held.append((row, pieces))
                    chars += sum(map(len, pieces))
                    if chars >= TOGETHER_CHARS:
                        take(held)
                        held, chars = [], 0
            take(held)
            ids_hash, text_hash = [h.hexdigest() for h in of_ids], [h.hexdigest() for h in of_text]
            lists = [np.frombuffer(b"".join(parts), "<i4") for parts in kept]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(text_hash)]
            if not digests_only:
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.int32), *lists]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])

    narrow = docs.select(*(F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(rest)), F.col(text).alias("text"))
    out = narrow.mapInArrow(tidy(encode), ", ".join(f"{n} {t}" for n, t in fields))
    return out.select(
        *(F.col(f"c{i}").alias(f.name) for i, f in enumerate(rest)), *(n for n, _ in fields[len(rest) :])
    )


def decoded(frame: DataFrame, ranks_file: str, ids: str = "token_ids", to: str = "text") -> DataFrame:
    """The frame with its ids as text; bytes that are not UTF-8 become replacement characters.

    Null ids give null. Ids outside the vocabulary raise an error.
    """
    shared = shipped(frame.sparkSession, {v: k for k, v in read_ranks(ranks_file).items()})

    @F.pandas_udf("string")
    def back(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared()

        def one(row):
            return None if row is None else b"".join(map(table.__getitem__, list(row))).decode("utf-8", "replace")

        for column in columns:
            yield column.map(one)

    return frame.withColumn(to, back(F.col(ids)))
