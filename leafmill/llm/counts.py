"""Token counts by a map-side two-tier lookup.

The token counts of frequent pre-tokens travel to the tasks in a table of fixed size;
other pre-tokens are encoded in the task and kept in a cache of fixed size. No pre-token
is shuffled. What is frequent is counted over all texts: tasks count words, keep those
that are frequent in a slice, and hand out a bounded number of sums. The table only saves
time: results do not depend on it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import letters, powers, slices, space_table, span_hashes, text_bytes, word_spans
from leafmill.llm.pretokens import portions

# Entries of the frequent table, and of what a task hands out for it.
FREQUENT = 16_384

# Words that a slice of about a megabyte may add to a task's sums, by how often it has them.
SLICE_WORDS = 4_096
WORD_BYTES = 64

CACHED = 1 << 19
CACHED_CHARS = 64
LIMIT = 512


def encoder(definition: str):
    """(matcher, special strings, function from pre-tokens to counts) of a byte-level BPE file."""
    import json
    import os

    import public_tokenizers
    import regex

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    special = [t["content"] for t in json.loads(definition)["added_tokens"]]
    cutter = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None

    def lengths(pieces: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    return regex.compile(public_tokenizers.PATTERN), cutter, lengths


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, n): how often words occur, for those that are frequent in some slice. One pass
    over all texts; a task keeps at most 4 * FREQUENT sums and hands out FREQUENT."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kit, spaces = (letters(), *powers()), space_table()
        sums: Counter = Counter()
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for first, last in slices(offsets):
                part = data[offsets[first] : offsets[last]]
                begins, ends, _ = word_spans(part, offsets[first : last + 1] - offsets[first], spaces)
                _, at, times = np.unique(span_hashes(part, begins, ends, kit), return_index=True, return_counts=True)
                often = np.argsort(-times, kind="stable")[:SLICE_WORDS]
                for word, n in zip(at[often].tolist(), times[often].tolist()):
                    if ends[word] - begins[word] <= WORD_BYTES:
                        sums[part[begins[word] : ends[word]].tobytes()] += n
                if len(sums) > 4 * FREQUENT:
                    sums = Counter(dict(sums.most_common(2 * FREQUENT)))
        found = sums.most_common(FREQUENT)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())], names=["word", "n"]
        )

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(words: list[tuple[bytes, int]], definition: str) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of (word, how often), each after a space."""
    matcher, _, lengths = encoder(definition)
    seen: Counter = Counter()
    for word, n in words:
        for piece in matcher.findall(" " + word.decode("utf-8", "ignore")):
            seen[piece] += n
    pieces = [piece for piece, _ in seen.most_common(FREQUENT)]
    return dict(zip(pieces, lengths(pieces)))


def token_counts(docs: DataFrame, tokenizer_file: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """docs without ``text`` and with ``n_bytes``, ``n_tokens``, ``over_limit`` added.

    Counts are those of the tokenizers library for the whole text, without tokens at
    begin or end; the file's special strings count as its added tokens. Null reads as
    empty; equal rows get equal counts, and an empty table gives no rows. Columns of the
    added names are replaced. Counts the words of all texts when called, and reads the
    FREQUENT most frequent.
    """
    definition = Path(tokenizer_file).read_text()
    top = word_counts(docs, text).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    table_of = frequent([(bytes(r["word"]), r["n"]) for r in top], definition)
    shared = docs.sparkSession.sparkContext.broadcast((definition, table_of))
    added = ("n_bytes", "n_tokens", "over_limit")
    rest = [f for f in docs.schema if f.name != text and f.name not in added]
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(rest))
    schema = f"{schema + ', ' if rest else ''}n_tokens bigint, n_bytes bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, table = shared.value
        matcher, cutter, lengths = encoder(definition)
        cache: dict[str, int] = {}

        def total(pieces: list[str]) -> int:
            missed = [p for p in set(pieces) if p not in table and p not in cache]
            rare = {}
            if missed:
                if len(cache) + len(missed) > CACHED:
                    cache.clear()
                    missed = [p for p in set(pieces) if p not in table]
                for piece, n in zip(missed, lengths(missed)):
                    (cache if len(piece) <= CACHED_CHARS else rare)[piece] = n
            tiers = (table, cache, rare)
            return sum(next(tier[p] for tier in tiers if p in tier) for p in pieces) if rare else sum(
                table[p] if p in table else cache[p] for p in pieces
            )

        for batch in batches:
            counts, sizes = [], []
            for value in batch.column(batch.num_columns - 1):
                whole = value.as_py() or ""
                parts = cutter.split(whole) if cutter else [whole]
                counts.append(len(parts) - 1 + sum(total(p) for part in parts for p in portions(matcher, part)))
                sizes.append(len(whole.encode()))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                names=[*(f"c{i}" for i in range(len(columns))), "n_tokens", "n_bytes"],
            )

    narrow = docs.select(*(F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(rest)), F.col(text).alias("text"))
    return narrow.mapInArrow(count, schema).select(
        *(F.col(f"c{i}").alias(f.name) for i, f in enumerate(rest)),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
