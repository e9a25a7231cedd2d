"""Lempel-Ziv phrase fingerprints.

A text's bytes are parsed into dictionary phrases, each the shortest string not yet in
the dictionary; the phrases are hashed, and a signature keeps the smallest hash in each
of a fixed number of bins. Two signatures agree in about the share of phrases that the
texts have in common, which follows how well one text compresses given the other.

The dictionary starts anew when it is full, so memory is bounded for any text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import letters, mixed, packed, powers, span_hashes, unpacked

BINS = 128
FULL = 1 << 18
EMPTY = 0xFFFF

# Ranges of ids in which neighbours are found; each is streamed by one task.
RANGES = 256


class Parse:
    """An incremental parse; ``ends`` are the ends of its phrases so far."""

    def __init__(self):
        self.tree, self.node, self.size, self.at, self.ends = {}, 0, 256, 0, []

    def feed(self, raw: bytes) -> list[int]:
        """Parses on; returns the keys added to the dictionary that was there before."""
        tree, node, size, at = self.tree, self.node, self.size, self.at
        find, ended, added = tree.get, self.ends.append, []
        log, full = added.append, FULL << 8
        for at, byte in enumerate(raw, at + 1):
            key = node | byte
            node = find(key)
            if node is None:
                tree[key] = size
                size += 256
                node = 0
                ended(at)
                log(key)
                if size >= full:
                    tree, size = {}, 256
                    find, log = tree.get, [].append
        self.tree, self.node, self.size, self.at = tree, node, size, at
        return added

    def state(self) -> tuple:
        return self.tree, self.node, self.size, self.at, len(self.ends)

    def back(self, state: tuple, added: list[int]) -> None:
        """Returns to an earlier state, given what feed() added since."""
        self.tree, self.node, self.size, self.at, count = state
        del self.ends[count:]
        for key in added:
            del self.tree[key]


def fingerprint(raw: bytes, ends: list[int], kit: tuple) -> np.ndarray:
    """16 bits of the smallest phrase hash in each bin; EMPTY where a bin has none."""
    out = np.full(BINS, EMPTY, np.uint16)
    if ends:
        stops = np.array(ends, np.int64)
        hashes = np.sort(span_hashes(np.frombuffer(raw, np.uint8), np.concatenate([[0], stops[:-1]]), stops, kit))
        bins, first = np.unique((hashes >> np.uint64(57)).astype(np.int64), return_index=True)
        out[bins] = (mixed(hashes[first]) % np.uint64(EMPTY)).astype(np.uint16)
    return out


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Share of equal bins among those that either has; 1 for two without phrases."""
    used = (left != EMPTY) | (right != EMPTY)
    return float(((left == right) & used).sum() / used.sum()) if used.any() else 1.0


def cut_at(raw: bytes, chars: int) -> int:
    """Bytes of the first ``chars`` code points."""
    if chars <= 0:
        return 0
    starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return int(starts[chars]) if chars < len(starts) else len(raw)


def code_points(raw: bytes) -> int:
    return int(((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80).sum())


def printed(raw: bytes, kit: tuple) -> np.ndarray:
    parse = Parse()
    parse.feed(raw)
    return fingerprint(raw, parse.ends, kit)


def with_edit(raw: bytes, following: bytes, kit: tuple):
    """(code points, fingerprint, edited text, its fingerprint); the common part is parsed once."""
    chars = code_points(raw)
    moved = chars // 4
    cut = cut_at(raw, chars - moved)
    parse = Parse()
    parse.feed(raw[:cut])
    state = parse.state()
    added = parse.feed(raw[cut:])
    own = fingerprint(raw, parse.ends, kit)
    if moved == 0:
        return chars, own, raw, own
    parse.back(state, added)
    edited = raw[:cut] + following[: cut_at(following, moved)]
    parse.feed(edited[cut:])
    return chars, own, edited, fingerprint(edited, parse.ends, kit)


def neighbour_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses.

    The edited text: the last quarter of the code points (rounded down) replaced by as
    many from the start of the next document in ascending id, of the first after the
    last. Rows: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next). Null reads as empty; null ids come first; rows with equal
    ids follow each other in order of their texts' bytes. Reads the ids when called.

    Ids are cut into ranges at quantiles; a range is sorted and streamed, and gets the
    first row of the next range as a guest. Texts are exchanged once, compressed.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    shares = [i / RANGES for i in range(1, RANGES)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 100_000)).first()[0] or []))
    marks = F.array(*(F.lit(b) for b in bounds)).cast("array<bigint>")
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(marks, lambda b: b <= F.col("doc_id"))))
    placed = rows.withColumn("bucket", bucket)
    # The least id of every range; its rows also go to the range before.
    leads = {r.bucket: r.low for r in placed.groupBy("bucket").agg(F.min("doc_id").alias("low")).collect()}
    order = sorted(leads)
    guests = F.lit(None).cast("int")
    for at, name in enumerate(order):
        lead = F.col("doc_id").isNull() if name == -1 else F.col("doc_id") == leads[name]
        guests = F.when((F.col("bucket") == name) & lead, F.lit(order[at - 1])).otherwise(guests)
    copies = F.filter(
        F.array(F.struct(F.col("bucket"), F.lit(0).alias("guest")), F.struct(guests.alias("bucket"), F.lit(1).alias("guest"))),
        lambda c: c["bucket"].isNotNull(),
    )
    parts = max(2, min(RANGES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    streamed = (
        packed(placed, "text", "pack")
        .select("doc_id", "pack", F.explode(copies).alias("c"))
        .select("c.bucket", "c.guest", "doc_id", "pack")
        .repartitionByRange(parts, "bucket")
        .sortWithinPartitions("bucket", "guest", "doc_id", "pack")
    )

    def prints(batches):
        import hashlib

        import zstandard

        kit, opener = (letters(), *powers()), zstandard.ZstdDecompressor()
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

        def finished():
            """Row by row; a row needs its successor's text and fingerprint."""
            before = ready = None
            for batch in batches:
                for bucket, guest, key, pack in zip(*(batch.column(i) for i in range(4))):
                    bucket, guest, key, raw = bucket.as_py(), guest.as_py(), key.as_py(), unpacked(pack.as_py(), opener)
                    if before is not None:
                        chars, own, edited, other = with_edit(before[1], raw, kit)
                        if ready is not None:
                            yield (*ready[0], likeness(ready[1], own))
                        ready = (
                            (
                                before[0], chars, hashlib.sha256(edited).hexdigest(), own.astype(">u2").tobytes().hex(),
                                other.astype(">u2").tobytes().hex(), likeness(own, other),
                            ),
                            own,
                        )
                        before = None
                    if not guest:
                        before = (key, raw)
                    elif ready is not None:
                        yield (*ready[0], likeness(ready[1], printed(raw, kit)))
                        ready = None

        def rows_of(found):
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=list(names))

        held = []
        for row in finished():
            held.append(row)
            if len(held) == 1024:
                yield rows_of(held)
                held = []
        if held:
            yield rows_of(held)

    return streamed.mapInArrow(
        prints,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
