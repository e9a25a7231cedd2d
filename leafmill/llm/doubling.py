"""Repeated word windows by level-wise doubling.

Windows are compared at a short length first; only what repeats there is compared at twice
that length, and so on up to the length wanted, or until nothing survives. Longer windows
than that cover no further words.

Not every short window is tried: the leftmost smallest hash among the shortest windows
inside a full window is its anchor, so equal full windows have equal anchors at equal
distances. At each length a full window is tried by the sub-window of that length that
begins at its anchor, or as far right as fits. Neighbours share anchors, so the first
length tries about one window in eight. Neighbours with one anchor form a block; of equal
blocks all but the first are done at once, and only the first one's windows reach the
last length.

Texts lie in slices of about two megabytes in a table bucketed by slice, which is read in
place in every round. A slice asks about each of its hashes once: hashes go, sorted, to the
task of their bucket, which answers with a bit per hash in the same order (another slice
has it too; or, for blocks and last windows, an earlier one has it). So a window
that many documents share costs a row per slice, and no positions travel until the last
length. Words are known by 64-bit hashes, blocks and last windows by 128 bits.
"""

from __future__ import annotations

import uuid
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import letters, mixed, powers, slices, space_table, span_hashes, text_bytes, word_spans
from leafmill.llm.repeats import window_minima
from leafmill.session import stage, staging_path

LENGTH = 20
SHORTEST = 5

SLICE_BYTES = 1 << 21

# Bytes of text, and last windows, behind one bucket of hashes.
BUCKET_BYTES = 1 << 26
BUCKET_WINDOWS = 1 << 20

ASKED, BLOCKS, WINDOWS = range(3)


def levels(length: int, shortest: int) -> list[int]:
    """Lengths tried: ``length`` halved while it stays whole and at least ``shortest``, ascending."""
    out = [length]
    while out[0] % 2 == 0 and out[0] // 2 >= shortest:
        out.insert(0, out[0] // 2)
    if len(out) < 2:
        raise ValueError("length must be even and at least twice the shortest length")
    return out


def sliced(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(slice, ids, ties, ends, size, body): whole texts side by side, in a table bucketed by slice.

    Texts of a slice ascend by id, null ids last, then by a hash of the text (``ties``). A
    longer text stands alone.
    """
    spark = docs.sparkSession

    def gather(batches):
        import xxhash
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            ids = batch.column(0).to_pylist()
            for first, last in slices(offsets, SLICE_BYTES):
                rows = []
                for k in range(first, last):
                    raw = data[offsets[k] : offsets[k + 1]].data
                    rows.append((ids[k] is None, ids[k] or 0, xxhash.xxh3_64_intdigest(raw), k))
                rows.sort()
                body = b"".join(data[offsets[k] : offsets[k + 1]].data for *_, k in rows)
                sizes = np.array([offsets[k + 1] - offsets[k] for *_, k in rows], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([[ids[k] for *_, k in rows]], pa.list_(pa.int64())),
                        pa.array([np.array([tie for _, _, tie, _ in rows], np.uint64).view(np.int64)], pa.list_(pa.int64())),
                        pa.array([np.cumsum(sizes)], pa.list_(pa.int64())),
                        pa.array([len(body)]),
                        pa.array([press.compress(body)], pa.binary()),
                    ],
                    names=["ids", "ties", "ends", "size", "body"],
                )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("i"), F.col(f"`{text}`").alias("t")).mapInArrow(
        gather, "ids array<bigint>, ties array<bigint>, ends array<bigint>, size bigint, body binary"
    )
    # Spread by a number of no meaning but the slice's; equal numbers in a repeated task.
    numbered = found.withColumn("slice", F.monotonically_increasing_id()).repartition(parts, "slice")
    name = f"leafmill_slices_{uuid.uuid4().hex}"
    numbered.write.bucketBy(parts, "slice").option("path", staging_path(spark, "slices")).saveAsTable(name)
    table = spark.table(name)
    # The frame keeps files and buckets; the name is not needed again.
    spark.sql(f"DROP TABLE {name}")
    return table


class Slice:
    """Words, windows and anchors of one slice, and what the answers so far say of them."""

    def __init__(self, row: dict, opener, kit: tuple, length: int, shortest: int):
        self.ids, self.ties, self.length = row["ids"], row["ties"], length
        self.data = np.frombuffer(opener.decompress(row["body"]) if row["size"] else b"", np.uint8)
        self.offsets = np.concatenate([[0], np.array(row["ends"], np.int64)])
        self.begins, self.ends, self.counts = word_spans(self.data, self.offsets, space_table())
        self.kit, self.shortest = kit, shortest

    def hash_words(self) -> None:
        """Running sums of word hashes, valid starts and their anchors."""
        words = span_hashes(self.data, self.begins, self.ends, self.kit[:3])
        n = len(words)
        ladder = self.kit[3]
        if len(ladder[0]) <= n:
            ladder[:] = powers(2 * n + 1)
        self.up, self.down = ladder
        sums = np.zeros((2, n + 1), np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(words * self.up[:n], out=sums[0, 1:])
            np.cumsum(mixed(words ^ np.uint64(0xA0761D6478BD642F)) * self.up[:n], out=sums[1, 1:])
        self.sums = sums
        last = np.cumsum(self.counts)
        ends = np.repeat(last, self.counts)
        self.starts = np.flatnonzero(np.arange(n) + self.length <= ends)
        if len(self.starts):
            low = np.uint64((1 << 32) - 1)
            at = np.arange(n - self.shortest + 1)
            keys = self.hashes(at, at + self.shortest)
            least = window_minima((keys & ~low) | at.astype(np.uint64), self.length - self.shortest + 1)
            self.anchors = (least[self.starts] & low).astype(np.int64)
        else:
            self.anchors = self.starts
        self.alive = np.ones(len(self.starts), bool)
        self.later = np.zeros(len(self.starts), bool)

    def hashes(self, begins: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        """A hash of the words between two places, wherever they lie."""
        with np.errstate(over="ignore"):
            value = (self.sums[which][ends] - self.sums[which][begins]) * self.down[begins]
            return mixed(value + (ends - begins).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def tried(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes that live windows are tried by at a length, which of them occur
        twice right here, and each live window's place among them."""
        rows = np.flatnonzero(self.alive)
        places, of_place = np.unique(np.minimum(self.anchors[rows], self.starts[rows] + self.length - level), return_inverse=True)
        hashes, of_hash, counts = np.unique(self.hashes(places, places + level), return_inverse=True, return_counts=True)
        return hashes, counts > 1, of_hash[of_place]

    def firsts(self, begins: np.ndarray, ends: np.ndarray):
        """Distinct word runs by 128 bits: hash pairs in order, the first run of each, and each run's class."""
        one, two = self.hashes(begins, ends, 0), self.hashes(begins, ends, 1)
        order = np.lexsort((np.arange(len(one)), two, one))
        one, two = one[order], two[order]
        new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]) if len(one) else np.zeros(0, bool)
        member = np.empty(len(one), np.int64)
        member[order] = np.cumsum(new) - 1
        return one[new], two[new], order[new], member

    def blocks(self):
        """First and last start (as places in ``starts``) of runs that are live and share an anchor."""
        rows = np.flatnonzero(self.alive)
        if not len(rows):
            return rows, rows
        new = np.concatenate([[True], (np.diff(self.starts[rows]) != 1) | (np.diff(self.anchors[rows]) != 0)])
        ends = np.concatenate([np.flatnonzero(new)[1:], [len(rows)]]) - 1
        return rows[new], rows[ends]

    def block_runs(self):
        first, last = self.blocks()
        return first, last, self.firsts(self.starts[first], self.starts[last] + self.length)

    def settle_blocks(self, earlier: np.ndarray) -> None:
        """Windows of blocks that are not the first of their kind are later copies, and done."""
        first, last, (_, _, heads, member) = self.block_runs()
        gone = earlier[member]
        own = np.ones(len(first), bool)
        own[heads] = False
        gone = gone | own
        marks = np.zeros(len(self.starts) + 1, np.int64)
        np.add.at(marks, first[gone], 1)
        np.add.at(marks, last[gone] + 1, -1)
        done = np.cumsum(marks[:-1]) > 0
        self.later |= done
        self.alive &= ~done

    def window_runs(self):
        rows = np.flatnonzero(self.alive)
        return rows, self.firsts(self.starts[rows], self.starts[rows] + self.length)

    def settle_windows(self, earlier: np.ndarray) -> None:
        rows, (_, _, heads, member) = self.window_runs()
        own = np.ones(len(rows), bool)
        own[heads] = False
        self.later[rows] = earlier[member] | own

    def located(self, one, two, places) -> np.ndarray:
        """Hash pairs with their documents' ids and ties, and the starts: five words each."""
        doc = np.searchsorted(np.cumsum(self.counts), places, side="right")
        ids = np.array([(1 << 64) - 1 if i is None else i + (1 << 63) for i in self.ids], np.uint64)
        ties = np.array(self.ties, np.int64).view(np.uint64)
        return np.stack([one, two, ids[doc], ties[doc], places.astype(np.uint64)])

    def covered(self) -> np.ndarray:
        """A flag per word: some window over it is a later copy."""
        marks = np.zeros(len(self.begins) + 1, np.int64)
        at = self.starts[self.later]
        marks[at] += 1
        np.subtract.at(marks, at + self.length, 1)
        return np.cumsum(marks[:-1]) > 0

    def without(self, gone: np.ndarray):
        """(words, words removed, remaining words joined by one space) of each text."""
        keep = np.flatnonzero(~gone)
        sizes = self.ends[keep] - self.begins[keep] + 1
        ends = np.cumsum(sizes)
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[keep] - (ends - sizes), sizes)
        joined = np.concatenate([self.data, np.zeros(1, np.uint8)])[source]
        joined[ends - 1] = 32
        raw = joined.tobytes()
        last = np.cumsum(self.counts)
        cuts = np.searchsorted(keep, np.concatenate([[0], last])).tolist()
        places = np.concatenate([[0], ends]).tolist()
        for k, n in enumerate(self.counts.tolist()):
            a, b = cuts[k], cuts[k + 1]
            yield n, n - (b - a), raw[places[a] : places[b] - 1] if b > a else b""


def answered(masks: dict[int, bytes], hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bits that came back for sorted hashes."""
    edges = cuts_of(hashes, buckets)
    out = [np.zeros(0, np.uint8)]
    for k in np.flatnonzero(np.diff(edges)).tolist():
        out.append(np.unpackbits(np.frombuffer(masks[k], np.uint8), count=int(edges[k + 1] - edges[k])))
    return np.concatenate(out).astype(bool)


def cuts_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes: buckets are equal ranges of the upper half."""
    bounds = (np.arange(buckets + 1, dtype=np.float64) * (2.0**32 / buckets)).astype(np.uint64)
    bounds[-1] = 1 << 32
    return np.searchsorted(hashes >> np.uint64(32), bounds, side="left")


def replayed(row: dict, opener, kit, sizes: list[int], rounds: list[int]) -> Slice:
    """The slice with the answers of all rounds so far: ``rounds`` has their numbers of buckets."""
    out = Slice(row, opener, kit, sizes[-1], sizes[0])
    out.hash_words()
    masks: dict = {}
    for m in row["answers"] or ():
        masks.setdefault((m["round"], m["kind"]), {})[m["bucket"]] = m["mask"]
    for k, buckets in enumerate(rounds):
        if k == len(sizes) - 1:
            out.settle_windows(answered(masks.get((k, WINDOWS), {}), out.window_runs()[1][0], buckets))
            continue
        hashes, twice, member = out.tried(sizes[k])
        seen = twice | answered(masks.get((k, ASKED), {}), hashes, buckets)
        alone = np.flatnonzero(out.alive)[~seen[member]]
        if k == len(sizes) - 2:
            # Blocks are of the windows that lived when they were asked about.
            out.settle_blocks(answered(masks.get((k, BLOCKS), {}), out.block_runs()[2][0], buckets))
        out.alive[alone] = False
    return out


def asked(held: DataFrame, sizes: list[int], rounds: list[int], buckets: int) -> DataFrame:
    """(slice, kind, bucket, entries): the questions of the next round."""

    def ask(batches):
        import zstandard

        opener, kit = zstandard.ZstdDecompressor(), (letters(), *powers(), [*powers(1)])
        for batch in batches:
            for row in batch.to_pylist():
                part = replayed(row, opener, kit, sizes, rounds)
                now, sets = len(rounds), []
                if now < len(sizes) - 1:
                    hashes = part.tried(sizes[now])[0]
                    sets.append((ASKED, hashes, hashes[None, :]))
                if now == len(sizes) - 2:
                    first, _, (one, two, heads, _) = part.block_runs()
                    sets.append((BLOCKS, one, part.located(one, two, part.starts[first[heads]])))
                if now == len(sizes) - 1:
                    rows, (one, two, heads, _) = part.window_runs()
                    sets.append((WINDOWS, one, part.located(one, two, part.starts[rows[heads]])))
                out = []
                for kind, hashes, words in sets:
                    edges = cuts_of(hashes, buckets)
                    for k in np.flatnonzero(np.diff(edges)).tolist():
                        out.append((kind, k, np.ascontiguousarray(words[:, edges[k] : edges[k + 1]]).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["slice"]] * len(out), pa.int64()),
                        pa.array([x[0] for x in out], pa.int32()),
                        pa.array([x[1] for x in out], pa.int32()),
                        pa.array([x[2] for x in out], pa.binary()),
                    ],
                    names=["slice", "kind", "bucket", "entries"],
                )

    return held.mapInArrow(ask, "slice bigint, kind int, bucket int, entries binary")


def answers(questions: DataFrame, number: int) -> DataFrame:
    """(slice, round, kind, bucket, mask, zeros): a bit per entry. Staged; it is small.

    One bucket at a time is held: the buckets are as many as the texts need.
    """
    parts = int(questions.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def answer(batches):
        held, last = [], None

        def flush():
            kind, bucket = last
            fields = 1 if kind == ASKED else 5
            tables = [np.frombuffer(raw, np.uint64).reshape(fields, -1) for _, raw in held]
            counts = np.array([t.shape[1] for t in tables])
            words = np.concatenate(tables, axis=1)
            if kind == ASKED:
                order = np.argsort(words[0])
                ordered = words[0][order]
                same = ordered[1:] == ordered[:-1]
                bits = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            else:
                slice_of = np.repeat(np.array([s for s, _ in held], np.int64), counts)
                one, two, ids, ties, places = words
                order = np.lexsort((places, slice_of, ties, ids, two, one))
                one, two = one[order], two[order]
                bits = np.concatenate([[False], (one[1:] == one[:-1]) & (two[1:] == two[:-1])])
            flags = np.empty(len(order), bool)
            flags[order] = bits
            masks = [(np.packbits(part).tobytes(), int(len(part) - part.sum())) for part in np.split(flags, np.cumsum(counts)[:-1])]
            n = len(held)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _ in held], pa.int64()),
                    pa.array([number] * n, pa.int32()),
                    pa.array([kind] * n, pa.int32()),
                    pa.array([bucket] * n, pa.int32()),
                    pa.array([m for m, _ in masks], pa.binary()),
                    pa.array([z for _, z in masks], pa.int64()),
                ],
                names=["slice", "round", "kind", "bucket", "mask", "zeros"],
            )

        for batch in batches:
            for s, kind, bucket, raw in zip(*(batch.column(i) for i in range(4))):
                key = (kind.as_py(), bucket.as_py())
                if key != last and held:
                    yield flush()
                    held = []
                last = key
                held.append((s.as_py(), raw.as_py()))
        if held:
            yield flush()

    dealt = questions.repartition(parts, "kind", "bucket").sortWithinPartitions("kind", "bucket")
    return stage(dealt.mapInArrow(answer, "slice bigint, round int, kind int, bucket int, mask binary, zeros bigint"), "doubling-answers")


def with_answers(table: DataFrame, found: list[DataFrame]) -> DataFrame:
    """Slices with all answers to them; only the answers are exchanged."""
    if not found:
        return table.withColumn("answers", F.lit(None).cast("array<struct<round:int,kind:int,bucket:int,mask:binary>>"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    listed = every.groupBy("slice").agg(F.collect_list(F.struct("round", "kind", "bucket", "mask")).alias("answers"))
    return table.join(listed.hint("shuffle_hash"), "slice", "left")


def without_later_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, shortest: int = SHORTEST
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): texts without words that a later copy of a window covers.

    A row per row of ``docs``. Words are runs without space and control characters 9 to
    13. A window is ``length`` words of one text; it is a later copy if its words also start
    earlier: in a smaller doc_id, or further left in the same text. Windows are judged on
    the input. kept has the remaining words joined by one space.

    Null texts read as empty; texts shorter than a window keep all words. Rows without
    an id come after all others; rows that share an id follow by a hash of their text, and
    of equal rows one is first. An empty table gives no rows. Other columns, whatever
    their names, are not read. Stages tables, one of them with the texts, compressed.
    """
    sizes = levels(length, shortest)
    spark = docs.sparkSession
    table = sliced(docs, doc_id, text)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = table.agg(F.sum("size")).first()[0] or 0
    found, rounds = [], []
    for number in range(len(sizes)):
        buckets = max(2 * parts, ceil(size / BUCKET_BYTES))
        if number == len(sizes) - 1:
            first_blocks = found[-1].where(F.col("kind") == BLOCKS).agg(F.sum("zeros")).first()[0] or 0
            if not first_blocks:
                break  # no candidates survive
            buckets = max(2 * parts, ceil(first_blocks * (length - sizes[0] + 1) / BUCKET_WINDOWS))
        found.append(answers(asked(with_answers(table, found), sizes, rounds, buckets), number))
        rounds.append(buckets)

    def cut(batches):
        import zstandard

        opener, kit = zstandard.ZstdDecompressor(), (letters(), *powers(), [*powers(1)])
        for batch in batches:
            for row in batch.to_pylist():
                part = replayed(row, opener, kit, sizes, rounds)
                rows = list(part.without(part.covered()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], pa.int64()),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2].decode() for r in rows], pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return with_answers(table, found).mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
