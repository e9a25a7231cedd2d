"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits the features in turn and adds to each a shallow tree on its
bins, fitted to the current residuals; the pairs that reduce the residuals most then get
two-dimensional tables in the same way. What stays is one lookup table per feature and
pair. A score is a sum of table entries, taken for whole batches at once.

Features come from the text alone.
"""

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import shipped

# Labelled rows a model is fitted on, at most; their features are what the driver gets.
FIT_ROWS = 20_000

BINS = 32
PAIR_BINS = 8
ROUNDS = 150
RATE = 0.1
LEAVES = 4
PAIRS = 6
THRESHOLD = 0.7

FEATURES = (
    "words", "word_length", "long_words", "distinct_words", "top_word", "same_next", "upper", "digit", "mark", "odd_mark",
    "odd_end", "bar_words", "sentence_ends", "line_words", "repeated_lines", "wide",
)

# Marks of ordinary prose.
PLAIN = ".,;:?'\"()-"


def features(text: str | None) -> list[float]:
    """The numbers a text is judged by, in order of FEATURES; an empty text gives zeros."""
    text = text or ""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line]
    seen = Counter(text)
    upper = digit = mark = odd = wide = 0
    for char, times in seen.items():
        if char.isupper():
            upper += times
        elif char.isdigit():
            digit += times
        elif not char.isalnum() and not char.isspace():
            mark += times
            odd += times * (char not in PLAIN)
        wide += times * (ord(char) > 127)
    ends = Counter(map(_last, words))
    plain_end = sum(t for c, t in ends.items() if c.isalnum() or c in PLAIN)
    return [
        float(np.log1p(n)),
        (chars - n) / n,
        sum(t for w, t in counts.items() if len(w) > 12) / n,
        len(counts) / n**0.8,
        counts.most_common(1)[0][1] / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        upper / chars,
        digit / chars,
        mark / chars,
        odd / chars,
        1 - plain_end / n,
        counts["|"] / n,
        sum(ends[c] for c in ".?!") / n,
        float(np.log1p(n / max(1, len(lines)))),
        1 - len(set(lines)) / max(1, len(lines)),
        wide / chars,
    ]


def _last(word: str) -> str:
    return word[-1]


def with_features(docs: DataFrame, text: str) -> DataFrame:
    """docs (without text) with an array ``features``."""
    rest = [f for f in docs.schema if f.name != text]
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(rest)) + ", features array<double>"

    def measure(batches):
        for batch in batches:
            last = batch.num_columns - 1
            values = [features(v.as_py()) for v in batch.column(last)]
            columns = [*(batch.column(i) for i in range(last)), pa.array(values, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f"c{i}" for i in range(last)), "features"])

    narrow = docs.select(*(F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(rest)), F.col(text).alias("text"))
    return narrow.mapInArrow(measure, schema).select(*(F.col(f"c{i}").alias(f.name) for i, f in enumerate(rest)), "features")


def tree_values(sums: np.ndarray, weights: np.ndarray, leaves: int) -> np.ndarray:
    """Newton steps of a small tree over ordered bins: best splits until ``leaves`` leaves."""
    total, mass = np.concatenate([[0], np.cumsum(sums)]), np.concatenate([[0], np.cumsum(weights)])
    worth = lambda a, b: (total[b] - total[a]) ** 2 / (mass[b] - mass[a] + 1.0)
    cuts = [0, len(sums)]
    for _ in range(leaves - 1):
        best, place = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            inner = np.arange(a + 1, b)
            if len(inner):
                gain = worth(a, inner) + worth(inner, b) - worth(a, b)
                if gain.max() > best:
                    best, place = gain.max(), int(inner[gain.argmax()])
        if place is None:
            break
        cuts = sorted([*cuts, place])
    out = np.zeros(len(sums))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (total[b] - total[a]) / (mass[b] - mass[a] + 1.0)
    return out


class Model:
    """Bin edges and lookup tables."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        shares = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(rows[:, i], shares)) if len(rows) else np.zeros(0) for i in range(len(FEATURES))]
        self.coarse = [np.unique(e[:: max(1, BINS // PAIR_BINS)]) for e in self.edges]
        positive = float(labels.mean()) if len(labels) else 0.5
        # Classes weigh the same, so a rare class is learnt as well.
        rare = min(max(positive, 1e-3), 1 - 1e-3)
        self.base = 0.0
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if len(rows) and 0 < positive < 1:
            weight = np.where(labels == 1, 0.5 / rare, 0.5 / (1 - rare))
            self._fit(rows, labels.astype(float), weight)

    def _fit(self, rows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
        bins, margin = self._bins(rows, self.edges), np.zeros(len(rows))

        def residuals():
            p = 1 / (1 + np.exp(-margin))
            return weight * (labels - p), weight * p * (1 - p)

        for _ in range(ROUNDS):
            for i, table in enumerate(self.tables):
                first, second = residuals()
                step = RATE * tree_values(
                    np.bincount(bins[:, i], first, len(table)), np.bincount(bins[:, i], second, len(table)), LEAVES
                )
                table += step
                margin += step[bins[:, i]]
        coarse = self._bins(rows, self.coarse)
        wide = [len(e) + 1 for e in self.coarse]
        first, second = residuals()

        def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
            return np.bincount(coarse[:, i] * wide[j] + coarse[:, j], values, wide[i] * wide[j])

        gain = {(i, j): float((grid(i, j, first) ** 2 / (grid(i, j, second) + 1)).sum()) for i, j in combinations(range(len(wide)), 2)}
        self.pairs = sorted(gain, key=lambda p: (-gain[p], p))[:PAIRS]
        self.pair_tables = [np.zeros(wide[i] * wide[j]) for i, j in self.pairs]
        for _ in range(ROUNDS // 3):
            for (i, j), table in zip(self.pairs, self.pair_tables):
                first, second = residuals()
                # A tree on each row of the grid: two-dimensional shallow splits.
                g, h = grid(i, j, first).reshape(wide[i], wide[j]), grid(i, j, second).reshape(wide[i], wide[j])
                step = RATE * np.concatenate([tree_values(a, b, 2) for a, b in zip(g, h)])
                table += step
                margin += step[coarse[:, i] * wide[j] + coarse[:, j]]

    @staticmethod
    def _bins(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, rows[:, i], side="left") for i, e in enumerate(edges)], axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        bins, coarse = self._bins(rows, self.edges), self._bins(rows, self.coarse)
        margin = np.full(len(rows), self.base)
        for i, table in enumerate(self.tables):
            margin += table[bins[:, i]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            margin += table[coarse[:, i] * (len(self.coarse[j]) + 1) + coarse[:, j]]
        return 1 / (1 + np.exp(-margin))


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """A model from labelled rows that are not held out; runs when called.

    Of more than FIT_ROWS rows, those with the smallest hash of the id serve. An id with
    differing labels counts with the larger; null labels and ids are left out.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
    marks = usable.groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("double").alias("__label"))
    chosen = marks.orderBy(F.xxhash64("__id"), "__id").limit(FIT_ROWS)
    # Bounded: FIT_ROWS ids and labels.
    texts = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")).join(F.broadcast(chosen), "__id")
    got = with_features(texts.select("__id", "__label", "text"), "text").toPandas().sort_values("__id", kind="stable")
    rows = np.array(got["features"].tolist(), float).reshape(-1, len(FEATURES))
    return Model(rows, got["__label"].to_numpy())


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with a column ``score``, from 0 to 1; null and empty texts get one as well."""
    shared = shipped(docs.sparkSession, model)

    @F.pandas_udf("double")
    def score(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared()
        for column in columns:
            rows = np.array([features(t) for t in column], float).reshape(-1, len(FEATURES))
            yield pd.Series(known.scores(rows))

    return docs.withColumn("score", score(F.col(text)))
