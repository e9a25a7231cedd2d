"""Language of texts and pages by Bayesian evidence fusion.

Evidence: the text (byte trigram likelihoods learnt from labelled documents), the
language the markup declares, the suffix of the address, and the host. What a declared
language or a suffix says of the true one is counted over all pages, with the text's
language as the vote; a host's prior is its own counts smoothed by its domain's, those
by its suffix's, those by the counts of all pages. Every count leaves the page itself
out. Counts are grouped aggregates; their tables are joined back, never collected.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import ascii_lower, shipped, slices, text_bytes

# Labelled rows the text model is learnt from, at most.
FIT_ROWS = 4_000

GRAM_BITS = 16

# Trigrams of a text are not independent: a text counts as this many at most.
MOST_GRAMS = 60.0

# Weight of the wider group's shares in a narrower group, in pages.
SMOOTHING = 5.0

TAGS = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"


def gram_numbers(data: np.ndarray) -> np.ndarray:
    """A number below 2**GRAM_BITS for the three bytes from each place but the last two."""
    with np.errstate(over="ignore"):
        three = data[:-2].astype(np.uint32) << 16 | data[1:-1].astype(np.uint32) << 8 | data[2:]
        return (three * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)


class TextModel:
    """Log likelihoods of trigrams per language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        shares = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        self.logs = np.ascontiguousarray(np.log(shares).T.astype(np.float32))

    def likelihoods(self, column: pa.Array) -> np.ndarray:
        """Tempered log likelihoods, a row per text; zeros for texts of under three bytes."""
        data, offsets = text_bytes(column)
        lower, out = ascii_lower(), np.zeros((len(offsets) - 1, len(self.languages)))
        for first, last in slices(offsets):
            for row in range(first, last):
                total, count = 0.0, 0
                # Whole texts, a piece at a time.
                for begin in range(offsets[row], offsets[row + 1], 1 << 18):
                    grams = gram_numbers(lower[data[begin : min(offsets[row + 1], begin + (1 << 18) + 2)]])
                    seen = np.bincount(grams) if len(grams) > 1 << GRAM_BITS else None
                    total = total + (self.logs[grams].sum(axis=0, dtype=float) if seen is None else seen @ self.logs[: len(seen)])
                    count += len(grams)
                if count:
                    out[row] = total * (min(count, MOST_GRAMS) / count)
        return out


def fitted(docs: DataFrame, text: str = "text", language: str = "lang", doc_id: str = "doc_id") -> TextModel:
    """A model from rows with a language whose crc32(id) mod 4 is not 2; runs when called.

    Of more than FIT_ROWS rows those with the smallest hash of the id serve; their
    trigrams are counted in the tasks.
    """
    usable = docs.where(F.col(language).isNotNull() & (F.crc32(F.col(doc_id).cast("string")) % 4 != 2))
    chosen = usable.select(doc_id).distinct().orderBy(F.xxhash64(doc_id), doc_id).limit(FIT_ROWS)
    # Bounded: FIT_ROWS ids.
    sample = usable.join(F.broadcast(chosen), doc_id).select(F.col(language).alias("language"), F.col(text).alias("text"))

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        lower = ascii_lower()
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for row, name in enumerate(batch.column(0).to_pylist()):
                held = totals.setdefault(name, np.zeros(1 << GRAM_BITS, np.int64))
                for begin in range(offsets[row], offsets[row + 1], 1 << 18):
                    part = lower[data[begin : min(offsets[row + 1], begin + (1 << 18) + 2)]]
                    held += np.bincount(gram_numbers(part), minlength=1 << GRAM_BITS)
        for name, held in totals.items():
            used = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used)), pa.array(used), pa.array(held[used])], names=["language", "gram", "n"]
            )

    # At most 2**GRAM_BITS rows per language.
    rows = sample.mapInArrow(count, "language string, gram bigint, n bigint").groupBy("language", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["language"].unique())
    counts = np.zeros((max(1, len(languages)), 1 << GRAM_BITS))
    for at, name in enumerate(languages):
        own = rows[rows["language"] == name]
        counts[at, own["gram"].to_numpy()] = own["n"]
    return TextModel(languages or ["und"], counts)


def text_logs(frame: DataFrame, model: TextModel, text: str, to: str = "logs") -> DataFrame:
    shared = shipped(frame.sparkSession, model)

    @F.pandas_udf("array<double>")
    def logs(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared()
        for column in columns:
            yield pd.Series(list(known.likelihoods(pa.Array.from_pandas(column, type=pa.string()))))

    return frame.withColumn(to, logs(F.col(text)))


def page_text(html: Column) -> Column:
    """Visible text of a page: no tags, comments, scripts or styles."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), TAGS, " ")


def best(logs: Column, languages: list[str]) -> Column:
    """The likeliest language; the first in order of names among equals."""
    return F.get(F.array(*map(F.lit, languages)), (F.array_position(logs, F.array_max(logs)) - 1).cast("int"))


def posterior(logs: Column) -> Column:
    """Probability of the likeliest entry of a list of logs."""
    return 1 / F.aggregate(logs, F.lit(0.0), lambda total, x: total + F.exp(x - F.array_max(logs)))


def votes(rows: DataFrame, key: str, languages: list[str]) -> DataFrame:
    """Pages per value of the key and text language, as one array per value."""
    counts = F.array(*(F.sum((F.col("vote") == name).cast("double")) for name in languages))
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(counts.alias(f"{key}_votes"))


def page_languages(
    pages: DataFrame, model: TextModel, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(page_id, lang, probability, text_lang, declared, host), one row per page.

    Missing evidence (no html, no text, no declaration, no address) says nothing; with none
    at all the language is the commonest one. Stages the evidence.
    """
    from leafmill.session import stage

    languages = model.languages
    source = pages.select(
        F.col(page_id).alias("page_id"),
        page_text(F.col(html)).alias("text"),
        F.nullif(F.lower(F.regexp_extract(F.col(html), r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1)), F.lit("")).alias("declared"),
        F.nullif(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit("")).alias("host"),
    )
    judged = text_logs(source, model, "text").drop("text")
    parts = F.split("host", r"\.")
    rows = stage(
        judged.withColumns(
            {
                "domain": F.when(F.size(parts) > 1, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(F.col("host")),
                "suffix": F.element_at(parts, -1),
                "vote": F.when(F.array_max("logs") > F.array_min("logs"), best(F.col("logs"), languages)),
            }
        ),
        "language-evidence",
    )
    zeros = F.array(*(F.lit(0.0) for _ in languages))
    own = F.array(*(F.coalesce((F.col("vote") == n).cast("double"), F.lit(0.0)) for n in languages))
    out = rows.withColumn("own", own)
    for key in ("declared", "suffix", "domain", "host"):
        out = out.join(votes(rows, key, languages), key, "left")
    everyone = rows.groupBy().agg(F.array(*(F.sum((F.col("vote") == n).cast("double")) for n in languages)).alias("all")).first()[0]
    world = F.array(*(F.lit(float(v or 0.0)) for v in everyone))

    def without_own(counts: Column) -> Column:
        return F.zip_with(F.coalesce(counts, zeros), "own", lambda a, b: F.greatest(F.coalesce(a, F.lit(0.0)) - b, F.lit(0.0)))

    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0.0), lambda x, y: x + y)

    def smoothed(counts: Column, parent: Column) -> Column:
        left = without_own(counts)
        return F.zip_with(left, parent, lambda a, p: (a + SMOOTHING * p) / (total(left) + SMOOTHING))

    def shares(counts: Column) -> Column:
        left = without_own(counts)
        return F.transform(left, lambda a: (a + 1.0) / (total(left) + len(languages)))

    out = out.withColumn("base", shares(world))
    out = out.withColumn("by_suffix", smoothed(F.col("suffix_votes"), F.col("base")))
    out = out.withColumn("by_domain", smoothed(F.col("domain_votes"), F.col("by_suffix")))
    out = out.withColumn("by_host", smoothed(F.col("host_votes"), F.col("by_domain")))
    out = out.withColumn("by_declared", smoothed(F.col("declared_votes"), F.col("base")))
    # The host's prior holds suffix and domain; a declaration adds its odds against the base.
    fused = F.zip_with(
        F.zip_with("logs", "by_host", lambda l, p: l + F.ln(p)),
        F.zip_with("by_declared", "base", lambda p, b: F.ln(p) - F.ln(b)),
        lambda x, y: x + y,
    )
    out = out.withColumn("fused", fused)
    return out.select(
        "page_id",
        best(F.col("fused"), languages).alias("lang"),
        posterior(F.col("fused")).alias("probability"),
        F.col("vote").alias("text_lang"),
        "declared",
        "host",
    )


def document_languages(docs: DataFrame, model: TextModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang, probability) from the text alone; a text without evidence gets the first
    language and the probability of a guess."""
    judged = text_logs(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model, "text")
    return judged.select("doc_id", best(F.col("logs"), model.languages).alias("lang"), posterior(F.col("logs")).alias("probability"))
