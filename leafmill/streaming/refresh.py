"""Incremental consolidation: bring pages, documents and chunks up to date when some
documents arrive or change, without redoing the rest.

A change to a table is a pair: keys whose rows go, and rows that come. Only changes
are written per run; reading applies them in order to the last full version, and
every few runs a full version is written anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.operators.chunks import document_chunks
from leafmill.operators.consolidate import attach_fields_inline
from leafmill.operators.fields import SUBSTATION_RULES, extract_fields, substation_gate
from leafmill.operators.pages import PAGE_KEY, assemble_pages, canonical_copies
from leafmill.schemas import PAGE
from leafmill.session import stage

# Fields that the document table carries on from extraction.
DOCUMENT_FIELDS = ("substation_name", "voltage_class_kv", "equipment_ids", "study_date", "approving_engineer")

TABLES = ("pages", "documents", "chunks")

# Runs between full versions.
FULL_EVERY = 16


# Folders that the documents of a version are dealt into by content hash.
HASH_BUCKETS = 256

# What decides on copies; a page's text does not.
NARROW = (*PAGE_KEY, "content_hash")


def hash_bucket(content_hash: Column) -> Column:
    return F.pmod(F.xxhash64(content_hash), F.lit(HASH_BUCKETS)).cast("int")


@dataclass(frozen=True)
class Corpus:
    """Pages of all files; documents without copies; chunks of the documents.

    ``stored``: the documents with the folder they lie in (``hash_bucket``), if they do.
    """

    pages: DataFrame
    documents: DataFrame
    chunks: DataFrame
    stored: DataFrame | None = None

    def texts(self, hashes: DataFrame) -> DataFrame:
        """content_hash, page_text of the hashes that documents have: every hash of a page has
        one there. Of stored documents only the folders of these hashes are read."""
        source = self.documents
        if self.stored is not None:
            # At most HASH_BUCKETS numbers.
            folders = hashes.select(hash_bucket(F.col("content_hash")).alias("b")).distinct().collect()
            source = self.stored.where(F.col("hash_bucket").isin([r["b"] for r in folders]))
        met = source.select("content_hash", "page_text").join(hashes, "content_hash", "left_semi")
        return met.dropDuplicates(["content_hash"])


@dataclass(frozen=True)
class Change:
    """Rows with these keys go, these rows come."""

    gone: DataFrame
    come: DataFrame

    def apply(self, table: DataFrame) -> DataFrame:
        kept = table.join(self.gone, self.gone.columns, "left_anti")
        return kept.select(*table.columns).unionByName(self.come.select(*table.columns))


def with_fields(canonical: DataFrame) -> DataFrame:
    """Canonical pages with their accepted fields."""
    return attach_fields_inline(extract_fields(canonical, SUBSTATION_RULES), substation_gate(), DOCUMENT_FIELDS)


def consolidate(pages: DataFrame) -> DataFrame:
    return with_fields(canonical_copies(pages))


def full_corpus(pages: DataFrame) -> Corpus:
    documents = consolidate(pages)
    return Corpus(pages, documents, document_chunks(documents))


def corpus_changes(before: Corpus, arrived: DataFrame, documents: DataFrame | None = None) -> dict[str, Change]:
    """What the pages of new or changed documents change in each table.

    ``documents`` names (doc_id) all documents that arrived; one without pages is empty
    or removed, and what was there of it goes. By default those that have pages.

    A page's fate depends only on pages with its content hash. So only hashes that
    the arriving documents have, or had, are decided again, and by narrow columns: of the
    pages before, no text is read. The text of a page that becomes canonical comes from
    an arriving page with its hash, or from the document that had it.
    """
    documents = (arrived if documents is None else documents).select("doc_id").distinct()
    keys, arrived_keys = before.pages.select(*NARROW), arrived.select(*NARROW)
    had = keys.join(documents, "doc_id", "left_semi").select("content_hash")
    touched = stage(had.unionByName(arrived.select("content_hash")).distinct(), "touched-hashes")
    rest = keys.join(touched, "content_hash", "left_semi").join(documents, "doc_id", "left_anti")
    canonical = canonical_copies(rest.select(*NARROW).unionByName(arrived_keys))
    here = arrived.select("content_hash", "page_text").dropDuplicates(["content_hash"])
    moved = stage(touched.join(arrived.select("content_hash"), "content_hash", "left_anti"), "moved-hashes")
    texts = here.unionByName(before.texts(moved))
    decided = with_fields(canonical.join(texts, "content_hash").select(*PAGE_KEY, "page_text", "content_hash"))
    stale = before.documents.select("content_hash", "doc_id", "page_number").join(touched, "content_hash", "left_semi")
    return {
        "pages": Change(documents, arrived),
        "documents": Change(touched, decided),
        "chunks": Change(stale.select("doc_id", "page_number").distinct(), document_chunks(decided)),
    }


def refresh_corpus(before: Corpus, arrived: DataFrame, documents: DataFrame | None = None) -> Corpus:
    """The corpus after the pages of new, changed, emptied or removed documents arrived."""
    changes = corpus_changes(before, arrived, documents)
    return Corpus(*[changes[name].apply(getattr(before, name)) for name in TABLES])


def _write(frame: DataFrame, name: str, path: str) -> None:
    """Documents lie in folders by content hash, so that a batch reads those of its hashes."""
    if name != "documents":
        frame.write.mode("overwrite").parquet(path)
        return
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64("content_hash", F.lit(1)), F.lit(-(-parts // HASH_BUCKETS)))
    dealt = frame.withColumn("hash_bucket", hash_bucket(F.col("content_hash"))).repartition(parts, "hash_bucket", spread)
    dealt.sortWithinPartitions("hash_bucket").write.mode("overwrite").partitionBy("hash_bucket").parquet(path)


def _write_full(corpus: Corpus, root: str, version: int) -> None:
    for name in TABLES:
        _write(getattr(corpus, name), name, f"{root}/v{version}/full/{name}")


def _write_changes(changes: dict[str, Change], root: str, version: int) -> None:
    for name, change in changes.items():
        change.gone.write.mode("overwrite").parquet(f"{root}/v{version}/gone/{name}")
        _write(change.come, name, f"{root}/v{version}/come/{name}")


def _is_full(version: int) -> bool:
    return (version - 1) % FULL_EVERY == 0


def read_corpus(spark: SparkSession, root: str, version: int) -> Corpus:
    """A version: the last full one, and the changes since, applied in one step.

    A row stands if no later version takes its key away, so one join with the last
    version that touched each key does for all of them.
    """
    base = version - (version - 1) % FULL_EVERY
    later = range(base + 1, version + 1)

    def part(kind: str, name: str, at: int) -> DataFrame:
        path = f"{root}/v{at}/{kind}/{name}"
        reader = spark.read
        if name == "documents" and kind != "gone":
            # Named, since a version without documents has no folder to tell it from.
            reader = reader.schema(document_schema(spark))
        return reader.parquet(path).withColumn("_version", F.lit(at))

    def read(name: str) -> DataFrame:
        full = part("full", name, base)
        if not later:
            return full.drop("_version")
        gone = reduce(DataFrame.unionByName, [part("gone", name, at) for at in later])
        keys = [c for c in gone.columns if c != "_version"]
        last = gone.groupBy(*keys).agg(F.max("_version").alias("_last"))
        rows = reduce(DataFrame.unionByName, [full, *[part("come", name, at) for at in later]])
        stands = F.col("_last").isNull() | (F.col("_version") >= F.col("_last"))
        return rows.join(last, keys, "left").where(stands).select(*[c for c in full.columns if c != "_version"])

    pages, stored, chunks = [read(name) for name in TABLES]
    return Corpus(pages, stored.drop("hash_bucket"), chunks, stored)


def document_schema(spark: SparkSession) -> T.StructType:
    """Schema of stored documents."""
    pages = spark.createDataFrame([], PAGE)
    return consolidate(pages).withColumn("hash_bucket", hash_bucket(F.col("content_hash"))).schema


def _versions(spark: SparkSession, root: str) -> Sequence[int]:
    """Finished versions. Each leaves a marker when all its parts are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/done")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    return sorted(int(entry.getPath().getName()) for entry in files.listStatus(path))


def current_corpus(spark: SparkSession, root: str) -> Corpus | None:
    done = _versions(spark, root)
    return read_corpus(spark, root, done[-1]) if done else None


def _check_owner(spark: SparkSession, root: str, checkpoint: str, batch_id: int) -> None:
    """A corpus grows from one checkpoint only: with another, batch numbers would start
    again and mix new versions with old ones."""
    done = _versions(spark, root)
    if not done:
        return
    owner = spark.read.parquet(f"{root}/done/{done[-1]}").first()["checkpoint"]
    if owner != checkpoint or done[-1] not in (batch_id, batch_id + 1):
        raise ValueError(f"{root} has version {done[-1]} from checkpoint {owner}, not from batch {batch_id} of {checkpoint}")


def refresh_from_stream(
    arriving: DataFrame, root: str, checkpoint: str, elements: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Rows of a stream into a versioned corpus below ``root``, then stop.

    The rows are element rows, or, with a function ``elements`` that makes these, files
    (doc_id and what the function reads). Only the second form sees that a document is
    now empty: a file without elements takes the document away.

    Micro-batch n turns version n into version n + 1 and then marks it done. A batch
    that is repeated after a failure starts from version n again, so nothing is
    applied twice; a root that another checkpoint has written is refused. The pages of
    a batch are staged once for all tables. A document's elements must arrive in one
    batch, which holds when elements are made from its file in the same stream.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, batch_id + 1
        _check_owner(spark, root, checkpoint, batch_id)
        arrived = stage(assemble_pages(elements(batch) if elements else batch), "arrived-pages")
        documents = stage(batch.select("doc_id").distinct(), "arrived-documents")
        if batch_id == 0:
            _write_full(full_corpus(arrived), root, version)
        else:
            before = read_corpus(spark, root, batch_id)
            if _is_full(version):
                _write_full(refresh_corpus(before, arrived, documents), root, version)
            else:
                _write_changes(corpus_changes(before, arrived, documents), root, version)
        marker = spark.range(1).select(F.lit(checkpoint).alias("checkpoint"))
        marker.write.mode("overwrite").parquet(f"{root}/done/{version}")

    query = (
        arriving.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
