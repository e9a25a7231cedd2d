"""WARC archives: writing captures as records, and assembling records to captures.

Every capture has a request, a response or revisit, and a metadata record; request and
metadata name the capture in WARC-Concurrent-To. Spark's text writer writes the records:
its line separator is the end of a WARC record. Reading takes whole archive files, cuts
records by their Content-Length, and joins them by record ids to one nested row each.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import maybe_among
from leafmill.session import stage

END = "\r\n\r\n"

# Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 100

# Captures per archive file, below and from the size of a large payload: a file stays
# some tens of megabytes before compression, or a few payloads.
LARGE_PAYLOAD = 1 << 16
CAPTURES = 1000
LARGE_CAPTURES = 8

DATE = "2024-01-01T00:00:00Z"


def record_id(kind: str, page: Column) -> Column:
    """A record id that depends on kind and page (page_id and place, see ``write_archives``), in the form of a UUID."""
    named = F.concat_ws(" ", F.lit(kind), F.coalesce(page["page_id"].cast("string"), F.lit("none")), page["place"].cast("string"))
    digits = F.md5(named)
    parts = [F.substring(digits, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record(kind: Column, identity: Column, url: Column, fields: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """One WARC record without its closing line breaks; fields with null values are left out."""
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), identity),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        *(F.concat(F.lit(f"{name}: "), value) for name, value in fields),
        F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes gzip archives of all pages below ``path``, which must not exist.

    The payload is the html in UTF-8 (null: empty). Of payloads that are equal and have
    LEAST_REVISIT bytes or more, that with the smallest page_id is a response, others are
    revisits and carry no payload. Rows that repeat the smallest page_id, and rows of
    which no equal one has a page_id, are responses. Line breaks in a url become spaces.

    Every row has records of its own. Their ids follow from the page_id; where that is
    null or repeats, also from the row's place in ``pages``, which must then be read from
    files, so that places stay. Other columns are not read; an empty table writes no record.
    Stages the repeated ids.
    """
    read = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\r\n]+", " ").alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("place"),
    )
    repeated = read.groupBy("page_id").agg(F.count("*").alias("rows")).where("rows > 1 OR page_id IS NULL").select("page_id")
    told = maybe_among(read, "page_id", stage(repeated, "warc-repeated"), "repeats")
    rows = told.withColumns({
        "page": F.struct("page_id", F.when(F.col("repeats"), F.col("place")).alias("place")),
        "digest": F.sha2("html", 256),
        "bytes": F.octet_length("html"),
    })
    first = (
        rows.where(F.col("bytes") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min(F.when(F.col("page_id").isNotNull(), F.col("page"))).alias("original"), F.count("*").alias("copies"))
        .where("copies > 1 AND original IS NOT NULL")
        .select("digest", "original")
    )
    joined = rows.join(first, "digest", "left")
    revisit = F.coalesce(F.col("original.page_id") != F.col("page_id"), F.col("original").isNotNull())
    kind = F.when(revisit, "revisit").otherwise("response")
    own = record_id("capture", F.col("page"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
        F.when(revisit, "").otherwise(F.col("html")),
    )
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    refers = F.when(revisit, record_id("capture", F.col("original")))
    profile = F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    asked = F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{END}"))
    about = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    records = F.array(
        record(F.lit("request"), record_id("request", F.col("page")), F.col("url"), [("WARC-Concurrent-To", own)], "application/http; msgtype=request", asked),
        record(kind, own, F.col("url"), [("WARC-Payload-Digest", digest), ("WARC-Refers-To", refers), ("WARC-Profile", profile)], "application/http; msgtype=response", http),
        record(F.lit("metadata"), record_id("metadata", F.col("page")), F.col("url"), [("WARC-Concurrent-To", own)], "application/warc-fields", about),
    )
    for large, captures in ((False, CAPTURES), (True, LARGE_CAPTURES)):
        chosen = joined.where((F.col("bytes") >= LARGE_PAYLOAD) == F.lit(large))
        chosen.select(F.explode(records).alias("value")).write.mode("append").option("lineSep", END).option(
            "compression", "gzip"
        ).option("maxRecordsPerFile", 3 * captures).text(path)


class Stream:
    """Bytes of a gzip file, decompressed as they are read."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.open, self.held = raw, 0, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        if self.open.eof and self.open.unused_data:
            rest = self.open.unused_data
            self.open = zlib.decompressobj(31)
            self.held += self.open.decompress(rest)
            return True
        if self.at >= len(self.raw):
            return False
        self.held += self.open.decompress(self.raw[self.at : self.at + (1 << 16)])
        self.at += 1 << 16
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before the mark, which goes as well; None at the end."""
        while (place := self.held.find(mark)) < 0:
            if not self.more():
                if self.held.strip():
                    raise ValueError("an archive ends inside a record header")
                return None
        out = bytes(self.held[:place])
        del self.held[: place + len(mark)]
        return out

    def take(self, count: int) -> bytes:
        while len(self.held) < count:
            if not self.more():
                raise ValueError("an archive ends inside a record")
        out = bytes(self.held[:count])
        del self.held[:count]
        return out


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of the archives below ``path``, with the payload's size and SHA-256.

    The payload itself comes along if asked for; the block of requests and metadata is a
    string. Broken archives raise an error.
    """
    schema = "record_id string, type string, url string, concurrent_to string, refers_to string, digest string, payload_bytes bigint, payload_sha256 string, block string"
    schema += ", payload binary" if payloads else ""
    names = [part.split()[0] for part in schema.split(", ")]

    def cut(batches):
        import hashlib

        types = [pa.binary() if n == "payload" else pa.int64() if n == "payload_bytes" else pa.string() for n in names]
        for batch in batches:
            for content in batch.column(0):
                stream, rows, size = Stream(content.as_py()), [], 0
                while (head := stream.until(b"\r\n\r\n")) is not None:
                    lines = head.decode("utf-8", "replace").split("\r\n")
                    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
                    block = stream.take(int(fields["Content-Length"]))
                    if stream.take(4) != b"\r\n\r\n":
                        raise ValueError("a record is not closed")
                    kind, payload = fields["WARC-Type"], None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                    digest = fields.get("WARC-Payload-Digest", "").rpartition(":")[2] or None
                    row = [
                        fields["WARC-Record-ID"], kind, fields.get("WARC-Target-URI"), fields.get("WARC-Concurrent-To"),
                        fields.get("WARC-Refers-To"), digest, None if payload is None else len(payload),
                        None if payload is None else hashlib.sha256(payload).hexdigest(),
                        block.decode("utf-8", "replace") if kind in ("request", "metadata") else None,
                    ]
                    rows.append(row + [payload] * payloads)
                    size += len(block)
                    if size >= 1 << 22 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(cut, schema)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: its record, and the request and metadata
    records that are concurrent to it, in order of their ids.

    Records concurrent to no capture are left out. Captures whose ids repeat stay apart
    and get the same concurrent records. ``records`` is read three times: stage it first.
    """
    columns = F.struct("record_id", "url", "block")

    def beside(kind: str, name: str) -> DataFrame:
        rows = records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        return rows.groupBy(F.col("concurrent_to").alias("record_id")).agg(F.sort_array(F.collect_set(columns)).alias(name))

    main = records.where(F.col("type").isin("response", "revisit")).drop("concurrent_to", "block")
    return main.join(beside("request", "requests"), "record_id", "left").join(beside("metadata", "metadata"), "record_id", "left")


def page_rows(assembled: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of assembled captures.

    Size and page of a revisit's payload come from the response it refers to, if that has
    the payload's digest.
    """
    number = F.regexp_extract(F.col("metadata")[0]["block"], r"^page-id: (-?\d+)", 1)
    rows = assembled.withColumn("page", number).select(
        "record_id",
        "type",
        F.coalesce("payload_sha256", "digest").alias("digest"),
        "payload_bytes",
        F.expr("try_cast(page AS BIGINT)").alias("page_id"),
        # A response is joined with itself: null keys would all meet in one task.
        F.coalesce("refers_to", "record_id").alias("refers_to"),
    )
    targets = rows.where("type = 'response'").groupBy(F.col("record_id").alias("refers_to"), "digest").agg(
        F.max("payload_bytes").alias("full_bytes"), F.max("page_id").alias("original")
    )
    return rows.join(targets, ["refers_to", "digest"], "left").select(
        "page_id",
        F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(F.col("type") == "revisit", F.col("original")).alias("refers_to"),
    )
