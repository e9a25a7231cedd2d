"""Document text to element rows.

Three adapters with one result (schemas.ELEMENT): plain text by line, HTML by block
tag, and parsed JSON payloads held as VARIANT. Each keeps ``pos``, the element's
place in its document, because page text must not depend on row order. A NULL or
empty element text gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.typed import variant_first
from leafmill.schemas import ELEMENT, conform

LINES_PER_PAGE = 20

BLOCK_MARK = "\u0001"
TYPE_MARK = "\u0002"
HIDDEN_HTML = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<head\b[^>]*>.*?</head>"
# Tags inside a line of text; every other tag ends a block.
INLINE_TAG = r"(?i)</?(?:a|abbr|b|bdi|bdo|cite|code|del|dfn|em|font|i|ins|kbd|mark|q|s|samp|small|span|strong|sub|sup|time|tt|u|var|wbr)(?:[\s/][^>]*)?>"
BLOCK_CLOSE = r"</[A-Za-z][^>]*>"
BLOCK_OPEN = r"<([A-Za-z][A-Za-z0-9]*)[^>]*>"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def _finish(frame: DataFrame) -> DataFrame:
    return conform(frame.where(F.length("element_text") > 0), ELEMENT)


def line_elements(files: DataFrame, text: str = "text", lines_per_page: int = LINES_PER_PAGE) -> DataFrame:
    """One element per non-empty line; a page is a run of ``lines_per_page`` lines."""
    lines = files.select(
        "doc_id", "path", "source_kind", F.posexplode(F.split(F.col(text), "\n")).alias("pos", "element_text")
    )
    return _finish(
        lines.select(
            "*",
            F.col("pos").cast("string").alias("element_id"),
            F.lit("line").alias("element_type"),
            (F.floor(F.col("pos") / F.lit(lines_per_page)) + 1).cast("int").alias("page_number"),
        )
    )


def _block_segments(html: Column) -> Column:
    """Text between block tags; each but the first starts with the tag's name, "text" after an end tag."""
    visible = F.regexp_replace(F.translate(html, BLOCK_MARK + TYPE_MARK, ""), HIDDEN_HTML, "")
    plain = F.regexp_replace(visible, INLINE_TAG, "")
    closed = F.regexp_replace(plain, BLOCK_CLOSE, BLOCK_MARK + "text" + TYPE_MARK)
    opened = F.regexp_replace(closed, BLOCK_OPEN, BLOCK_MARK + "$1" + TYPE_MARK)
    return F.split(F.concat(F.lit("text" + TYPE_MARK), opened), BLOCK_MARK)


def _readable(text: Column) -> Column:
    """White space as single spaces, then the five basic entities; ``&amp;`` last."""
    text = F.trim(F.regexp_replace(text, r"[ \t\r\n\f]+", " "))
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def html_elements(files: DataFrame, html: str = "html") -> DataFrame:
    """All visible text, one element per run between block tags, typed by the tag that
    opens it, or ``text`` after an end tag. Cutting at tags needs no end tag, so unclosed
    paragraphs do not swallow their neighbours. All on page one."""
    segments = files.select(
        "doc_id", "path", "source_kind", F.posexplode(_block_segments(F.col(html))).alias("pos", "segment")
    )
    return _finish(
        segments.select(
            "doc_id",
            "path",
            "source_kind",
            "pos",
            F.col("pos").cast("string").alias("element_id"),
            F.lower(F.substring_index("segment", TYPE_MARK, 1)).alias("element_type"),
            _readable(F.substring_index("segment", TYPE_MARK, -1)).alias("element_text"),
            F.lit(1).alias("page_number"),
        )
    )


def parse_payload(files: DataFrame, json: str) -> DataFrame:
    """JSON text to the VARIANT column ``parsed``; bad JSON becomes NULL."""
    return files.withColumn("parsed", F.try_parse_json(F.col(json)))


def variant_elements(parsed: DataFrame, column: str = "parsed", path: str = "$.document.elements") -> DataFrame:
    """Elements of a parsed payload. Key names differ between parser versions, so
    text is read from ``content`` or ``text`` and the page from ``page_number`` or
    ``page``, else page one. A document without elements gives no rows."""
    each = parsed.select(
        "doc_id",
        "path",
        "source_kind",
        F.posexplode(F.try_variant_get(F.col(column), path, "array<variant>")).alias("pos", "element"),
    )
    element = F.col("element")
    return _finish(
        each.select(
            "doc_id",
            "path",
            "source_kind",
            "pos",
            variant_first(element, ["$.id"], "string").alias("element_id"),
            variant_first(element, ["$.type"], "string").alias("element_type"),
            variant_first(element, ["$.content", "$.text"], "string").alias("element_text"),
            F.coalesce(variant_first(element, ["$.page_number", "$.page"], "int"), F.lit(1)).alias("page_number"),
            F.try_variant_get(element, "$.bbox", "variant").alias("bbox"),
        )
    )


def documents_without_elements(parsed: DataFrame, column: str = "parsed", path: str = "$.document.elements") -> DataFrame:
    """Documents whose payload holds no element list, for the reject table."""
    found = F.size(F.try_variant_get(F.col(column), path, "array<variant>"))
    return parsed.where(F.coalesce(found, F.lit(0)) <= 0).select("doc_id", "path", "source_kind")
