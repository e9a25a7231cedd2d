"""Identity, routing and display columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path fragments of the document kinds, first match wins.
KIND_ROUTES = (("/onelines/", "oneline"), ("/studies/", "protection_study"))
UNKNOWN_KIND = "unknown"

SNIPPET_CHARS = 280


def path_id(path: Column) -> Column:
    """Stable identity of a file: SHA-256 of its path."""
    return F.sha2(path, 256)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def route_kind(
    path: Column,
    routes: Sequence[tuple[str, str]] = KIND_ROUTES,
    default: str = UNKNOWN_KIND,
) -> Column:
    """Kind by the first path fragment that occurs; NULL paths get the default."""
    kind = F.lit(default)
    for fragment, name in reversed(list(routes)):
        kind = F.when(path.contains(fragment), F.lit(name)).otherwise(kind)
    return kind


def chunk_key(doc_id: Column, page_number: Column, chunk_index: Column) -> Column:
    """doc_page_chunk; NULL when a part is NULL, so that keys never shift parts."""
    parts = [doc_id, page_number.cast("string"), chunk_index.cast("string")]
    return F.concat(parts[0], F.lit("_"), parts[1], F.lit("_"), parts[2])


def file_name(path: Column, fallback: Column) -> Column:
    """Last path segment, or the fallback where there is none."""
    return F.coalesce(F.nullif(F.element_at(F.split(path, "/"), -1), F.lit("")), fallback)


def snippet(text: Column, chars: int = SNIPPET_CHARS) -> Column:
    return F.substring(text, 1, chars)


def page_suffix(page_number: Column) -> Column:
    """' · pN', or nothing where the page is unknown."""
    return F.coalesce(F.concat(F.lit(" · p"), page_number.cast("string")), F.lit(""))


def citation_title(path: Column, fallback: Column, page_number: Column) -> Column:
    return F.concat(file_name(path, fallback), page_suffix(page_number))


# Fixed value: the scheme left out of shown paths.
SHOWN_WITHOUT = "dbfs:"


def display_path(path: Column, without: str = SHOWN_WITHOUT) -> Column:
    """The path without a leading scheme, once."""
    return F.when(path.startswith(without), F.substring(path, len(without) + 1, 1 << 30)).otherwise(path)


def display_score(score: Column) -> Column:
    return F.format_string("%.3f", score)


def title_case(slug: Column) -> Column:
    return F.initcap(F.replace(slug, F.lit("_"), F.lit(" ")))


def safe_name(name: Column) -> Column:
    return F.lower(F.replace(name, F.lit(" "), F.lit("_")))
