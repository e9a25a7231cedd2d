"""Pre-tokens of texts, in portions of bounded number."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

# Characters up to which a text's pre-tokens are listed at once.
LISTED_CHARS = 1 << 20

PORTION = 1 << 16


def portions(matcher, text: str) -> Iterator[list[str]]:
    """The matches of a compiled pattern in order, as lists of at most about a million."""
    if len(text) <= LISTED_CHARS:
        yield matcher.findall(text)
        return
    matches = matcher.finditer(text)
    while portion := [m.group() for m in islice(matches, PORTION)]:
        yield portion
