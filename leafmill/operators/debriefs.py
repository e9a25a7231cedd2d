"""Interview transcripts: header, structure by cues, and chunk rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import sentences
from leafmill.functions.typed import to_date
from leafmill.operators.fields import EQUIPMENT_PATTERN, mentions
from leafmill.schemas import CHUNK, STRUCTURED, conform

HEADER_FIELDS = (
    ("interviewee", "Interviewee"),
    ("debrief_date", "Date"),
    ("topic", "Topic"),
    ("interviewer", "Interviewer"),
)

MAX_CUES = 10_000

def cues_from_table(table: DataFrame) -> dict[str, tuple[str, ...]]:
    """Cues from rows (category, cue). A lexicon is small; its size is checked."""
    rows = table.select("category", "cue").distinct().limit(MAX_CUES + 1).collect()
    if len(rows) > MAX_CUES:
        raise ValueError(f"a cue lexicon has at most {MAX_CUES} rows")
    grouped: dict[str, list[str]] = {}
    for row in sorted(rows):
        grouped.setdefault(row["category"], []).append(row["cue"])
    return {category: tuple(cues) for category, cues in grouped.items()}


NOT_WORD = r"[^\p{L}\p{N}]"


def cue_words(cues: Sequence[str]) -> str:
    """Alternatives of the cues; matches nothing if there are none."""
    if not cues:
        return r"[^\s\S]"
    return "(?:" + "|".join(re.escape(c).replace(r"\ ", " ") for c in cues) + ")"


def cue_pattern(cues: Sequence[str]) -> str:
    """A cue as whole words of any script, ignoring case."""
    return rf"(?i)(?:^|{NOT_WORD}){cue_words(cues)}(?:$|{NOT_WORD})"


def parse_header(transcripts: DataFrame, text: str = "transcript") -> DataFrame:
    """Add header columns and ``body``, the text after the first ``---`` line.

    Without such a line there is no header and the body is the whole text.
    """
    parts = F.split(F.col(text), "\n---\n", 2)
    headed = F.size(parts) > 1
    head = F.when(headed, F.get(parts, 0))
    named = {
        name: F.nullif(F.trim(F.regexp_extract(head, rf"(?m)^{label}: (.*)$", 1)), F.lit(""))
        for name, label in HEADER_FIELDS
    }
    named["debrief_date"] = to_date(named["debrief_date"])
    body = F.when(headed, F.btrim(F.get(parts, 1), F.lit("\n "))).otherwise(F.col(text))
    return transcripts.select("*", *[col.alias(name) for name, col in named.items()], body.alias("body"))


def structure(
    transcripts: DataFrame,
    cues: Mapping[str, Sequence[str]],
    text: str = "transcript",
    equipment: str = EQUIPMENT_PATTERN,
    topic: Column | None = None,
) -> DataFrame:
    """Add ``structured`` (schemas.STRUCTURED): sentences sorted into categories by
    cue, decisions with their rationale. Categories without a hit are empty arrays.

    The rationale is the clause from the first cue on in the decision's sentence,
    else the next sentence if that one starts with a cue.
    """
    why = cue_words(cues.get("rationale", ()))
    clause = rf"(?i)(?:^|{NOT_WORD})({why}(?:{NOT_WORD}.*)?)$"
    opening = rf"(?i)^{why}(?:$|{NOT_WORD})"
    empty = F.array().cast("array<string>")
    with_parts = transcripts.withColumn("_sentences", F.coalesce(sentences(F.col(text)), empty))
    said = F.col("_sentences")

    def category(name: str) -> Column:
        pattern = cue_pattern(cues.get(name, ()))
        return F.filter(said, lambda s: s.rlike(pattern))

    def rationale(sentence: Column, at: Column) -> Column:
        following = F.get(F.col("_sentences"), at + 1)
        same = F.regexp_extract(sentence, clause, 1)
        after = F.when(following.rlike(opening), following)
        return F.coalesce(F.nullif(same, F.lit("")), after)

    decided = cue_pattern(cues.get("decisions", ()))
    pairs = F.transform(
        said,
        lambda s, i: F.struct(s.alias("decision"), rationale(s, i).alias("rationale")),
    )
    topics = empty if topic is None else F.array_compact(F.array(topic))
    structured = F.struct(
        topics.alias("topics"),
        F.coalesce(mentions(F.col(text), equipment), empty).alias("equipment_mentioned"),
        F.filter(pairs, lambda p: p["decision"].rlike(decided)).alias("decisions"),
        category("failure_modes").alias("failure_modes"),
        category("cross_references").alias("cross_references"),
        category("handshake_relationships").alias("handshake_relationships"),
    )
    return with_parts.withColumn("structured", structured.cast(STRUCTURED)).drop("_sentences")


def debrief_chunks(transcripts: DataFrame) -> DataFrame:
    """One chunk row per transcript, whatever its length.

    A further part of a long transcript keeps its part number as page and in its id.
    """
    part = F.coalesce(F.col("part"), F.lit(1)) if "part" in transcripts.columns else F.lit(1)
    more = F.when(part > 1, F.concat(F.lit("_"), part.cast("string"))).otherwise(F.lit(""))
    return conform(
        transcripts,
        CHUNK,
        {
            "chunk_id": F.concat(F.lit("debrief_"), F.col("debrief_id"), more),
            "doc_id": F.col("debrief_id"),
            "source_kind": F.lit("debrief"),
            "page_number": part,
            "chunk_index": F.lit(0),
            "chunk_text": F.col("transcript"),
        },
    )


def with_prompt(frame: DataFrame, prompt: str, text: str, name: str = "prompt") -> DataFrame:
    """Prompt text before the row's text. A literal needs no quote escaping."""
    return frame.withColumn(name, F.concat(F.lit(prompt), F.col(text)))
