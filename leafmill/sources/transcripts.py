"""Transcripts from turn rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.columns import path_id
from leafmill.operators.order import with_positions

TURNS_PER_PART = 1000


def assemble_transcripts(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    turns_per_part: int = TURNS_PER_PART,
    prefix: str = "/transcripts/",
) -> DataFrame:
    """Conversations as files {prefix}{conversation}/{part}, turns in order, one line
    per turn.

    Every conversation is cut into parts of ``turns_per_part`` turns, counted by position
    and not by turn number; each part is a file with an id of its own. So no group grows
    beyond that bound and no turn is lost. A turn delivered twice counts once. The turns
    are staged when this is called.
    """
    line = F.concat_ws(": ", F.col(role), F.coalesce(F.col(text), F.lit("")))
    lines = turns.select(F.col(conversation).alias("of"), F.col(turn).alias("at"), line.alias("line")).distinct()
    placed = with_positions(lines, ["of"], ["at", "line"], "place")
    part = (F.floor(F.col("place") / F.lit(turns_per_part)) + 1).cast("int")
    ordered = F.array_sort(F.collect_list(F.struct("place", "line")))
    path = F.concat(F.lit(prefix), F.col("of").cast("string"), F.lit("/"), F.col("part").cast("string"))
    return (
        placed.groupBy("of", part.alias("part"))
        .agg(F.array_join(F.transform(ordered, lambda t: t["line"]), "\n").alias("transcript"))
        .select(path_id(path).alias("debrief_id"), path.alias("source_path"), "part", "transcript")
    )
