"""Batch calls of a user's own model. No endpoint client is shipped."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def results_of(call: Callable[[pd.Series], list], texts: pd.Series) -> list[dict]:
    """(value, error) of each text. A batch that fails is halved until the bad text is alone."""
    try:
        values = list(call(texts))
        if len(values) != len(texts):
            raise ValueError("a model call must return one value per text")
        return [{"value": v, "error": None} for v in values]
    except Exception as problem:
        if len(texts) == 1:
            return [{"value": None, "error": f"{type(problem).__name__}: {problem}"}]
        half = len(texts) // 2
        return results_of(call, texts.iloc[:half]) + results_of(call, texts.iloc[half:])


def model_map(
    frame: DataFrame,
    call: Callable[[pd.Series], list],
    text: str,
    returns: str,
    name: str = "result",
) -> DataFrame:
    """Add struct<value:returns, error:string>, Arrow batch by Arrow batch.

    ``call`` gets a batch of texts and returns as many values. If it raises, or returns
    another number, its batch is halved, and each half that fails again, until the bad
    text is alone: value NULL, error set. One bad text among n costs at most about
    2 * log2(n) + 1 calls.
    """
    result = T.StructType().add("value", T.DataType.fromDDL(returns)).add("error", T.StringType())
    schema = T.StructType([*frame.schema.fields, T.StructField(name, result)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = results_of(call, batch[text].reset_index(drop=True)) if len(batch) else []
            yield batch.assign(**{name: pd.Series(rows, index=batch.index, dtype=object)})

    return frame.mapInPandas(run, schema)
