"""Scores of answers, run summaries, run history and regressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.schemas import EVAL_SET, struct_of


def eval_set(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Hand-written questions as a table with a declared schema."""
    return spark.createDataFrame(rows, struct_of(EVAL_SET))


def contains_any(response: Column, expected: Column) -> Column:
    """1.0 if any expected term occurs in the response, ignoring case; else 0.0.
    A NULL response counts as empty, a NULL term never occurs."""
    said = F.lower(F.coalesce(response, F.lit("")))
    hit = F.exists(expected, lambda t: F.coalesce(F.contains(said, F.lower(t)), F.lit(False)))
    return F.coalesce(hit, F.lit(False)).cast("double")


def score_run(questions: DataFrame, responses: DataFrame, run_id: str, run_ts: Column) -> DataFrame:
    """Every question with its response and score. No response, or one with an
    ``error``, scores 0 and stays in the table. Of several responses to a request the
    smallest row counts, so repeated responses never multiply questions."""
    rest = [c for c in responses.columns if c != "request"]
    single = responses.groupBy("request").agg(F.min(F.struct(*rest)).alias("r")).select("request", "r.*")
    answered = questions.join(single, "request", "left")
    if "error" not in responses.columns:
        answered = answered.withColumn("error", F.lit(None).cast("string"))
    score = F.when(F.col("error").isNotNull(), F.lit(0.0)).otherwise(
        contains_any(F.col("response"), F.col("expected_contains_any"))
    )
    return answered.withColumn("contains_score", score).withColumn("run_id", F.lit(run_id)).withColumn("run_ts", run_ts)


def summarise_runs(runs: DataFrame, *by: str) -> DataFrame:
    """Mean score, rows and failed rows per run (and further columns)."""
    failed = F.count_if(F.col("error").isNotNull()) if "error" in runs.columns else F.lit(0).cast("bigint")
    return runs.groupBy("run_id", *by).agg(
        F.avg("contains_score").alias("contains_score_mean"), F.count("*").alias("n_eval_rows"), failed.alias("n_errors")
    )


def latest_run(runs: DataFrame, order: str = "run_ts") -> DataFrame:
    """Rows of the most recent run."""
    newest = runs.agg(F.max_by("run_id", order)).scalar()
    return runs.where(F.col("run_id") == newest)


def diff_runs(runs: DataFrame) -> DataFrame:
    """Each score against the same question's score in the run before it.

    Rows are first reduced to one per question and run, so a question's window is as
    long as the run history, whatever the table's size.
    """
    once = runs.groupBy("request", "run_id").agg(F.max("run_ts").alias("run_ts"), F.avg("contains_score").alias("score"))
    order = Window.partitionBy("request").orderBy("run_ts", "run_id")
    before = once.withColumn("previous", F.lag("score").over(order))
    return before.withColumn("delta", F.col("score") - F.col("previous"))


def kind_counts(frame: DataFrame, kind: str = "source_kind") -> DataFrame:
    return frame.groupBy(kind).agg(F.count("*").alias("n"))
