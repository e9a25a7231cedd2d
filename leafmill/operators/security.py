"""Row filters and column masks. Apply them before any ranking, so that hits are
not lost to rows the caller may not see."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what a masked field shows.
MASK = "[redacted — request access]"


def row_filter(
    frame: DataFrame, user_regions: DataFrame, user: str, is_admin: bool = False, region: str = "region"
) -> DataFrame:
    """Rows of the user's regions; all rows for admins. A NULL region is admin-only."""
    if is_admin:
        return frame
    allowed = (
        user_regions.where(F.col("user_email") == user).select(F.col("region_code").alias(region)).distinct()
    )
    return frame.join(allowed, region, "left_semi")


def user_labels(user_regions: DataFrame, admins: Sequence[str] = ()) -> DataFrame:
    """user_email, labels: the regions that each user may see; null for admins, who see all rows.

    A user has as many regions as the mapping gives; NULL regions give nothing.
    """
    listed = user_regions.groupBy("user_email").agg(F.array_sort(F.collect_set("region_code")).alias("labels"))
    is_admin = F.col("user_email").isin(list(admins))
    known = listed.select("user_email", F.when(~is_admin, F.col("labels")).alias("labels"))
    unlisted = user_regions.sparkSession.createDataFrame([(a,) for a in admins], "user_email string")
    rest = unlisted.join(listed, "user_email", "left_anti").withColumn("labels", F.lit(None).cast("array<string>"))
    return known.unionByName(rest)


def mask_column(value: Column, allowed: bool | Column) -> Column:
    shown = F.lit(allowed) if isinstance(allowed, bool) else allowed
    return F.when(shown, value).otherwise(F.lit(MASK))


def mask(frame: DataFrame, columns: Sequence[str], allowed: bool | Column) -> DataFrame:
    return frame.withColumns({c: mask_column(F.col(c), allowed) for c in columns})


def register_functions(spark: SparkSession, regions_view: str, user: str, in_group: bool, is_admin: bool = False) -> None:
    """SQL forms: ``region_visible(region)`` and ``mask_sensitive(value)``.

    Open-source Spark has no group lookup, so membership is an argument.
    """
    if not re.fullmatch(r"\w+(\.\w+)*", regions_view):
        raise ValueError("regions_view must be a plain view name")
    # As hex digits: no user name can end the literal, whatever the session's escape rules.
    name = f"decode(unhex('{user.encode().hex()}'), 'UTF-8')"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION region_visible(region STRING) RETURNS BOOLEAN RETURN "
        f"region IN (SELECT region_code FROM {regions_view} WHERE user_email = {name}) OR {str(is_admin).lower()}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_sensitive(value STRING) RETURNS STRING RETURN "
        f"CASE WHEN {str(in_group).lower()} THEN value ELSE '{MASK}' END"
    )
