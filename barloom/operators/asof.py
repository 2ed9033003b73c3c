"""As-of lookup of the latest n versions (models) at each date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_versions(
    dates: DataFrame, versions: DataFrame, n: int, date_col: str = "date", version_col: str = "milestone"
) -> DataFrame:
    """(date, milestone, rank): the n latest milestones on or before each date, rank 1 the latest.

    A running count over dates and milestones together gives each date the
    position of its latest milestone; the n picks are then equi-joined by
    position. No date is paired with a milestone it does not use. Dates before
    the first milestone have no row. Both inputs are sets of dates.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    marks = versions.select(F.col(version_col).alias("__d")).distinct()
    numbered = marks.select(F.col("__d").alias(version_col), F.row_number().over(W.orderBy("__d")).alias("__pos"))
    days = dates.select(F.col(date_col).alias("__d")).distinct()
    both = days.select("__d", F.lit(0).alias("__m")).unionByName(marks.select("__d", F.lit(1).alias("__m")))
    # RANGE frame: a milestone on the very date counts.
    upto = F.sum("__m").over(W.orderBy("__d").rangeBetween(W.unboundedPreceding, 0))
    counted = both.select("__d", "__m", upto.alias("__upto")).where((F.col("__m") == 0) & (F.col("__upto") > 0))
    picks = counted.select(
        F.col("__d").alias(date_col), "__upto", F.explode(F.sequence(F.lit(1), F.least(F.col("__upto"), F.lit(n)))).alias("rank")
    ).withColumn("__pos", F.col("__upto") - F.col("rank") + 1)
    return picks.join(numbered, "__pos").select(date_col, version_col, F.col("rank").cast("int").alias("rank"))
