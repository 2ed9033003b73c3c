"""Date-partitioned tables: write, list, overwrite only the dates at hand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by_date(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = ("date",),
    sort: Sequence[str] = ("symbol",),
    placed: bool = False,
    table: str | None = None,
    buckets: int = 0,
) -> None:
    """Write one folder per date, replacing only the dates that occur in ``df``.

    Rows are rebalanced by the partition columns: adaptive execution splits a
    date that is too large over several tasks and merges small ones, so one hot
    date does not become one task. Files are sorted by symbol for tight row
    group statistics. ``placed`` says that the rows lie where they are to be
    written from: they are not moved again.

    With ``table``, a name for the catalogue, a folder's files are also dealt
    into ``buckets`` by the first column of ``sort``, and the table is written
    whole, not by the dates at hand. Read by its name, rows of a date and symbol
    are then known to lie together, so they are aggregated without a shuffle. A
    bucket is a task, over all dates read: choose as many as the rows need.
    """
    if table:
        if buckets < 1:
            raise ValueError(f"a table has one bucket at least, not {buckets}")
        dealt = df if placed else df.repartition(buckets, sort[0])
        writer = dealt.write.format("parquet").mode("overwrite").options(path=path, compression="zstd")
        writer.partitionBy(*partitions).bucketBy(buckets, sort[0]).sortBy(*sort).saveAsTable(table)
        return
    within = [c for c in (*partitions, *sort) if c in df.columns]
    (
        (df if placed else df.hint("rebalance", *partitions))
        .sortWithinPartitions(*within)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def loaded_dates(spark: SparkSession, path: str) -> DataFrame:
    """Dates a date-partitioned table already holds; empty when there is no table yet.

    Lists the partition folders only (one name per date), no data file is opened.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/date=*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    names = [(s.getPath().getName().split("=", 1)[1],) for s in found]
    dates = spark.createDataFrame(names, "date string").select(F.col("date").try_cast("date").alias("date"))
    return dates.where(F.col("date").isNotNull())  # the folder of NULL dates is none
