"""Tables bucketed by date and symbol: what is dealt alike when written is joined without being dealt again.

Meant for long histories, read over and over: minute bars and the daily tables that go with them. A bucket is a task of
the join, and since the date is one of its keys, a symbol with a third of all bars is spread over them by its days.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from barloom.operators.resample import KEYS
from barloom.operators.returns import adjusted_bars
from barloom.sources.readers import in_dates
from barloom.sources.workdir import work_folder


def write_bucketed(df: DataFrame, name: str, buckets: int, path: str | None = None, keys: Sequence[str] = KEYS) -> None:
    """Write ``df`` as the catalogue table ``name``, replacing it, one sorted file for each of its ``buckets``.

    Rows are shuffled to their bucket first, so there are as many files as buckets and not as many for every task.
    Sorted by ``keys`` within, dates first, a file's row groups cover few dates each and a range of dates reads only
    those. ``path`` is where the files go, the warehouse if there is none. Choose ``buckets`` for a few hundred MB of
    the largest table each, and the same number for all tables that are to be joined. Rows with a NULL key are one
    more value; repeated rows are kept; an empty table has no files and can be read.
    """
    if buckets < 1:
        raise ValueError(f"a table has one bucket at least, not {buckets}")
    if missing := [k for k in keys if k not in df.columns]:
        raise ValueError(f"no columns of these names to bucket by: {missing}")
    placed = df.repartition(buckets, *keys)
    writer = placed.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def bucketed(df: DataFrame, name: str, buckets: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """``df`` as a bucketed table in the work folder that only this session reads: written, read, and out of the catalogue."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    write_bucketed(df, table, buckets, work_folder(spark, name), keys)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay, they are not the catalogue's
    return rows


def bucketed_bar_source(spark: SparkSession, bars_1m: str, factors: str) -> Callable[[dt.date, dt.date], DataFrame]:
    """Source of minute bars with their daily factor out of two bucketed tables, for :func:`~.incremental.load_item`.

    With as many buckets in both, neither table is shuffled or broadcast, however many dates are asked for; with other
    tables the rows are the same, and Spark shuffles. Bars without a factor stay, with a NULL.
    """

    def source(first: dt.date, last: dt.date) -> DataFrame:
        return adjusted_bars(*(in_dates(spark.table(t), first, last) for t in (bars_1m, factors)))

    return source
