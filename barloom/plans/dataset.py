"""The training dataset: universe, ten-minute features, returns and lagged returns per symbol-day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.slots import TEN_MINUTE_SLOTS
from barloom.functions.values import numeric_to_float
from barloom.operators.calendar import trading_dates
from barloom.operators.datesets import pending_dates, ready_dates
from barloom.operators.resample import KEYS, MEAN_STD, resample_blocks, widen_blocks
from barloom.plans.features import wide_columns
from barloom.plans.panel import downsample_wide
from barloom.sources.readers import open_table
from barloom.sources.sinks import loaded_dates, write_by_date


def join_dataset(universe: DataFrame, features: DataFrame, returns: DataFrame, lag_returns: DataFrame) -> DataFrame:
    """Universe rows with everything known about them; absent parts are NULL.

    The narrow tables are joined first, so the wide features take part in one
    join only, on the partitioning the widening left them in.
    """
    keys = list(KEYS)
    narrow = universe.join(returns, keys, "left").join(lag_returns, keys, "left")
    rest = [c for t in (universe, features, returns, lag_returns) for c in t.columns if c not in keys]
    return narrow.join(features, keys, "left").selectExpr(*keys, *[f"`{c}`" for c in rest])


#: Bytes of dataset rows that are to lie in one place. Its pivot, join and sort take some thirty times as much, and hashing
#: may bring a few places to one task.
PLACE_BYTES = 16 * 1024 * 1024
#: Settings of the session while the dataset is written.
WIDE_SETTINGS = {
    # Two sides that lie by some of the join columns, in as many partitions, are joined where they are.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # What follows from thousands of renamed columns takes the planner half a minute to work out, and helps nothing.
    "spark.sql.constraintPropagation.enabled": "false",
}


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Other settings while something runs; those of before come back."""
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Places:
    """Where dataset rows are put together: by date and a bucket of symbols, as many buckets as the date's rows need.

    Ten-minute blocks and the narrow tables go there, small as they are; pivot, join and write then stay, so the wide
    rows are never shuffled, and a date that holds a third of the rows has as many places as its rows are many.
    """

    def __init__(self, universe: DataFrame, row_bytes: int, place_bytes: int = PLACE_BYTES):
        counts = universe.where("date IS NOT NULL").groupBy("date").count().collect()  # one row per trading day
        buckets = [(r["date"], -(-r["count"] * row_bytes // place_bytes)) for r in counts]
        self.number = max(1, sum(n for _, n in buckets))
        self.buckets = universe.sparkSession.createDataFrame(buckets, "date date, __buckets bigint")

    def put(self, df: DataFrame) -> DataFrame:
        """Rows of dates that the universe has, in their places, with the column ``__bucket``."""
        dealt = df.join(F.broadcast(self.buckets), "date")
        dealt = dealt.withColumn("__bucket", F.pmod(F.xxhash64("symbol"), "__buckets")).drop("__buckets")
        return dealt.repartition(self.number, "date", "__bucket")


def placed_rows(
    bars_1m: DataFrame,
    universe: DataFrame,
    returns: DataFrame,
    lag_returns: DataFrame,
    bars: Sequence[str],
    days: Sequence[dt.date],
    slots: Sequence[str] = TEN_MINUTE_SLOTS,
    place_bytes: int = PLACE_BYTES,
) -> DataFrame:
    """The rows of :func:`dataset_rows`, in places to be written from, under ``WIDE_SETTINGS``."""
    bars_1m, universe, returns, lag_returns = (only_dates(t, days) for t in (bars_1m, universe, returns, lag_returns))
    columns, keys = wide_columns(bars, slots), list(KEYS)
    narrow = universe.join(returns, keys, "left").join(lag_returns, keys, "left")
    places = Places(universe, 4 * (len(columns) + len(narrow.columns)), place_bytes)
    stats = resample_blocks(bars_1m, bars, MEAN_STD)
    # narrowed to 32 bits, as they are written, before they are moved
    narrowed = stats.rows.withColumns({v: F.col(v).cast("float") for v in stats.values})
    put = replace(stats, rows=places.put(narrowed))
    index = (*KEYS, "__bucket")
    wide = widen_blocks(put, slots, as_float=True, placed=True, index=index).selectExpr(*index, *[f"`{c}`" for c in columns])
    # where AQE sees one side as small it would send it everywhere; both already lie where they meet
    joined = numeric_to_float(places.put(narrow).join(wide.hint("merge"), list(index), "left"))
    first = [c for c in universe.columns if c not in keys]
    rest = [c for t in (returns, lag_returns) for c in t.columns if c not in keys]
    return joined.selectExpr(*keys, *[f"`{c}`" for c in (*first, *columns, *rest)])


def only_dates(df: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """Rows of the given dates; as literals they prune the folders of a partitioned table up front."""
    return df.where(F.col("date").isin(list(days)))


def date_list(dates: DataFrame) -> list[dt.date]:
    """A set of dates on the driver: one value per trading day, bounded by the calendar."""
    return sorted(r["date"] for r in trading_dates(dates).collect())


def dataset_rows(
    bars_1m: DataFrame,
    universe: DataFrame,
    returns: DataFrame,
    lag_returns: DataFrame,
    bars: Sequence[str],
    days: Sequence[dt.date] | None = None,
    slots: Sequence[str] = TEN_MINUTE_SLOTS,
) -> DataFrame:
    """Dataset rows of the given dates (default: the ready ones), numerics as 32-bit floats."""
    if days is None:
        days = date_list(ready_dates(bars_1m, universe, returns, lag_returns))
    bars_1m, universe, returns, lag_returns = (only_dates(t, days) for t in (bars_1m, universe, returns, lag_returns))
    features = downsample_wide(bars_1m, bars, slots).selectExpr(*KEYS, *[f"`{c}`" for c in wide_columns(bars, slots)])
    return numeric_to_float(join_dataset(universe, features, returns, lag_returns))


def build_dataset(
    spark: SparkSession,
    sources: dict[str, str | DataFrame],
    path: str,
    bars: Sequence[str],
    *,
    only_new: bool = False,
    slots: Sequence[str] = TEN_MINUTE_SLOTS,
) -> list[dt.date]:
    """Build the dataset over all ready dates in one job and write it by date; returns the dates.

    ``sources`` holds ``bar_1m``, ``univ``, ``return`` and ``lag_return`` as
    paths or frames. Tables given by path tell their dates from their folders,
    so no data is read to find the ready ones. Rows are written from where they
    are put together: see :class:`Places`. Minute bars in buckets of symbols
    (``write_by_date`` with a ``table``), given as the frame of that table, are
    aggregated where they are read.
    """
    names = ("bar_1m", "univ", "return", "lag_return")
    tables = [open_table(spark, sources[n]) for n in names]
    held = [loaded_dates(spark, sources[n]) if isinstance(sources[n], str) else t for n, t in zip(names, tables)]
    dates = ready_dates(*held)
    if only_new:
        dates = pending_dates(dates, loaded_dates(spark, path))
    days = date_list(dates)
    if days:
        with session_settings(spark, WIDE_SETTINGS):
            write_by_date(placed_rows(*tables, bars, days, slots), path, placed=True)
    return days


def downsample_pending(
    spark: SparkSession, source: str, target: str, bars: Sequence[str], slots: Sequence[str] = TEN_MINUTE_SLOTS
) -> list[dt.date]:
    """Downsample the dates of a minute-bar table that the ten-minute table lacks; returns them."""
    days = date_list(pending_dates(loaded_dates(spark, source), loaded_dates(spark, target)))
    if days:
        with session_settings(spark, WIDE_SETTINGS):
            write_by_date(downsample_wide(only_dates(open_table(spark, source), days), bars, slots), target)
    return days
