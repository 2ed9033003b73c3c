"""Which dates are there, which are missing, which are ready: sets of dates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.operators.calendar import trading_dates


def drop_latest(dates: DataFrame, k: int) -> DataFrame:
    """A set of dates without its k latest ones."""
    if k == 0:
        return dates
    return (
        dates.select("date", F.row_number().over(W.orderBy(F.col("date").desc())).alias("__r"))
        .where(F.col("__r") > k)
        .select("date")
    )


def common_dates(*tables: DataFrame) -> DataFrame:
    """Dates that occur in every table."""
    return reduce(DataFrame.intersect, [trading_dates(t) for t in tables])


def ready_dates(*tables: DataFrame, hold_back: int = 6) -> DataFrame:
    """Dates present in every table, without the latest ones whose forward returns are open."""
    return drop_latest(common_dates(*tables), hold_back)


def pending_dates(wanted: DataFrame, loaded: DataFrame, reload_last: int = 0) -> DataFrame:
    """Wanted dates not loaded yet; the last ``reload_last`` loaded ones count as not loaded."""
    settled = drop_latest(trading_dates(loaded), reload_last)
    return trading_dates(wanted).join(settled, "date", "left_anti")
