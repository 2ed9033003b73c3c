"""Incremental loads of a date-partitioned table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.calendar import calendar_between, clamp_range
from barloom.operators.datesets import pending_dates
from barloom.operators.returns import adjusted_bars
from barloom.sources.readers import in_dates
from barloom.sources.sinks import loaded_dates, write_by_date

#: Symbol-days that are broadcast at most, of about a hundred bytes each once hashed.
BROADCAST_ROWS = 1_000_000


def load_item(
    spark: SparkSession,
    source: Callable[[dt.date, dt.date], DataFrame],
    path: str,
    calendar: DataFrame,
    begin,
    end,
    *,
    now: dt.datetime | None = None,
    reload_last: int = 0,
    days_per_job: int | None = None,
) -> list[dt.date]:
    """Load the missing trading dates of [begin, end]; returns them in order.

    ``source(first, last)`` gives the rows of an inclusive date range. Only the
    pending dates are written; dates loaded before stay as they are, but for the
    last ``reload_last`` (returns, which mature late, have a ledger of their own:
    :func:`barloom.plans.return_items.load_returns`). All dates
    go in one job unless ``days_per_job`` is given: a long history of bars is
    then loaded in spans of dates, so that the daily side of a join stays small
    enough to broadcast and a broken load resumes at its last span.
    """
    span = clamp_range(calendar, begin, end, now or dt.datetime.now())
    if span is None:
        return []
    todo = pending_dates(calendar_between(calendar, *span), loaded_dates(spark, path), reload_last)
    days = sorted(r["date"] for r in todo.collect())  # one value per trading day
    step = days_per_job or max(1, len(days))
    for span_days in (days[i : i + step] for i in range(0, len(days), step)):
        rows = source(span_days[0], span_days[-1])
        # A literal list rather than a join: it prunes partitions of the source.
        write_by_date(rows.where(F.col("date").isin(span_days)), path)
    return days


def adjusted_bar_source(bars_1m: DataFrame, factors: DataFrame) -> Callable[[dt.date, dt.date], DataFrame]:
    """Source of minute bars with their daily adjustment factor, for :func:`load_item`.

    The symbol-days of a span are counted first: up to ``BROADCAST_ROWS`` go to the bars, so that these stay where they
    are; beyond that Spark chooses the join. For long spans see :func:`barloom.sources.bucketed.bucketed_bar_source`.
    """

    def source(first: dt.date, last: dt.date) -> DataFrame:
        daily = in_dates(factors, first, last)
        small = daily.count() <= BROADCAST_ROWS
        return adjusted_bars(in_dates(bars_1m, first, last), F.broadcast(daily) if small else daily)

    return source
