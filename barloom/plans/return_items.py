"""The return and lag-return items: loaded in spans, and again until their horizons are known."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.calendar import trading_dates
from barloom.operators.returns import HORIZONS
from barloom.plans.return_tables import lag_return_table, return_table
from barloom.sources.readers import in_dates
from barloom.sources.sinks import loaded_dates, write_by_date


def return_rows(
    bars_1m: DataFrame,
    factors: DataFrame | None,
    calendar: DataFrame,
    first: dt.date,
    last: dt.date,
    known: dt.date,
    days: Sequence[dt.date],
    horizons: Sequence[int] = HORIZONS,
    lag: bool = False,
) -> DataFrame:
    """Rows of the return (or lag-return) item dated ``first`` to ``last``, from bars of ``known`` and before.

    ``days`` are the calendar's. Bars are read from the first date on to ``max(horizons)`` trading days past the last
    one, and a trading day further for a lagged item, whose rows hold the returns of the next trading day.
    """
    end = bisect_right(days, known) - 1
    begin, finish = (days.index(d) + lag for d in (first, last))
    finish = min(finish, end)
    until = days[min(finish + max(horizons), end)]
    factors = in_dates(factors, days[begin], until) if factors is not None else None
    table = return_table(in_dates(bars_1m, days[begin], until), calendar, factors, horizons)
    table = in_dates(table, days[begin], days[finish])
    return lag_return_table(table, calendar) if lag else table


def load_returns(
    spark: SparkSession,
    bars_1m: DataFrame,
    factors: DataFrame | None,
    path: str,
    calendar: DataFrame,
    begin: dt.date,
    known: dt.date,
    *,
    horizons: Sequence[int] = HORIZONS,
    lag: bool = False,
    days_per_job: int = 60,
) -> list[dt.date]:
    """Bring the item up to date from ``begin`` on, with bars of ``known`` and before; returns the dates written.

    A ledger beside the item, ``{path}.ledger``, holds up to which date the bars were known when a date was written. A
    date is written again while its horizons reach past that and more is known now, and never after. Spans of
    ``days_per_job`` dates overlap in the bars they read, not in the dates they write; the ledger follows each span, so a
    broken load goes on where it stopped. A date whose bars (lag: the next date's) are not known yet is left out.
    """
    days = sorted(r["date"] for r in trading_dates(calendar).collect())  # one value per trading day
    end = bisect_right(days, known) - 1
    if end < 0:
        return []
    book, written = f"{path}.ledger", {}
    if not loaded_dates(spark, book).isEmpty():
        schema = "known date, date date"
        written = {r["date"]: r["known"] for r in spark.read.schema(schema).parquet(book).collect()}

    def open_still(at: int) -> bool:
        before = written.get(days[at])
        if before is None:
            return True
        reach = min(at + lag + max(horizons), end)
        return days[reach] > before

    todo = [days[i] for i in range(len(days)) if days[i] >= begin and i + lag <= end and open_still(i)]
    for span in (todo[i : i + days_per_job] for i in range(0, len(todo), days_per_job)):
        rows = return_rows(bars_1m, factors, calendar, span[0], span[-1], days[end], days, horizons, lag)
        write_by_date(rows.where(F.col("date").isin(span)), path)
        write_by_date(spark.createDataFrame([(days[end], d) for d in span], "known date, date date"), book)
    return todo
