"""Trading calendar: a table (date, idx, prev, next) and the algebra on it.

A calendar has a row for each distinct date, so at most 366 a year whatever the
size of the data; that is what makes the unpartitioned window over it and the
broadcasts of it safe. No date is left out unless a range is asked for.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.clock import add_session_minutes, at_slot
from barloom.functions.dates import to_date
from barloom.functions.durations import parse_duration
from barloom.functions.slots import ONE_MINUTE_SLOTS


def trading_dates(df: DataFrame, date_col: str = "date", begin=None, end=None) -> DataFrame:
    """Distinct dates of a column, unordered; with ``begin`` or ``end``, those inside."""
    days = df.select(F.col(date_col).cast("date").alias("date")).where("date IS NOT NULL")
    return _inside(days, begin, end).distinct()


def _inside(days: DataFrame, begin, end) -> DataFrame:
    if begin is not None:
        days = days.where(F.col("date") >= F.lit(to_date(begin)))
    if end is not None:
        days = days.where(F.col("date") <= F.lit(to_date(end)))
    return days


def trading_calendar(df: DataFrame, date_col: str = "date", begin=None, end=None) -> DataFrame:
    """Calendar table (date, idx from 0, prev, next) from any table with dates."""
    order = W.orderBy("date")
    return trading_dates(df, date_col, begin, end).select(
        "date",
        (F.row_number().over(order) - 1).alias("idx"),
        F.lag("date").over(order).alias("prev"),
        F.lead("date").over(order).alias("next"),
    )


def calendar_between(calendar: DataFrame, begin, end=None) -> DataFrame:
    return _inside(calendar, begin, end or None)


def calendar_next(calendar: DataFrame, n: int = 1) -> DataFrame:
    """(date, next): the n-th following trading date, NULL past the end."""
    return calendar.select("date", F.lead("date", n).over(W.orderBy("date")).alias("next"))


def flag_trading_days(df: DataFrame, calendar: DataFrame, date_col: str = "date", out: str = "is_trading_day") -> DataFrame:
    """Add a boolean: is the date in the calendar?"""
    days = calendar.select(F.col("date").alias("__day"))
    return df.join(F.broadcast(days), F.col(date_col) == F.col("__day"), "left").select(
        *[F.col(c) for c in df.columns], F.col("__day").isNotNull().alias(out)
    )


def ordinals(dates: DataFrame, calendar: DataFrame, date_col: str) -> DataFrame:
    """For distinct dates: trading dates before each, whether it is one, and the calendar's length.

    One running count over dates and calendar together, so no range join.
    Both inputs are bounded by the number of calendar days.
    """
    both = (
        dates.select(F.col(date_col).alias("__d"))
        .distinct()
        .select("__d", F.lit(0).alias("__t"))
        .unionByName(calendar.select(F.col("date").alias("__d"), F.lit(1).alias("__t")))
        .groupBy("__d")
        .agg(F.max("__t").alias("__t"), F.min("__t").alias("__m"))
    )
    before = F.coalesce(F.sum("__t").over(W.orderBy("__d").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return (
        both.select(
            "__d",
            before.alias("__before"),
            (F.col("__t") == 1).alias("__trading"),
            F.sum("__t").over(W.partitionBy()).alias("__total"),
            "__m",
        )
        .where(F.col("__m") == 0)
        .drop("__m")
    )


def shift_dates(
    df: DataFrame, calendar: DataFrame, n: int | Column, date_col: str = "date", out: str = "shifted"
) -> DataFrame:
    """Move a date column by n trading days (n may be a column; 0 gives NULL).

    From a day off, +1 is the next trading day and -1 the previous one. A date
    after the calendar's end, or a result outside the calendar, becomes NULL.
    """
    if isinstance(n, int):
        if n == 0:
            raise ValueError("a shift by 0 trading days means nothing")
        n = F.lit(n)
    days = df.select(date_col).where(F.col(date_col).isNotNull())
    pos = ordinals(days, calendar, date_col)
    located = df.join(F.broadcast(pos), F.col(date_col) == F.col("__d"), "left")
    step = F.when(F.col("__trading") | (n < 0), n).otherwise(n - 1)
    target = F.when((n != 0) & (F.col("__before") < F.col("__total")), F.col("__before") + step)
    by_idx = calendar.select(F.col("idx").alias("__idx"), F.col("date").alias("__to"))
    return (
        located.withColumn("__target", target)
        .join(F.broadcast(by_idx), F.col("__target") == F.col("__idx"), "left")
        .select(*[F.col(c) for c in df.columns], F.col("__to").alias(out))
    )


def is_trading_day(calendar: DataFrame, date) -> bool:
    return not calendar.where(F.col("date") == F.lit(to_date(date))).isEmpty()


def shift_date(calendar: DataFrame, date, n: int) -> dt.date:
    """Scalar form of :func:`shift_dates`; raises when the result leaves the calendar."""
    if n == 0:
        raise ValueError("a shift by 0 trading days means nothing")
    day = F.lit(to_date(date))
    if calendar.where(F.col("date") >= day).isEmpty():
        raise IndexError(f"{date} is past the end of the calendar")
    if n > 0:
        side = calendar.where(F.col("date") > day).orderBy("date")
    else:
        side = calendar.where(F.col("date") < day).orderBy(F.col("date").desc())
    found = side.select("date").offset(abs(n) - 1).head(1)
    if not found:
        raise IndexError(f"{date} shifted by {n} trading days is outside the calendar")
    return found[0]["date"]


def clamp_range(calendar: DataFrame, begin, end, now: dt.datetime) -> tuple[dt.date, dt.date] | None:
    """First and last trading day to load for a requested range, or None if there is none.

    The end day counts only when it is a trading day and the clock is past
    23:00; otherwise the range ends on the trading day before it.
    """
    begin, end = to_date(begin, now.date()), to_date(end, now.date())
    d = F.col("date")
    last = d <= F.lit(end) if now.strftime("%H%M") > "2300" else d < F.lit(end)
    row = calendar.agg(
        F.min(F.when(d >= F.lit(begin), d)).alias("first"), F.max(F.when(last, d)).alias("last")
    ).first()
    if row["first"] is None or row["last"] is None or row["first"] > row["last"]:
        return None
    return row["first"], row["last"]


def slot_schedule(calendar: DataFrame, duration: str, start_slots: str | list[str]) -> DataFrame:
    """(time, next_time) for each calendar day and start slot, ``duration`` of trading time later."""
    starts = [start_slots] if isinstance(start_slots, str) else list(start_slots)
    unknown = [s for s in starts if s not in ONE_MINUTE_SLOTS]
    if unknown or not starts:
        raise ValueError(f"start slots must be bars of a trading session, got {unknown or starts}")
    days, minutes = parse_duration(duration)
    gap, end_slot = add_session_minutes("slot", F.lit(days), F.lit(minutes))
    moves = calendar.select(
        "date", "idx", F.explode(F.array(*[F.lit(s) for s in starts])).alias("slot")
    ).select("date", "idx", "slot", gap.alias("gap"), end_slot.alias("end_slot"))
    ahead = calendar.select((F.col("idx")).alias("__idx"), F.col("date").alias("__to"))
    return moves.join(F.broadcast(ahead), F.col("idx") + F.col("gap") == F.col("__idx"), "left").select(
        at_slot("date", "slot").alias("time"), at_slot("__to", "end_slot").alias("next_time")
    )
