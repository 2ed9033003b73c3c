"""Dates as arguments (driver) and as columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_datetime(value, today: dt.date | None = None) -> dt.datetime:
    """A date argument as datetime: ``YYYYMMDD``, ``YYYY-MM-DD``, ``today``, int, date or datetime."""
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    if isinstance(value, bool) or not isinstance(value, (int, str)):
        raise TypeError(f"cannot read a date from {type(value).__name__}")
    text = str(value)
    if text == "today":
        return to_datetime(today or dt.date.today())
    return dt.datetime.strptime(text, "%Y%m%d" if text.isdigit() else "%Y-%m-%d")


def to_date(value, today: dt.date | None = None) -> dt.date:
    return to_datetime(value, today).date()


def to_ymd(value, today: dt.date | None = None) -> str:
    return to_date(value, today).isoformat()


def year_end(year: int | None = None) -> dt.date:
    """31 December of a year, the current one by default."""
    return dt.date(year or dt.date.today().year, 12, 31)


def parse_date(text: Column | str) -> Column:
    """Date of a text column in either written form; NULL for anything else."""
    t = F.col(text) if isinstance(text, str) else text
    return F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")).when(
        t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd")
    )


def ymd(date: Column | str) -> Column:
    """Date column as ``YYYY-MM-DD``."""
    return F.date_format(F.col(date) if isinstance(date, str) else date, "yyyy-MM-dd")


def year_end_of(date: Column | str) -> Column:
    """31 December of the year of a date column."""
    return F.make_date(F.year(date), F.lit(12), F.lit(31))
