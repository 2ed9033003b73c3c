"""Reading panel tables: projection, date range and slot filters that reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.dates import to_date, year_end
from barloom.functions.values import nan_to_null, require_columns
from barloom.operators.calendar import trading_calendar
from barloom.operators.resample import KEYS, bars_at


def open_table(
    spark: SparkSession, source: str | Sequence[str] | DataFrame, fmt: str = "parquet", **options
) -> DataFrame:
    """A table by path (or paths), by catalogue name (``fmt="table"``), over JDBC, or given as a frame.

    For ``fmt="jdbc"`` the source is the table name; connection options are the
    caller's.
    """
    if isinstance(source, DataFrame):
        return source
    if fmt == "table":
        return spark.table(source)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=source, **options).load()
    reader = spark.read.format(fmt).options(**options)
    return reader.load(source if isinstance(source, str) else [str(p) for p in source])


def in_dates(df: DataFrame, begin=None, end=None, date_col: str = "date") -> DataFrame:
    """Rows of an inclusive date range; either bound may be open."""
    if begin is not None:
        df = df.where(F.col(date_col) >= F.lit(to_date(begin)))
    if end is not None:
        df = df.where(F.col(date_col) <= F.lit(to_date(end)))
    return df


def read_one_date(spark: SparkSession, source, date, **options) -> DataFrame:
    return open_table(spark, source, **options).where(F.col("date") == F.lit(to_date(date)))


def read_bars(
    spark: SparkSession,
    source,
    columns: Sequence[str] | None = None,
    begin=None,
    end=None,
    at: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Minute bars: keys, time and the wanted columns, of a date range, at given ``HHMM`` slots."""
    df = in_dates(open_table(spark, source, **options), begin, end)
    if columns is not None:
        require_columns(df, columns)
        df = df.select(*KEYS, "time", *columns)
    return bars_at(df, at) if at is not None else df


def read_universe(spark: SparkSession, source, name: str | None = None, begin=None, end=None, **options) -> DataFrame:
    """Universe flags, or the (date, symbol) members of one named universe."""
    df = in_dates(open_table(spark, source, **options), begin, end)
    return df if name is None else df.where(F.col(name)).select(*KEYS)


def read_daily(spark: SparkSession, source, columns: Sequence[str] = ("adj_factor",), begin=None, end=None, **options):
    """Daily values per symbol, the adjustment factor by default."""
    return in_dates(open_table(spark, source, **options), begin, end).select(*KEYS, *columns)


def read_calendar(
    spark: SparkSession, source, begin="2010-01-01", end: dt.date | str | None = None, date_col: str = "date", **options
) -> DataFrame:
    """Trading calendar from any table with dates; ends on 31 December of this year by default."""
    return trading_calendar(open_table(spark, source, **options), date_col, begin, end or year_end())


def read_dataset(
    spark: SparkSession,
    source,
    columns: Sequence[str],
    *,
    universe: str | None = None,
    date_range: tuple | None = None,
    date_col: str | None = None,
    fill_nan: bool = True,
    **options,
) -> DataFrame:
    """Offline dataset: universe rows, wanted columns, inclusive date range, NaN as NULL.

    The universe flag need not be among the columns.
    """
    df = open_table(spark, source, **options)
    if universe:
        df = df.where(F.col(universe))
    df = df.selectExpr(*[f"`{c}`" for c in columns])
    if date_range is not None:
        if date_col is None:
            raise ValueError("a date range needs date_col")
        if date_col not in columns:
            raise ValueError(f"date_col {date_col!r} is not among the columns")
        df = in_dates(df, *date_range, date_col=date_col)
    return nan_to_null(df) if fill_nan else df
