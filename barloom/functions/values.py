"""Value-level helpers: NaN handling, safe returns, bulk casts and names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NaN -> NULL in the floating columns (all of them, or the named ones).

    Thousands of columns go to the planner as one list of texts, which is far
    quicker than a Column object each.
    """
    wanted = None if columns is None else set(columns)
    return df.selectExpr(
        *[
            f"nanvl(`{f.name}`, CAST(NULL AS {f.dataType.simpleString()})) AS `{f.name}`"
            if isinstance(f.dataType, _FLOATING) and (wanted is None or f.name in wanted)
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def numeric_to_float(df: DataFrame) -> DataFrame:
    """Every numeric column as 32-bit float; other types are left alone."""
    return df.selectExpr(
        *[
            f"CAST(`{f.name}` AS FLOAT) AS `{f.name}`"
            if isinstance(f.dataType, T.NumericType) and not isinstance(f.dataType, T.FloatType)
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def simple_return(end: Column, start: Column) -> Column:
    """``end / start - 1``; NULL when the start is zero or either side is NULL."""
    return F.try_divide(end, start) - F.lit(1.0)


def is_valid(value: Column | str) -> Column:
    """Neither NULL nor NaN."""
    c = F.col(value) if isinstance(value, str) else value
    return c.isNotNull() & ~F.isnan(c)


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str] = ("date", "symbol")) -> DataFrame:
    """Prefix every column name except the keys."""
    kept = set(keep)
    return df.toDF(*[c if c in kept else prefix + c for c in df.columns])


def renamed(df: DataFrame, replace: Mapping[str, str]) -> DataFrame:
    """Replace substrings in all column names, in the order given."""

    def new(name: str) -> str:
        for old, to in replace.items():
            name = name.replace(old, to)
        return name

    return df.toDF(*[new(c) for c in df.columns])


def anonymised(key: Column | str) -> Column:
    """md5 hex digest of a key."""
    return F.md5(F.col(key) if isinstance(key, str) else key)
