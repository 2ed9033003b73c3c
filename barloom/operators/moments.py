"""Means, deviations and products of many columns, as vectors that add up over tasks and dates.

A task turns its Arrow batches into one vector for each date it meets, so a row of thousands of columns is never
multiplied into rows of its cells. Vectors are merged in two rounds, of at most 64 tasks and then of what is left.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of vectors that a task holds before it sends them on.
HELD_BYTES = 64 * 1024 * 1024
#: Bytes of a batch's cells that are worked on at once.
SLICE_BYTES = 16 * 1024 * 1024

VECTORS = "key date, n array<double>, mean array<double>, m2 array<double>"


def cells(df: DataFrame, columns: Sequence[str], *others: str) -> DataFrame:
    """The columns as one array of doubles ``__x`` beside the expressions ``others``."""
    return df.selectExpr(*others, f"array({', '.join(f'CAST(`{c}` AS DOUBLE)' for c in columns)}) AS __x")


def by_date(batch: pa.RecordBatch, width: int, names: Sequence[str] = ("__x",)) -> Iterator[tuple]:
    """(date or None, one array of cells per name) of each date in a batch, missing cells NaN."""
    step = max(1, SLICE_BYTES // (8 * max(1, width)))
    for start in range(0, batch.num_rows, step):
        some = batch.slice(start, step)
        days = some.column(some.schema.get_field_index("key")).dictionary_encode()
        at = days.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        values = [some.column(some.schema.get_field_index(n)).flatten().to_numpy(zero_copy_only=False) for n in names]
        values = [np.asarray(v, "float64").reshape(some.num_rows, -1) for v in values]
        for code in np.unique(at):
            rows = at == code
            yield (None if code < 0 else days.dictionary[int(code)].as_py()), *(v[rows] for v in values)


def _merged(a: tuple, b: tuple) -> tuple:
    """Counts, means and squared deviations of two sets together."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    with np.errstate(invalid="ignore", over="ignore"):
        delta = b[1] - a[1]
        return n, a[1] + delta * share, a[2] + b[2] + delta * delta * a[0] * share


def _vector(x: np.ndarray) -> tuple:
    there = ~np.isnan(x)
    n = there.sum(axis=0).astype("float64")
    filled = np.where(there, x, 0.0)
    with np.errstate(invalid="ignore", over="ignore"):
        mean = np.divide(filled.sum(axis=0), n, out=np.zeros_like(n), where=n > 0)
        off = np.where(there, x - mean, 0.0)
        return n, mean, (off * off).sum(axis=0)


def wide_moments(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """(key, n, mean, m2): for each date of ``key``, or for all rows, a vector over ``columns`` of the number of values,
    their mean and the sum of their squared deviations. NaN counts as NULL; rows of a NULL date have a vector too."""
    width = len(columns)
    most = max(1, HELD_BYTES // (24 * max(1, width)))

    def rows(held: dict, group: int) -> pa.RecordBatch:
        data = {"slot": [group] * len(held), "key": pa.array(list(held), pa.date32())}
        data |= {name: pa.array([v[i] for v in held.values()], pa.list_(pa.float64())) for i, name in enumerate(("n", "mean", "m2"))}
        return pa.RecordBatch.from_pydict(data, pa.schema([("slot", pa.int32()), ("key", pa.date32()), *((c, pa.list_(pa.float64())) for c in ("n", "mean", "m2"))]))

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = {}, TaskContext.get().partitionId() // 64
        for batch in batches:
            for day, x in by_date(batch, width):
                own = _vector(x)
                held[day] = _merged(held[day], own) if day in held else own
                if len(held) >= most:
                    yield rows(held, group)
                    held = {}
        if held:
            yield rows(held, group)

    def merged(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for part in zip(group["n"], group["mean"], group["m2"], strict=True):
            whole = part if whole is None else _merged(whole, part)
        out = group.iloc[:1].copy()
        for name, v in zip(("n", "mean", "m2"), whole, strict=True):
            out[name] = [v]
        return out

    source = cells(df, columns, f"CAST(`{key}` AS DATE) AS key" if key else "CAST(NULL AS DATE) AS key")
    parts = source.mapInArrow(reduced, f"slot int, {VECTORS}")
    parts = parts.groupBy("key", "slot").applyInPandas(merged, f"slot int, {VECTORS}")
    return parts.groupBy("key").applyInPandas(merged, f"slot int, {VECTORS}").drop("slot")


def finite(expr: str) -> str:
    """SQL: the value, or NULL where it is NaN or infinite."""
    return f"IF(abs({expr}) < DOUBLE('Infinity'), {expr}, NULL)"


def mean_and_std(vectors: DataFrame) -> DataFrame:
    """(key, mean, std) arrays: NULL where there is no value (for std: fewer than two), or one is infinite."""
    mean = f"transform(arrays_zip(n, mean), v -> IF(v.n > 0, {finite('v.mean')}, NULL)) AS mean"
    std = f"transform(arrays_zip(n, m2), v -> IF(v.n > 1, {finite('sqrt(v.m2 / (v.n - 1))')}, NULL)) AS std"
    return vectors.selectExpr("key", mean, std)
