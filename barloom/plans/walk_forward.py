"""Linear models of many milestones from one pass over the data.

Every date gives its matrix of products of features and labels, once, as rows of a written table. What a milestone
needs is the sum of the matrices of its training dates and of its evaluation dates: overlapping windows share all work
on the data, and each milestone is then solved on its own, in a task, for every strength of a ridge path. The strength
that errs least on the evaluation dates is the one kept.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.dates import to_date
from barloom.operators.moments import HELD_BYTES, by_date, cells
from barloom.operators.scaling import CrossSectionalZScore
from barloom.operators.splits import split_dates
from barloom.plans.training import INTERCEPT, MODEL_SCHEMA
from barloom.sources.workdir import written_table

#: A variance under this share of the mean square is none: it is left of rounding.
ROUNDING = 1e-12

SUMS = "label int, pos int, v array<double>"


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(labels, features, 3 * features + 8) sums over rows.

    For a label, over the rows that have it, and feature i: products with each feature j where both are there, values
    of i where j is there, and how often both are there; then i with the label, presence of i with the label; over all
    rows the number, sum and squares of i; and the number, sum and squares of the label.
    """
    k = x.shape[1]
    out = np.zeros((y.shape[1], k, 3 * k + 8))
    there = ~np.isnan(x)
    value, there = np.where(there, x, 0.0), there.astype("float64")
    with np.errstate(invalid="ignore", over="ignore"):
        for label in range(y.shape[1]):
            own = np.isfinite(y[:, label])
            f, p, t = value[own], there[own], y[own, label]
            sums = out[label]
            sums[:, :k], sums[:, k : 2 * k], sums[:, 2 * k : 3 * k] = f.T @ f, f.T @ p, p.T @ p
            sums[:, 3 * k], sums[:, 3 * k + 1] = f.T @ t, p.T @ t
            sums[:, 3 * k + 2], sums[:, 3 * k + 3], sums[:, 3 * k + 4] = there.sum(0), value.sum(0), (value * value).sum(0)
            sums[:, 3 * k + 5 :] = own.sum(), t.sum(), t @ t
    return out


def date_products(rows: DataFrame, x_columns: Sequence[str], y_columns: Sequence[str]) -> DataFrame:
    """(key, label, pos, v): sums of products by date, label and feature; rows of one date add up.

    NaN counts as NULL, an infinite label too. Rows without a date are in no window and are left out.
    """
    k, labels = len(x_columns), len(y_columns)
    each = 8 * labels * k * (3 * k + 8)
    y = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in y_columns)
    source = cells(rows.where("date IS NOT NULL"), x_columns, "CAST(date AS DATE) AS key", f"array({y}) AS __y")

    def batches_of(held: dict) -> Iterator[pa.RecordBatch]:
        for day, sums in held.items():
            for label in range(labels):
                data = {"key": pa.array([day] * k, pa.date32()), "label": pa.array([label] * k, pa.int32()),
                        "pos": pa.array(range(k), pa.int32()), "v": pa.array(list(sums[label]), pa.list_(pa.float64()))}
                yield pa.RecordBatch.from_pydict(data)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for day, x, y in by_date(batch, k + labels, ("__x", "__y")):
                own = _products(x, y)
                held[day] = held[day] + own if day in held else own
                if len(held) * each > HELD_BYTES:
                    yield from batches_of(held)
                    held = {}
        yield from batches_of(held)

    return source.mapInArrow(summed, f"key date, {SUMS}")


def window_products(products: DataFrame, windows: Sequence[tuple[dt.date, str, dt.date, dt.date]]) -> DataFrame:
    """(milestone, split, label, pos, v): sums over the dates of each window (milestone, split, first, last).

    A task goes through the dates of one label and feature as they come and holds a row of sums for each window.
    """

    def summed(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, pos = (k.as_py() for k in key)
        sums: dict = {}
        for batch in batches:
            days, values = batch.column("key").to_pylist(), batch.column("v")
            for day, v in zip(days, values, strict=True):
                v = v.values.to_numpy()
                for at, (_, _, first, last) in enumerate(windows):
                    if first <= day <= last:
                        sums[at] = sums[at] + v if at in sums else v
        rows = [{"milestone": windows[at][0], "split": windows[at][1], "label": label, "pos": pos, "v": v} for at, v in sums.items()]
        kinds = [("milestone", pa.date32()), ("split", pa.string()), ("label", pa.int32()), ("pos", pa.int32()), ("v", pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    return products.groupBy("label", "pos").applyInArrow(summed, f"milestone date, split string, {SUMS}")


class Window:
    """The sums of a window as matrices, its features standardised by given means and deviations; 0 where missing."""

    def __init__(self, v: np.ndarray, mean: np.ndarray, std: np.ndarray):
        k = len(v)
        usable = np.isfinite(std) & (std > 0)
        a, s = np.where(usable, mean, 0.0), np.where(usable, std, 1.0)
        xx, xm, mm = v[:, :k], v[:, k : 2 * k], v[:, 2 * k : 3 * k]
        with np.errstate(invalid="ignore", over="ignore"):
            zz = (xx - xm * a[None, :] - xm.T * a[:, None] + np.outer(a, a) * mm) / np.outer(s, s)
            z, zy = (np.diag(xm) - a * np.diag(mm)) / s, (v[:, 3 * k] - a * v[:, 3 * k + 1]) / s
        both = np.outer(usable, usable)
        self.zz, self.z, self.zy = np.where(both, zz, 0.0), np.where(usable, z, 0.0), np.where(usable, zy, 0.0)
        self.n, self.y, self.yy = v[0, 3 * k + 5 :]

    def solved(self, reg: float) -> tuple[np.ndarray, float]:
        """Weights and intercept of the least mean square with a penalty of ``reg / 2`` on squared weights."""
        z, y = self.z / self.n, self.y / self.n
        spread = self.zz / self.n - np.outer(z, z) + reg * np.eye(len(z))
        weights = np.linalg.lstsq(spread, self.zy / self.n - z * y, rcond=None)[0]
        return weights, y - z @ weights

    def error(self, weights: np.ndarray, intercept: float) -> float:
        """Mean squared error of a model on the window."""
        off = self.yy - 2 * (intercept * self.y + weights @ self.zy)
        off += weights @ self.zz @ weights + 2 * intercept * (weights @ self.z) + intercept**2 * self.n
        return max(0.0, off / self.n)


def _parameters(v: np.ndarray, dated: bool) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation of each feature over all rows of a window; NaN where there is none."""
    k = len(v)
    if dated:
        return np.zeros(k), np.ones(k)
    n, x, xx = v[:, 3 * k + 2], v[:, 3 * k + 3], v[:, 3 * k + 4]
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        mean = x / n
        var = (xx - x * mean) / (n - 1)
        var = np.where(var > ROUNDING * xx / n, var, np.where(n > 1, 0.0, np.nan))
    return np.where(np.isfinite(mean), mean, np.nan), np.where(np.isfinite(xx), np.sqrt(var), np.nan)


def _path(group: pd.DataFrame, regs: Sequence[float], dated: bool):
    """(mean, std, models, errors, chosen, rows of evaluation) of a milestone and label; None without training rows."""
    parts = {s: np.stack(g.sort_values("pos")["v"].tolist()) for s, g in group.groupby("split")}
    if "train" not in parts:
        return None
    mean, std = _parameters(parts["train"], dated)
    train = Window(parts["train"], mean, std)
    if not train.n:
        return None
    models = [train.solved(reg) for reg in regs]
    held = Window(parts["eval"], mean, std) if "eval" in parts else None
    errors = [held.error(*m) for m in models] if held and held.n else [None] * len(models)
    chosen = int(np.argmin(errors)) if errors[0] is not None else 0
    return mean, std, models, errors, chosen, int(held.n) if held else 0


def train_walk_forward(
    dataset: DataFrame,
    calendar: DataFrame,
    milestones: Sequence,
    x_columns: Sequence[str],
    y_columns: Sequence[str],
    prod: str,
    *,
    regs: Sequence[float] = (0.0,),
    normaliser: str = "zscore",
    universe: str | None = None,
    n_train: int = 1000,
    n_eval: int = 30,
    n_lag: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """(models, errors) of all milestones and labels, from one pass over the rows of their windows.

    ``models`` has the columns of a model table and ``normaliser``; ``errors`` is (prod, milestone, y, reg, n_eval, mse,
    chosen), a row for each strength of ``regs``: the mean squared error on the evaluation dates, NULL without labelled
    rows there, in which case the first strength is chosen; of equal errors the earlier one is.

    A missing feature is at its mean. ``zscore`` takes means and deviations of the training window over all its rows;
    ``cs_zscore`` standardises within each date, and its models must be scored that way (:func:`score_linear` does).
    A feature with an infinity or without variance has weight 0. ``universe`` names a boolean column; only rows where it
    is true count. A milestone without a full evaluation window has no model, nor has a label without training rows.
    """
    if normaliser not in ("zscore", "cs_zscore"):
        raise ValueError(f"unknown normaliser {normaliser!r}")
    spark, x_columns, y_columns, dated = dataset.sparkSession, list(x_columns), list(y_columns), normaliser == "cs_zscore"
    days = spark.createDataFrame([(to_date(m),) for m in milestones], "milestone date").distinct()
    spans = split_dates(days, calendar, n_train, n_eval, n_lag).groupBy("milestone", "split").agg(F.min("date"), F.max("date"))
    windows = sorted(tuple(r) for r in spans.collect())  # two rows a milestone
    rows = dataset.where(F.col(f"`{universe}`")) if universe else dataset
    used = F.col("date").between(F.lit(min(w[2] for w in windows)), F.lit(max(w[3] for w in windows))) if windows else F.lit(False)
    rows = rows.where(used).select("date", *[F.col(f"`{c}`") for c in (*x_columns, *y_columns)])
    if dated:
        scaled = CrossSectionalZScore(x_columns).transform(rows)
        filled = [f"IF(abs(`{c}`) < DOUBLE('Infinity'), `{c}`, 0.0D) AS `{c}`" for c in x_columns]
        rows = scaled.selectExpr("date", *filled, *[f"`{c}`" for c in y_columns])
    products = written_table(date_products(rows, x_columns, y_columns), "products")
    sums = written_table(window_products(products, windows), "windows")

    def models(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        path, out = _path(group, regs, dated), []
        if path is not None:
            mean, std, fits, _, chosen, _ = path
            weights, intercept = fits[chosen]
            own = [(c, float(w), None, None) if dated else (c, float(w), float(m), float(s)) for c, w, m, s in zip(x_columns, weights, mean, std, strict=True)]
            out = [(prod, key[0], y_columns[key[1]], *row, normaliser) for row in ((INTERCEPT, float(intercept), None, None), *own)]
        return pd.DataFrame(out, columns=["prod", "milestone", "y", "feature", "weight", "mean", "std", "normaliser"])

    def errors(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        path, out = _path(group, regs, dated), []
        if path is not None:
            _, _, _, found, chosen, n = path
            out = [(prod, key[0], y_columns[key[1]], float(reg), n, e, i == chosen) for i, (reg, e) in enumerate(zip(regs, found, strict=True))]
        return pd.DataFrame(out, columns=["prod", "milestone", "y", "reg", "n_eval", "mse", "chosen"])

    by = sums.groupBy("milestone", "label")
    blank = {c: F.nanvl(c, F.lit(None).cast("double")) for c in ("mean", "std")}
    return (
        by.applyInPandas(models, f"{MODEL_SCHEMA}, normaliser string").withColumns(blank),
        by.applyInPandas(errors, "prod string, milestone date, y string, reg double, n_eval bigint, mse double, chosen boolean").withColumn(
            "mse", F.nanvl("mse", F.lit(None).cast("double"))
        ),
    )
