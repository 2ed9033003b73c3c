"""Scoring whole date ranges with the latest n models of each date, and averaging them."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.dates import to_date
from barloom.functions.values import nan_to_null
from barloom.operators.asof import latest_versions
from barloom.operators.resample import KEYS
from barloom.operators.scaling import CrossSectionalZScore
from barloom.plans.training import INTERCEPT


def usable_parameters(models: DataFrame) -> DataFrame:
    """Model rows with NaN as NULL, which counts as absent: a weight of 0, or a feature without mean or deviation."""
    return nan_to_null(models, ["weight", "mean", "std"])


def _packed(models: DataFrame, x_columns: Sequence[str]) -> DataFrame:
    """(milestone, y, bias, terms): the terms of a model as one array of (pos, weight, mean, std).

    Terms of one feature add up; a model of an intercept alone has no terms.
    """
    spark = models.sparkSession
    order = spark.createDataFrame([(c, i) for i, c in enumerate(x_columns)], "feature string, pos int")
    known = usable_parameters(models).join(F.broadcast(order), "feature", "left")
    own = F.col("feature") != INTERCEPT
    unknown = F.concat(F.lit("model feature is not among the inputs: "), F.col("feature"))
    pos = F.when(F.col("pos").isNotNull(), F.col("pos")).otherwise(F.raise_error(unknown).cast("int"))
    term = F.when(own, F.struct(pos.alias("pos"), "weight", "mean", "std"))
    bias = F.coalesce(F.sum(F.when(~own, F.col("weight"))), F.lit(0.0))
    return known.groupBy("milestone", "y").agg(F.sort_array(F.collect_list(term)).alias("terms"), bias.alias("bias"))


def linear_predictions(
    df: DataFrame,
    models: DataFrame,
    x_columns: Sequence[str],
    n_latest: int,
    index: Sequence[str] = KEYS,
    dates: DataFrame | None = None,
) -> DataFrame:
    """(index, milestone, rank, y, pred): a prediction per row, label and each of its latest models.

    The single models behind :func:`score_linear`, which is the faster way to
    their mean. A missing feature adds nothing, as if at its mean; a row
    without any feature has a NULL prediction. Dates before the first model
    have no row, nor has a label without a model at a milestone.
    """
    x = nan_to_null(df.selectExpr(*index, *[f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in x_columns]))
    packed = x.selectExpr(*index, f"array({', '.join(f'`{c}`' for c in x_columns)}) AS __x")
    picks = latest_versions(dates if dates is not None else df.select("date"), models, n_latest)
    plan = _packed(models, x_columns)

    def term(t):
        return F.try_divide(F.get("__x", t["pos"]) - t["mean"], t["std"]) * t["weight"]

    total = F.aggregate(
        "terms", F.lit(0.0), lambda acc, t: acc + F.coalesce(term(t), F.lit(0.0)), lambda acc: acc + F.col("bias")
    )
    present = F.exists("__x", lambda v: v.isNotNull())
    return (
        packed.join(F.broadcast(picks), "date")
        .join(plan, "milestone")
        .select(*index, "milestone", "rank", "y", F.when(present, total).alias("pred"))
    )


def ensemble(
    predictions: DataFrame, y_columns: Sequence[str], n_latest: int | Sequence[int], index: Sequence[str] = KEYS
) -> DataFrame:
    """Mean of the latest n predictions per label; with several n, one row per n in ``n_latest``.

    All n are averaged in one pass over the predictions. Rows of one index are
    one row here; :func:`score_linear` keeps them apart.
    """
    ns = [n_latest] if isinstance(n_latest, int) else list(n_latest)
    means = [
        F.avg(F.when((F.col("y") == y) & (F.col("rank") <= n), F.col("pred"))).alias(f"__{n}_{y}")
        for n in ns
        for y in y_columns
    ]
    by_key = predictions.groupBy(*index).agg(*means)
    if isinstance(n_latest, int):
        return by_key.select(*index, *[F.col(f"`__{n_latest}_{y}`").alias(y) for y in y_columns])
    rows = F.array(
        *[F.struct(F.lit(n).alias("n_latest"), *[F.col(f"`__{n}_{y}`").alias(y) for y in y_columns]) for n in ns]
    )
    return by_key.select(*index, F.inline(rows))


def score_linear(
    df: DataFrame,
    models: DataFrame,
    x_columns: Sequence[str],
    y_columns: Sequence[str],
    n_latest: int | Sequence[int] = 1,
    index: Sequence[str] = KEYS,
    dates: DataFrame | None = None,
    date_range: tuple | None = None,
) -> DataFrame:
    """Mean prediction of each row's latest n models, one column per label.

    With several n there is one row per n, in ``n_latest``. A label without a
    model at a milestone is not averaged there, and NULL if no milestone has
    one; a model may be an intercept alone; terms of one feature add up; rows
    keep their multiplicity. Dates before the first model have no row.

    Models are sent to the tasks and applied as matrix products, batch by
    batch: rows are neither shuffled nor repeated. Long histories of models are
    cut into spans of at most ``SENT_BYTES``; each span is scored over its own
    dates. With ``date_range`` (first, last) or ``dates``, whose first and last
    then count, only models of use to these are fetched; a row dated outside
    fails the job, since its models may be missing. A row without a date has no
    models and no result.

    Models may carry a ``normaliser``: one that says ``cs_zscore`` takes its
    features standardised within the row's date, over the rows of ``df``.
    """
    ns = [n_latest] if isinstance(n_latest, int) else list(n_latest)
    wanted = usable_parameters(models.where(F.col("y").isin(list(y_columns))))
    milestones = sorted(r[0] for r in wanted.select("milestone").distinct().collect())  # some of the calendar's days
    first, last = 0, len(milestones)
    span = None
    if date_range is not None:
        span = to_date(date_range[0]), to_date(date_range[1])
    elif dates is not None:
        span = tuple(dates.agg(F.min("date"), F.max("date")).first())
    if span is not None:
        if span[0] is None:
            span, last = (dt.date.max, dt.date.min), 0
        else:
            first = max(0, bisect_right(milestones, span[0]) - 1)
            last = bisect_right(milestones, span[1])
    if "normaliser" in wanted.columns and wanted.where(F.col("normaliser") == "cs_zscore").limit(1).count():
        df = CrossSectionalZScore(x_columns).with_statistics(df)
    at_once = max(1, SENT_BYTES // (16 * max(1, len(x_columns) * len(y_columns))) - max(ns))
    out = None
    for start in range(first, max(last, first + 1), at_once):
        own = milestones[max(0, start - max(ns) + 1) : min(last, start + at_once)]
        rows = df
        if start > first:
            rows = rows.where(F.col("date") >= F.lit(milestones[start]))
        if start + at_once < last:
            rows = rows.where(F.col("date") < F.lit(milestones[start + at_once]))
        used = wanted.where(F.col("milestone").between(own[0], own[-1])) if own else wanted.limit(0)
        part = _score_span(rows, used, x_columns, y_columns, n_latest, index, span)
        out = part if out is None else out.unionAll(part)
    return out


#: Bytes of models sent to the tasks at once.
SENT_BYTES = 64 * 1024 * 1024
#: Bytes of features of a batch that are worked on at once.
SLICE_BYTES = 16 * 1024 * 1024


def _dense_models(models: DataFrame, x_columns: Sequence[str], y_columns: Sequence[str]) -> tuple[np.ndarray, list]:
    """Sorted milestones (days since 1970) and for each (slope, offset, bias, known, dated), shaped by feature and label.

    ``dated`` says for each label that the model takes features standardised within their date.
    """
    at = {c: i for i, c in enumerate(x_columns)}
    label = {y: j for j, y in enumerate(y_columns)}
    parts: dict = {}
    # The caller has bounded the number of milestones.
    kind = "normaliser" if "normaliser" in models.columns else "CAST(NULL AS STRING) AS normaliser"
    for m in models.selectExpr("milestone", "y", "feature", "weight", "mean", "std", kind).collect():
        shape, n = (len(at), len(label)), len(label)
        if m["milestone"] not in parts:
            parts[m["milestone"]] = np.zeros(shape), np.zeros(shape), np.zeros(n), np.zeros(n, bool), np.zeros(n, bool)
        slope, offset, bias, known, dated = parts[m["milestone"]]
        j, weight = label[m["y"]], m["weight"] or 0.0
        known[j] = True
        dated[j] |= m["normaliser"] == "cs_zscore"
        if m["feature"] == INTERCEPT:
            bias[j] += weight
        elif m["feature"] not in at:
            raise ValueError(f"model feature is not among the inputs: {m['feature']}")
        elif m["normaliser"] == "cs_zscore":
            slope[at[m["feature"]], j] += weight
        elif m["std"] and m["mean"] is not None:
            i = at[m["feature"]]
            slope[i, j] += weight / m["std"]
            offset[i, j] += weight / m["std"] * m["mean"]
    order = sorted(parts)
    days = np.array([(d - dt.date(1970, 1, 1)).days for d in order], dtype="int64")
    return days, [parts[d] for d in order]


def _mean_of(predictions: list[np.ndarray]) -> np.ndarray:
    """Mean over the models that there are; NaN where there is none."""
    stacked = np.stack(predictions)
    there = ~np.isnan(stacked)
    count = there.sum(axis=0)
    return np.where(count > 0, np.where(there, stacked, 0.0).sum(axis=0) / np.maximum(count, 1), np.nan)


def _score_span(df, models, x_columns, y_columns, n_latest, index, span=None) -> DataFrame:
    ns = [n_latest] if isinstance(n_latest, int) else list(n_latest)
    several, index, y_columns, k = not isinstance(n_latest, int), list(index), list(y_columns), len(x_columns)
    shared = df.sparkSession.sparkContext.broadcast(_dense_models(models, x_columns, y_columns))
    x = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in x_columns)
    stats = ["__m", "__s"] if "__m" in df.columns else []
    blank = "transform(array_repeat(0, {}), v -> CAST(NULL AS DOUBLE))".format(k)
    rows = df.selectExpr(*index, f"array({x}) AS __x", *[f"coalesce({c}, {blank}) AS {c}" for c in stats])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in ("__x", *stats)]
    bounds = None if span is None else [(d - dt.date(1970, 1, 1)).days for d in span]
    fields += (["n_latest int"] if several else []) + [f"`{y}` double" for y in y_columns]
    step = max(1, SLICE_BYTES // (8 * max(1, k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        milestones, parts = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                yield from score(whole.slice(start, step), milestones, parts)

    def score(batch: pa.RecordBatch, milestones: np.ndarray, parts: list) -> Iterator[pa.RecordBatch]:
        days = batch.column(index.index("date"))
        dated = np.flatnonzero(days.is_valid().to_numpy(zero_copy_only=False))
        upto = np.zeros(batch.num_rows, "int64")
        known_days = days.drop_null().cast(pa.int32()).to_numpy(zero_copy_only=False)
        if bounds and len(known_days) and (known_days.min() < bounds[0] or known_days.max() > bounds[1]):
            raise ValueError("rows are dated outside of the dates given for scoring")
        upto[dated] = np.searchsorted(milestones, known_days, side="right")
        keep = np.flatnonzero(upto > 0)
        if not len(keep):
            return
        data, *of_date = (
            batch.column(len(index) + i).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)[keep] for i in range(1 + len(stats))
        )
        upto, present = upto[keep], ~np.isnan(data)
        filled, mask = np.where(present, data, 0.0), present.astype("float64")
        if of_date:  # a feature without a deviation within its date is at its mean, 0
            with np.errstate(divide="ignore", invalid="ignore"):
                within = (data - of_date[0]) / of_date[1]
            within[~np.isfinite(within)] = 0.0
        means = np.full((len(ns), len(keep), len(y_columns)), np.nan)
        for last in np.unique(upto):
            at = np.flatnonzero((upto == last) & present.any(axis=1))
            preds = []
            for slope, offset, bias, known, own_date in parts[max(0, last - max(ns)) : last]:
                each = filled[at] @ slope - mask[at] @ offset
                if own_date.any():
                    each[:, own_date] = within[at] @ slope[:, own_date]
                preds.append(np.where(known, each + bias, np.nan))
            for i, n in enumerate(ns):
                means[i, at] = _mean_of(preds[-n:])
        kept = [c.take(pa.array(keep)) for c in batch.columns[: len(index)]]
        for i, n in enumerate(ns):
            out = kept + ([pa.array(np.full(len(keep), n, dtype="int32"))] if several else [])
            out += [pa.array(means[i, :, j], from_pandas=True) for j in range(len(y_columns))]
            yield pa.RecordBatch.from_arrays(out, names=[*index, *(["n_latest"] if several else []), *y_columns])

    return rows.mapInArrow(run, ", ".join(fields))


def score_with(
    matrices: DataFrame,
    model: Callable[..., np.ndarray],
    y_columns: Sequence[str],
    shape: tuple[int, int],
    by: str | None = None,
    x: str = "x",
) -> DataFrame:
    """Apply any vectorised model to feature matrices, one Arrow batch at a time.

    ``model(x)`` gets an (n, slots, features) array, NULL as NaN (a NULL matrix
    is all NaN), and returns
    (n, len(y_columns)). With ``by``, it is called as ``model(x, value)`` for
    the rows of each value of that column in the batch (e.g. a milestone).
    Rows keep their partitions; nothing is grouped or shuffled.
    """
    keep = [c for c in matrices.columns if c != x]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in matrices.schema.fields if f.name != x])
    schema += "".join(f", `{y}` double" for y in y_columns)
    width = len(y_columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            column = batch.column(batch.schema.get_field_index(x))
            there = column.is_valid().to_numpy(zero_copy_only=False)
            data = np.full((batch.num_rows, *shape), np.nan)
            cells = column.drop_null().flatten().flatten()
            data[there] = cells.to_numpy(zero_copy_only=False).astype("float64").reshape(-1, *shape)
            if by is None:
                pred = np.asarray(model(data), dtype="float64")
            else:
                values = np.asarray(batch.column(batch.schema.get_field_index(by)).to_pylist(), dtype=object)
                pred = np.empty((batch.num_rows, width))
                for value in set(values.tolist()):
                    rows = np.flatnonzero(values == value)
                    pred[rows] = model(data[rows], value)
            pred = pred.reshape(batch.num_rows, width)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            columns += [pa.array(pred[:, i]) for i in range(width)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *y_columns])

    return matrices.mapInArrow(run, schema)


def score_versions(
    matrices: DataFrame,
    versions: DataFrame,
    model: Callable[[np.ndarray, object], np.ndarray],
    y_columns: Sequence[str],
    shape: tuple[int, int],
    n_latest: int = 1,
    index: Sequence[str] = KEYS,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Ensemble mean of any model over its latest n versions at each row's date.

    ``dates`` has the dates of ``matrices``; without it they are computed once more to find these.
    """
    picks = latest_versions(dates if dates is not None else matrices.select("date"), versions, n_latest)
    rows = matrices.select(*index, "x").join(F.broadcast(picks), "date")
    scored = score_with(rows.select(*index, "milestone", "x"), model, y_columns, shape, by="milestone")
    return nan_to_null(scored.groupBy(*index).agg(*[F.avg(f"`{y}`").alias(y) for y in y_columns]), y_columns)


