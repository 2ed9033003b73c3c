"""Training a linear model per milestone, stored as rows.

models(prod, milestone, y, feature, weight, mean, std): one row per feature of
a model, plus the row ``(intercept)``. A missing feature counts as its training
mean, in training as in scoring.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.dates import to_date
from barloom.operators.scaling import ZScore
from barloom.operators.splits import split_ranges, tag_split

INTERCEPT = "(intercept)"
MODEL_SCHEMA = "prod string, milestone date, y string, feature string, weight double, mean double, std double"


def standardised_vectors(df: DataFrame, scaler: ZScore, x_columns: Sequence[str], y_columns: Sequence[str]) -> DataFrame:
    """(__x, labels): all features as one standardised vector.

    A missing feature is at its mean, 0; so is one without variance, which carries nothing.
    """
    mean, std = (F.array(*[F.lit(scaler.params[c][i]).cast("double") for c in x_columns]) for i in (0, 1))
    labels = [f"nanvl(CAST(`{y}` AS DOUBLE), CAST(NULL AS DOUBLE)) AS `{y}`" for y in y_columns]
    raw = df.selectExpr(f"array({', '.join(f'CAST(`{c}` AS DOUBLE)' for c in x_columns)}) AS __x", *labels)

    def cell(v, i):
        return F.coalesce(F.try_divide(F.nanvl(v, F.lit(None).cast("double")) - F.get(mean, i), F.get(std, i)), F.lit(0.0))

    return raw.select(array_to_vector(F.transform("__x", cell)).alias("__x"), *[F.col(f"`{y}`") for y in y_columns])


def train_linear(
    train: DataFrame, x_columns: Sequence[str], y_columns: Sequence[str], prod: str, milestone, reg: float = 0.0
) -> DataFrame:
    """Fit one linear model per label on standardised features; returns model rows.

    The fit is distributed (sums over partitions, combined in a tree); what
    comes to the driver is one coefficient per feature. NaN counts as NULL, in
    features and in labels.
    """
    spark, x_columns = train.sparkSession, list(x_columns)
    scaler = ZScore.fit(train, x_columns)
    z = standardised_vectors(train, scaler, x_columns, y_columns)
    rows = []
    for y in y_columns:
        labelled = z.where(F.col(f"`{y}`").isNotNull()).select("__x", F.col(f"`{y}`").alias("__y"))
        fit = LinearRegression(featuresCol="__x", labelCol="__y", regParam=reg, standardization=False).fit(labelled)
        rows.append((prod, to_date(milestone), y, INTERCEPT, float(fit.intercept), None, None))
        rows += [
            (prod, to_date(milestone), y, c, float(w), *scaler.params[c]) for c, w in zip(x_columns, fit.coefficients)
        ]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def train_on_milestone(
    dataset: DataFrame,
    calendar: DataFrame,
    x_columns: Sequence[str],
    y_columns: Sequence[str],
    prod: str,
    milestone,
    *,
    n_train: int = 1000,
    n_eval: int = 30,
    n_lag: int = 5,
    n_test: int = 0,
    reg: float = 0.0,
) -> tuple[DataFrame, DataFrame]:
    """(model rows, split-tagged data) of one milestone; only earlier data is used for the fit."""
    ranges = split_ranges(calendar, milestone, n_train, n_eval, n_lag, n_test)
    tagged = tag_split(dataset, ranges)
    models = train_linear(tagged.where(F.col("split") == "train"), x_columns, y_columns, prod, milestone, reg)
    return models, tagged
