"""Normalisers: per column over the training rows, or per date over the cross-section."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.moments import finite, mean_and_std, wide_moments

#: Statistics that may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


#: Columns that are aggregated side by side; more go through vectors.
FEW = 32


def statistics(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """(key, mean, std): arrays over ``columns``, for each date of ``key`` (a NULL one too) or for all rows.

    NaN counts as NULL. A statistic that is not finite, as of a column with an infinity, is NULL.
    """
    if len(columns) > FEW:
        return mean_and_std(wide_moments(df, columns, key))
    own = [f"`{key}` AS key" if key else "CAST(NULL AS DATE) AS key"]
    own += [f"nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)) AS v{i}" for i, c in enumerate(columns)]
    both = [f(f"v{i}").alias(f"{name}{i}") for i in range(len(columns)) for name, f in (("m", F.avg), ("s", F.stddev_samp))]
    made = df.selectExpr(*own).groupBy("key").agg(*both) if both else df.selectExpr(*own).distinct()
    arrays = [f"array({', '.join(finite(f'{n}{i}') for i in range(len(columns)))}) AS {name}" for n, name in (("m", "mean"), ("s", "std"))]
    return made.selectExpr("key", *arrays)


@dataclass(frozen=True)
class ZScore:
    """Mean and sample standard deviation per column, as fitted on training rows."""

    params: dict[str, tuple[float | None, float | None]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> ZScore:
        """Two numbers per column come to the driver, nothing else. NaN counts as NULL.

        A column with an infinity has no finite statistics: it gets NULLs, and is NULL when transformed.
        """
        found = statistics(df, columns).collect()
        pairs = zip(found[0]["mean"], found[0]["std"]) if found else ((None, None) for _ in columns)
        return cls(dict(zip(columns, pairs)))

    def transform(self, df: DataFrame) -> DataFrame:
        """The fitted columns standardised, the others as they are."""

        def number(v: float | None) -> str:
            return "CAST(NULL AS DOUBLE)" if v is None else f"{v!r}D"

        def cell(c: str) -> str:
            if c not in self.params:
                return f"`{c}`"
            mean, std = map(number, self.params[c])
            return f"try_divide(`{c}` - {mean}, {std}) AS `{c}`"

        return df.selectExpr(*map(cell, df.columns))

    def to_table(self, spark: SparkSession) -> DataFrame:
        """(feature, mean, std) rows."""
        rows = [(c, m, s) for c, (m, s) in self.params.items()]
        return spark.createDataFrame(rows, "feature string, mean double, std double")


class CrossSectionalZScore:
    """Standardise each column within its date.

    Date statistics come from partial sums (of a few columns) or vectors (of
    many) and are joined back as two arrays a date, so a date is never gathered
    in one task. NaN counts as NULL; a row without a date stays, its columns
    NULL, and so does a column whose date holds an infinity.
    ``days``: the caller's word that there are so many dates at most; where
    their statistics stay under ``BROADCAST_BYTES`` they are broadcast,
    otherwise Spark chooses the join when it runs.
    """

    def __init__(self, columns: Sequence[str], date_col: str = "date", days: int | None = None):
        self.columns, self.date_col, self.days = list(columns), date_col, days

    def with_statistics(self, df: DataFrame) -> DataFrame:
        """``df`` with two arrays of its date, ``__m`` and ``__s``, NULL without a date."""
        stats = statistics(df, self.columns, self.date_col).where("key IS NOT NULL")
        stats = stats.selectExpr("key AS __day", "mean AS __m", "std AS __s")
        if self.days is not None and self.days * len(self.columns) * 16 <= BROADCAST_BYTES:
            stats = F.broadcast(stats)
        return df.join(stats, F.col(self.date_col) == F.col("__day"), "left").drop("__day")

    def transform(self, df: DataFrame) -> DataFrame:
        at = {c: i for i, c in enumerate(self.columns)}
        joined = self.with_statistics(df)

        def cell(c: str) -> str:
            if c not in at:
                return f"`{c}`"
            return f"try_divide(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)) - __m[{at[c]}], __s[{at[c]}]) AS `{c}`"

        return joined.selectExpr(*map(cell, df.columns))


def normaliser(name: str, train: DataFrame, columns: Sequence[str]):
    """``zscore`` fitted on the training rows, or ``cs_zscore`` per date."""
    if name == "zscore":
        return ZScore.fit(train, columns)
    if name == "cs_zscore":
        return CrossSectionalZScore(columns)
    raise ValueError(f"unknown normaliser {name!r}")
