"""Leak-free walk-forward splits around milestone dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.dates import to_date
from barloom.operators.calendar import ordinals


def _bounds(milestones: DataFrame, calendar: DataFrame, n_train: int, n_eval: int, n_lag: int, n_test: int) -> DataFrame:
    """(milestone, split, lo, hi): calendar positions of each split, clipped to the calendar.

    With i the number of trading dates up to and including the milestone:
    evaluation is [i - lag - eval, i - lag), training the n_train dates before
    it, test the n_test dates from i on.
    """
    pos = ordinals(milestones, calendar, "milestone")
    i = F.col("__before") + F.col("__trading").cast("long")
    ev = i - n_lag - n_eval
    parts = [
        ("train", F.greatest(ev - n_train, F.lit(0)), ev - 1),
        ("eval", ev, i - n_lag - 1),
        ("test", i, F.least(i + n_test, F.col("__total")) - 1),
    ]
    return pos.select(
        F.col("__d").alias("milestone"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("split"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
                    for name, lo, hi in parts
                ]
            )
        ),
    )


def split_dates(
    milestones: DataFrame, calendar: DataFrame, n_train: int = 1000, n_eval: int = 30, n_lag: int = 5, n_test: int = 0
) -> DataFrame:
    """(milestone, date, split) for many milestones at once.

    Every row comes from a milestone's own range of positions, so milestones
    are not paired with dates they do not use. A milestone without a full
    evaluation range has no row.
    """
    bounds = _bounds(milestones, calendar, n_train, n_eval, n_lag, n_test)
    usable = bounds.where((F.col("split") == "eval") & (F.col("lo") >= 0)).select("milestone")
    spans = bounds.join(usable, "milestone", "left_semi").where(F.col("lo") <= F.col("hi"))
    wanted = spans.select("milestone", "split", F.explode(F.sequence("lo", "hi")).alias("idx"))
    return wanted.join(F.broadcast(calendar.select("idx", "date")), "idx").select("milestone", "date", "split")


def split_ranges(
    calendar: DataFrame, milestone, n_train: int = 1000, n_eval: int = 30, n_lag: int = 5, n_test: int = 0
) -> dict[str, tuple[dt.date, dt.date]]:
    """First and last date of each split for one milestone; ``test`` only when n_test > 0."""
    spark = calendar.sparkSession
    one = spark.range(1).select(F.lit(to_date(milestone)).alias("milestone"))
    bounds = {r["split"]: r for r in _bounds(one, calendar, n_train, n_eval, n_lag, n_test).collect()}
    if bounds["eval"]["lo"] < 0:
        raise ValueError(f"not enough trading dates before {milestone} for {n_eval} evaluation dates")
    wanted = ["train", "eval"] + (["test"] if n_test else [])
    empty = [s for s in wanted if bounds[s]["lo"] > bounds[s]["hi"]]
    if empty:
        raise ValueError(f"no trading dates left for {empty} at {milestone}")
    ends = {p for s in wanted for p in (bounds[s]["lo"], bounds[s]["hi"])}
    at = {r["idx"]: r["date"] for r in calendar.where(F.col("idx").isin([int(p) for p in ends])).collect()}
    return {s: (at[bounds[s]["lo"]], at[bounds[s]["hi"]]) for s in wanted}


def tag_split(df: DataFrame, ranges: dict[str, tuple], date_col: str = "date") -> DataFrame:
    """Rows inside the given inclusive date ranges with their ``split``; a row in two ranges comes twice."""
    spans = {name: (to_date(b), to_date(e)) for name, (b, e) in ranges.items()}
    names = F.array_compact(
        F.array(*[F.when(F.col(date_col).between(F.lit(b), F.lit(e)), F.lit(name)) for name, (b, e) in spans.items()])
    )
    # A plain range on the date as well, so that partitions outside all splits are never read.
    low, high = min(b for b, _ in spans.values()), max(e for _, e in spans.values())
    return df.where(F.col(date_col).between(F.lit(low), F.lit(high))).select(
        *[F.col(c) for c in df.columns], F.explode(names).alias("split")
    )


def split_sizes(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
