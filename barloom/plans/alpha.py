"""Alpha tables: predictions of a product, dated and timed for use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.clock import at_slot
from barloom.functions.dates import to_date
from barloom.functions.values import is_valid
from barloom.operators.calendar import is_trading_day
from barloom.operators.resample import KEYS
from barloom.plans.panel import online_features
from barloom.plans.products import product
from barloom.plans.scoring import score_linear
from barloom.sources.readers import in_dates, read_dataset
from barloom.sources.sinks import write_by_date


def to_next_trading_day(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Replace each date by the next trading date."""
    ahead = calendar.select("date", "next")
    return df.join(F.broadcast(ahead), "date", "left").select(
        *[F.col("next").alias("date") if c == "date" else F.col(f"`{c}`") for c in df.columns]
    )


def alpha_rows(predictions: DataFrame, prod: str, calendar: DataFrame) -> DataFrame:
    """(date, time, symbol, alpha) of a product's target label."""
    p = product(prod)
    used = to_next_trading_day(predictions, calendar) if p.next_day else predictions
    return used.select(
        "date", at_slot("date", F.lit(p.slot)).alias("time"), "symbol", F.col(f"`{p.target}`").alias("alpha")
    )


def alpha_history(
    dataset: DataFrame,
    models: DataFrame,
    prod: str,
    bars_stats: Sequence[str],
    calendar: DataFrame,
    begin,
    end,
    n_latest: int = 1,
    universe: str | None = None,
) -> DataFrame:
    """Alpha of every dataset date in [begin, end] in one job.

    ``bars_stats`` are the ``{bar}_{stat}`` features; the product gives the slots.
    """
    p = product(prod)
    x = [f"{b}_{s}" for s in p.slots for b in bars_stats]
    rows = read_dataset(
        dataset.sparkSession, dataset, [*KEYS, *x], universe=universe, date_range=(begin, end), date_col="date"
    )
    mine = models.where(F.col("prod") == prod)
    return alpha_rows(score_linear(rows, mine, x, p.y_columns, n_latest, date_range=(begin, end)), prod, calendar)


def alpha_online(
    bars_1m: DataFrame,
    models: DataFrame,
    prod: str,
    bars: Sequence[str],
    calendar: DataFrame,
    date,
    n_latest: int = 1,
    universe: DataFrame | None = None,
) -> DataFrame | None:
    """Alpha of one day from its minute bars; None when it is no trading day."""
    day = to_date(date)
    if not is_trading_day(calendar, day):
        return None
    p = product(prod)
    x = [f"{b}_{o}_{s}" for s in p.slots for b in bars for o in ("mean", "std")]
    members = in_dates(universe, day, day) if universe is not None else None
    features = online_features(
        in_dates(bars_1m, day, day), bars, (p.x_begin, p.x_end), members, one_day=True
    )
    mine = models.where(F.col("prod") == prod)
    return alpha_rows(score_linear(features, mine, x, p.y_columns, n_latest, date_range=(day, day)), prod, calendar)


def alpha_validity(alpha: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """Rows and usable values (neither NULL nor NaN) per group."""
    return alpha.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(is_valid("alpha"), F.lit(False))).alias("n_valid")
    )


def write_alpha(alpha: DataFrame, path: str, prod: str) -> None:
    """Write by product and date, replacing only the dates at hand.

    A row without a date fails the write: its alpha is for a day past the end of
    the calendar it was dated with, which must reach a day further.
    """
    missing = F.raise_error(F.lit("alpha without a date: the calendar ends too early")).cast("date")
    write_by_date(alpha.withColumns({"prod": F.lit(prod), "date": F.coalesce("date", missing)}), path, ("prod", "date"))
