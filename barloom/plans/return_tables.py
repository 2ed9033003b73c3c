"""The return table and its lagged copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from barloom.operators.resample import KEYS
from barloom.operators.returns import (
    HALF_HOURS,
    HORIZONS,
    forward_returns,
    intraday_spans,
    lag_table,
    price_table,
    span_returns,
)


def return_table(
    bars_1m: DataFrame,
    calendar: DataFrame,
    factors: DataFrame | None = None,
    horizons: Sequence[int] = HORIZONS,
    price: str = "close",
) -> DataFrame:
    """Per symbol-day: n-day VWAP and price returns of the eight half hours, and 15 intraday returns.

    Columns ``rtn_v2v_{slot}_{n}D`` (VWAP to VWAP), ``rtn_o2o_{slot}_{n}D``
    (price to price at the slot) and the intraday names such as ``1000_1h``.
    The bars must reach ``max(horizons)`` trading days past the dates wanted.
    """
    spans = intraday_spans()
    slots = sorted({s for span in spans.values() for s in span})
    prices = price_table(bars_1m, slots, HALF_HOURS, price)
    prices = prices.select("*", *span_returns(prices, spans))
    adj = None
    if factors is not None:
        prices = prices.join(factors.select(*KEYS, "adj_factor"), list(KEYS), "left")
        adj = "adj_factor"
    columns = {f"rtn_v2v_{b}": f"vwap_{b}_{e}" for b, e in HALF_HOURS}
    columns |= {f"rtn_o2o_{b}": b for b, _ in HALF_HOURS}
    return forward_returns(prices, calendar, columns, horizons, adj, keep=list(spans))


def lag_return_table(returns: DataFrame, calendar: DataFrame) -> DataFrame:
    """The return table dated one trading day earlier, columns prefixed ``lag_``."""
    return lag_table(returns, calendar)


def with_intraday(daily: DataFrame, intraday: DataFrame) -> DataFrame:
    """n-day returns with the intraday returns of the same symbol-day."""
    return daily.join(intraday, list(KEYS), "left")


def return_columns(horizons: Sequence[int] = HORIZONS) -> list[str]:
    """Value columns of :func:`return_table`, in order."""
    kinds = [f"rtn_{kind}_{b}_{n}D" for kind in ("v2v", "o2o") for b, _ in HALF_HOURS for n in horizons]
    return kinds + list(intraday_spans())
