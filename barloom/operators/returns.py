"""Prices at slots, interval VWAP, intraday and multi-day returns.

All prices of a symbol-day come from one aggregate over the bars. Multi-day
returns then look ahead by calendar position with a RANGE frame, one shuffle by
symbol of rows that are already one per symbol-day: a suspended day gives NULL,
not the next traded price, and a symbol's group is bounded by the calendar.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.clock import minute_of, minute_of_day
from barloom.functions.durations import parse_duration
from barloom.functions.slots import ONE_MINUTE_SLOTS
from barloom.functions.values import prefixed, require_columns, simple_return
from barloom.operators.resample import KEYS, on_the_minute, slot_values, value_at

# The eight half hours, entered five minutes late, as (begin, end).
HALF_HOURS = (
    ("0935", "1000"), ("1005", "1030"), ("1035", "1100"), ("1105", "1130"),
    ("1305", "1330"), ("1335", "1400"), ("1405", "1430"), ("1435", "1500"),
)
HORIZONS = (1, 2, 3, 5)


def adjusted_bars(bars_1m: DataFrame, factors: DataFrame) -> DataFrame:
    """Minute bars with the daily adjustment factor of their symbol, NULL where there is none.

    Spark chooses the join by size. Tables bucketed alike by date and symbol
    (:mod:`barloom.sources.bucketed`) are joined where they lie.
    """
    return bars_1m.join(factors.select(*KEYS, "adj_factor"), list(KEYS), "left")


def _named(slot: str) -> str:
    """0935 -> 0930, 1305 -> 1300: the slot a window is named after."""
    return f"{int(slot) - 5:04d}"


def intraday_spans() -> dict[str, tuple[str, str]]:
    """Return name -> (start slot, end slot): every half hour, and every hour that ends by the close.

    An hour runs from the start of a half hour to the end of the next one, so
    the one that starts at 1105 spans lunch.
    """
    half = {f"{_named(b)}_30m": (b, e) for b, e in HALF_HOURS}
    hour = {f"{_named(b)}_1h": (b, e) for (b, _), (_, e) in itertools.pairwise(HALF_HOURS)}
    return half | hour


def span_returns(prices: DataFrame, spans: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Return columns of a frame whose price columns are named by slot."""
    require_columns(prices, {s for span in spans.values() for s in span})
    return [simple_return(F.col(f"`{e}`"), F.col(f"`{b}`")).alias(name) for name, (b, e) in spans.items()]


def intraday_returns(bars_1m: DataFrame, price: str = "close") -> DataFrame:
    """(date, symbol, 15 returns): half-hour and one-hour returns inside the day."""
    spans = intraday_spans()
    slots = sorted({s for span in spans.values() for s in span})
    prices = slot_values(bars_1m, slots, price)
    return prices.select(*KEYS, *span_returns(prices, spans))


def pairwise_returns(
    bars_1m: DataFrame, slots: str | Sequence[str], durations: str | Sequence[str] = "20m", price: str = "close"
) -> DataFrame:
    """``ret_{slot}_{minutes}m`` for every start slot and duration in trading minutes."""
    slots = [slots] if isinstance(slots, str) else list(slots)
    durations = [durations] if isinstance(durations, str) else list(durations)
    spans = {}
    for slot, duration in itertools.product(slots, durations):
        days, minutes = parse_duration(duration)
        if days or not duration.endswith("m"):
            raise ValueError(f"duration {duration!r} must be in minutes of one day")
        if slot not in ONE_MINUTE_SLOTS:
            raise ValueError(f"{slot!r} is not a bar of a trading session")
        end = ONE_MINUTE_SLOTS.index(slot) + minutes
        if end >= len(ONE_MINUTE_SLOTS):
            raise ValueError(f"{slot} + {duration} is past the close")
        spans[f"ret_{slot}_{minutes}m"] = (slot, ONE_MINUTE_SLOTS[end])
    prices = slot_values(bars_1m, sorted({s for span in spans.values() for s in span}), price)
    return prices.select(*KEYS, *span_returns(prices, spans))


def vwap_columns(windows: Iterable[tuple[str, str]], minute: str = "__m") -> list[Column]:
    """Volume-weighted average price of the bars after ``begin`` up to ``end``, per window."""
    m = F.col(minute)

    def total(value: str, begin: str, end: str) -> Column:
        return F.sum(F.when((m > minute_of(begin)) & (m <= minute_of(end)), F.col(value)))

    return [F.try_divide(total("amount", b, e), total("volume", b, e)).alias(f"vwap_{b}_{e}") for b, e in windows]


def interval_vwap(bars_1m: DataFrame, windows: Sequence[tuple[str, str]] = HALF_HOURS) -> DataFrame:
    """(date, symbol, vwap_{begin}_{end}...); NULL where nothing was traded."""
    require_columns(bars_1m, ("time", "amount", "volume", *KEYS))
    rows = bars_1m.select(*KEYS, "amount", "volume", minute_of_day("time").alias("__m"))
    first, last = min(minute_of(b) for b, _ in windows), max(minute_of(e) for _, e in windows)
    return rows.where((F.col("__m") > first) & (F.col("__m") <= last)).groupBy(*KEYS).agg(*vwap_columns(windows))


def price_table(
    bars_1m: DataFrame,
    close_slots: Sequence[str],
    vwap_windows: Sequence[tuple[str, str]] = HALF_HOURS,
    price: str = "close",
) -> DataFrame:
    """Slot prices (named by slot) and interval VWAPs of a symbol-day in one aggregate."""
    minute = minute_of_day("time").alias("__m")
    exact = F.when(on_the_minute("time"), minute_of_day("time")).alias("__at")
    rows = bars_1m.select(*KEYS, price, "amount", "volume", minute, exact)
    return rows.groupBy(*KEYS).agg(
        *[value_at(s, price, "__at").alias(s) for s in close_slots], *vwap_columns(vwap_windows)
    )


def forward_returns(
    prices: DataFrame,
    calendar: DataFrame,
    columns: Mapping[str, str],
    horizons: Sequence[int] = HORIZONS,
    adj: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """n-day forward returns of price columns, ``{name}_{n}D``.

    ``columns`` maps a result name to its price column and ``adj`` names the
    daily adjustment factor. The price n trading days ahead is taken by
    calendar position: no row that day means NULL. A row whose own date is not
    in the calendar stays, with NULL returns.
    """
    require_columns(prices, KEYS)
    positions = calendar.select("date", F.col("idx").alias("__idx"))
    located = prices.join(F.broadcast(positions), "date", "left")
    factor = f"`{adj}`" if adj else "1.0D"
    located = located.selectExpr(
        *KEYS, "__idx", *[f"`{c}`" for c in keep], *[f"`{p}` * {factor} AS `__{name}`" for name, p in columns.items()]
    )

    def ahead(name: str, n: int) -> str:
        frame = f"PARTITION BY symbol ORDER BY __idx RANGE BETWEEN {n} FOLLOWING AND {n} FOLLOWING"
        later = f"CASE WHEN __idx IS NOT NULL THEN max(`__{name}`) OVER ({frame}) END"
        return f"try_divide({later}, `__{name}`) - 1.0D AS `{name}_{n}D`"

    returns = [ahead(name, n) for name in columns for n in horizons]
    return located.selectExpr(*KEYS, *returns, *[f"`{c}`" for c in keep])


def lag_table(df: DataFrame, calendar: DataFrame, prefix: str = "lag_") -> DataFrame:
    """The same rows dated one trading day earlier, value columns prefixed.

    Rows of the first calendar day have no earlier day and are left out. Rows of a date that the calendar does not have
    stay, with a NULL date.
    """
    before = calendar.select("date", "prev", F.lit(True).alias("__known"))
    dated = df.join(F.broadcast(before), "date", "left").where("__known IS NULL OR prev IS NOT NULL")
    dated = dated.withColumn("date", F.col("prev")).drop("prev")
    return prefixed(dated.select(*df.columns), prefix)
