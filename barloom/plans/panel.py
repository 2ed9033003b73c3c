"""From minute bars to features: batch downsampling and the online feature source."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.slots import TEN_MINUTE_SLOTS, trading_slots
from barloom.functions.values import nan_to_null
from barloom.operators.resample import KEYS, MEAN_STD, bars_at, resample_blocks, widen_blocks


def downsample_wide(
    bars_1m: DataFrame, bars: Sequence[str] | None = None, slots: Sequence[str] = TEN_MINUTE_SLOTS
) -> DataFrame:
    """1-minute bars -> one row per symbol-day with ``{bar}_{mean|std}_{slot}`` as 32-bit floats."""
    if bars is None:
        bars = [c for c in bars_1m.columns if c not in ("time", *KEYS)]
    return widen_blocks(resample_blocks(bars_1m, bars, MEAN_STD), slots, as_float=True)


def online_features(
    bars_1m: DataFrame,
    bars: Sequence[str],
    slot_range: tuple[str, str],
    universe: DataFrame | None = None,
    fill_nan: bool = True,
    one_day: bool = False,
) -> DataFrame:
    """Wide features of the symbol-days with every one-minute bar of the range.

    ``universe`` holds the (date, symbol) members. With ``one_day``, the
    caller's word that it has the symbols of a single day, membership is
    broadcast to the minute bars, otherwise it is applied to the ten-minute
    rows; so the minute bars are never shuffled for it.
    Completeness is likewise applied after the aggregation.
    """
    minutes = trading_slots(*slot_range, closed="right")
    rows = bars_at(bars_1m, minutes)
    small = universe is not None and one_day
    if small:
        rows = rows.join(F.broadcast(universe.select(*KEYS)), list(KEYS), "left_semi")
    stats = resample_blocks(rows, bars, MEAN_STD, outside=True)
    placed = stats.rows.repartition(*[F.col(k) for k in KEYS])
    if universe is not None and not small:
        placed = placed.join(universe.select(*KEYS), list(KEYS), "left_semi")
    # A symbol-day has at most 24 windows of a few blocks; the first block tells its bars.
    seen = F.sum(F.when(F.col("block") == 0, F.col("seen"))).over(W.partitionBy(*KEYS))
    whole = placed.withColumn("__seen", seen).where(F.col("__seen") == len(minutes)).drop("__seen")
    slots = trading_slots(*slot_range, freq=10, closed="right")
    wide = widen_blocks(replace(stats, rows=whole), slots, placed=True)
    return nan_to_null(wide) if fill_nan else wide


def slot_range_features(
    bars_1m: DataFrame,
    bars: Sequence[str],
    slot_range: tuple[str, str],
    universe: DataFrame | None = None,
    fill_nan: bool = True,
) -> DataFrame:
    """Wide features of a slot range without the completeness rule.

    With a universe, every member has a row, with NULLs where it has no bars.
    """
    slots = trading_slots(*slot_range, freq=10, closed="right")
    rows = bars_at(bars_1m, trading_slots(*slot_range, closed="right"))
    wide = widen_blocks(resample_blocks(rows, bars, MEAN_STD), slots)
    if universe is not None:
        wide = universe.select(*KEYS).join(wide, list(KEYS), "left")
    return nan_to_null(wide) if fill_nan else wide
