"""Session-aware downsampling of one-minute bars, long to wide and back.

Plan at scale: the one-minute rows are reduced to partial aggregates before the
first shuffle (ten rows to one), so a hot symbol-day costs one partial row per
task. The second shuffle, by (date, symbol), carries only ten-minute rows, of
which a symbol-day has at most 24. Rows are widened after that shuffle, never
before it.

Where the ten bars of a window lie in different tasks, nothing is reduced before
the first shuffle, and a partial row has five numbers for each value. Long rows
of many bars are therefore made where the minute rows are placed: each is moved
once, and blocks, aggregates and pivot stay there.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.clock import in_session, int_div, minute_of, minute_of_day
from barloom.functions.slots import TEN_MINUTE_SLOTS
from barloom.functions.values import require_columns

KEYS = ("date", "symbol")
# Bars aggregated side by side. Each has a mean (two buffer fields) and a deviation (three), and
# generated code stops at 100 fields a row.
BLOCK = 12

STATS = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "skew": F.skewness,
    "kurt": F.kurtosis,
}
ALL_STATS = tuple(STATS)
MEAN_STD = ("mean", "std")


def stat_names(bars: Iterable[str], ops: Sequence[str] = ALL_STATS) -> list[str]:
    """``{bar}_{op}`` names, bar by bar."""
    return [f"{b}_{o}" for b, o in itertools.product(bars, ops)]


def slot_names(values: Iterable[str], slots: Iterable[str] = TEN_MINUTE_SLOTS) -> list[str]:
    """``{value}_{slot}`` names, value by value."""
    return [f"{v}_{s}" for v, s in itertools.product(values, list(slots))]


def stat_columns(bars: Iterable[str], ops: Sequence[str] = ALL_STATS) -> list[Column]:
    """One aggregate per bar and statistic, named ``{bar}_{op}``.

    Standard deviation is the sample one; skew and (excess) kurtosis are the
    population ones. A group without variance gives NULL for the last two.
    """
    unknown = [o for o in ops if o not in STATS]
    if unknown:
        raise ValueError(f"unknown statistics {unknown}; choose from {list(STATS)}")
    return [STATS[o](F.col(b)).alias(f"{b}_{o}") for b, o in itertools.product(bars, ops)]


def window_number(time: Column | str) -> Column:
    """Number in the day of the ten-minute window [hh:m1, hh:m1 + 9 min] a time would belong to."""
    return int_div(minute_of_day(time) - 1, 10)


def window_label(number: Column) -> Column:
    """End of the n-th ten-minute window of the day as ``HHMM``.

    Looked up, so that a filter on the label costs little where it is pushed to.
    """
    ends = [10 * (i + 1) for i in range(143)]
    return F.get(F.array(*[F.lit(f"{e // 60:02d}{e % 60:02d}") for e in ends]), number)


def inside_window(time: Column | str) -> Column:
    """False for a bar between the end of one window and the start of the next (e.g. 09:40:30)."""
    t = F.col(time) if isinstance(time, str) else time
    return (F.minute(t) % 10 != 0) | (F.date_part(F.lit("SECOND"), t) == 0)


@dataclass(frozen=True)
class BlockStats:
    """Ten-minute statistics, a block of bars per row.

    ``rows`` has (date, symbol, window, block, v{i}_{op}..., count, seen): the
    i-th bar of a block under a neutral name, so that any number of bars
    aggregates with the same few columns.
    """

    rows: DataFrame
    bars: tuple[str, ...]
    ops: tuple[str, ...]

    @property
    def blocks(self) -> list[tuple[str, ...]]:
        return list(itertools.batched(self.bars, BLOCK))

    @property
    def values(self) -> list[str]:
        return stat_names([f"v{i}" for i in range(min(BLOCK, len(self.bars)))], self.ops)


def place(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows placed by the keys, in as many places as the session has shuffle partitions.

    The number is given, so that adaptive execution does not merge places by the
    size of rows that are made many times wider there.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def resample_blocks(
    bars_1m: DataFrame, bars: Sequence[str], ops: Sequence[str] = MEAN_STD, outside: bool = False, together: bool = False
) -> BlockStats:
    """Ten-minute statistics of one-minute bars, in blocks of at most 12 bars.

    Hundreds of aggregates in one row are beyond generated code: a row is
    therefore first cut into blocks, each aggregated by (symbol-day, window,
    block). With few bars there is one block and nothing is cut. ``count`` is
    the number of bars in the window. With ``outside``, bars between a window
    and the next are counted too, as ``seen``; no statistic includes them.
    With ``together``, rows of several blocks are first placed by symbol-day and
    window, and lie so afterwards: see the head of this module.
    """
    require_columns(bars_1m, ("time", *KEYS, *bars))
    stats = BlockStats(bars_1m, tuple(bars), tuple(ops))
    names = [f"v{i}" for i in range(min(BLOCK, len(stats.bars)))]
    rows = bars_1m.where(in_session("time"))
    if not outside:
        rows = rows.where(inside_window("time"))
    rows = rows.withColumns({"window": window_number("time"), "__in": inside_window("time") if outside else F.lit(True)})

    def cell(bar: str) -> str:
        value = f"CAST(`{bar}` AS DOUBLE)"
        return f"IF(__in, {value}, NULL)" if outside else value

    def fields(n: int, block: Sequence[str]) -> list[str]:
        blanks = ["CAST(NULL AS DOUBLE)"] * (len(names) - len(block))
        return [f"{n} AS block", *[f"{c} AS {v}" for c, v in zip([*map(cell, block), *blanks], names)]]

    cut = [fields(n, block) for n, block in enumerate(stats.blocks)]
    if together and len(cut) > 1:
        rows = place(rows.select(*KEYS, "window", "__in", *[F.col(f"`{b}`") for b in dict.fromkeys(bars)]), *KEYS, "window")
    if len(cut) > 1:
        cut = [[f"inline(array({', '.join(f'struct({", ".join(f)})' for f in cut)}))"]]
    flat = rows.selectExpr(*KEYS, "window", "__in", *cut[0])
    counts = [F.count_if("__in").alias("count"), *([F.count(F.lit(1)).alias("seen")] if outside else [])]
    return replace(stats, rows=flat.groupBy(*KEYS, "window", "block").agg(*stat_columns(names, ops), *counts))


def resample_long(
    bars_1m: DataFrame, bars: Sequence[str] | None = None, ops: Sequence[str] = MEAN_STD, placed: bool = False
) -> DataFrame:
    """(date, symbol, slot, {bar}_{op}..., count): one row per symbol-day and ten-minute slot.

    More bars than a block holds are aggregated where their minute rows are
    placed, by symbol-day and window. ``placed`` says that they lie by (date,
    symbol) already: bars derived from a few columns are best placed with
    :func:`place` before they are made, so that no wide row is shuffled.
    """
    if bars is None:
        bars = [c for c in bars_1m.columns if c not in ("time", *KEYS)]
    stats = resample_blocks(bars_1m, bars, ops, together=not placed)
    slot = window_label(F.col("window")).alias("slot")
    rows = stats.rows.where(F.col("count") > 0)
    if len(stats.blocks) == 1:
        names = zip(stats.values, stat_names(bars, ops))
        return rows.select(*KEYS, slot, *[F.col(v).alias(n) for v, n in names], "count")
    # Put the blocks of a window side by side again, where they are.
    side = _side_by_side(rows, "block", range(len(stats.blocks)), [*stats.values, "count"], [*KEYS, "window"])
    picked = [
        f"`{n}_v{i}_{op}` AS `{bar}_{op}`" for n, block in enumerate(stats.blocks) for i, bar in enumerate(block) for op in ops
    ]
    return side.withColumn("slot", window_label(F.col("window"))).selectExpr(*KEYS, "slot", *picked, "0_count AS count")


def _side_by_side(
    rows: DataFrame, cell: str, cells: Iterable, values: Sequence[str], index: Sequence[str]
) -> DataFrame:
    """Pivot with columns ``{cell}_{value}``; rows are already placed by (part of) the index."""
    wide = rows.groupBy(*index).pivot(cell, list(cells)).agg(*[F.first(F.col(f"`{v}`")).alias(v) for v in values])
    if len(values) > 1:
        return wide
    # With one value Spark leaves its name out.
    return wide.toDF(*index, *[f"{c}_{values[0]}" for c in cells])


def widen(
    long: DataFrame,
    values: Sequence[str],
    slots: Sequence[str] = TEN_MINUTE_SLOTS,
    index: Sequence[str] = KEYS,
) -> DataFrame:
    """Long -> wide: one row per index, columns ``{value}_{slot}`` for the given slots.

    The rows are first placed by the index, so both steps of the pivot run
    inside one partitioning and wide rows are never shuffled.
    """
    placed = long.select(*index, "slot", *values).repartition(*[F.col(c) for c in index])
    wide = _side_by_side(placed, "slot", slots, values, index)
    return wide.selectExpr(*index, *[f"`{s}_{v}` AS `{v}_{s}`" for v in values for s in slots])


def widen_blocks(
    stats: BlockStats,
    slots: Sequence[str] = TEN_MINUTE_SLOTS,
    as_float: bool = False,
    placed: bool = False,
    index: Sequence[str] = KEYS,
) -> DataFrame:
    """Block statistics -> wide rows ``{bar}_{op}_{slot}``, without making long rows in between.

    Values are narrowed to 32 bits before they are moved when ``as_float``.
    ``placed`` says that the rows already lie by (date, symbol) or, with further
    columns in ``index`` that follow from these, by some columns of it.
    """
    n = len(stats.blocks)
    kind = "float" if as_float else "double"
    rows = stats.rows.where(F.col("count") > 0).select(
        *index, (F.col("window") * n + F.col("block")).alias("cell"), *[F.col(v).cast(kind).alias(v) for v in stats.values]
    )
    if not placed:
        rows = rows.repartition(*[F.col(k) for k in KEYS])
    first = {s: (minute_of(s) // 10 - 1) * n for s in slots}
    wide = _side_by_side(rows, "cell", [first[s] + b for s in slots for b in range(n)], stats.values, index)
    return wide.selectExpr(
        *index,
        *[
            f"`{first[s] + b}_v{i}_{op}` AS `{bar}_{op}_{s}`"
            for b, block in enumerate(stats.blocks)
            for i, bar in enumerate(block)
            for op in stats.ops
            for s in slots
        ],
    )


def unwiden(
    wide: DataFrame,
    values: Sequence[str],
    slots: Sequence[str] = TEN_MINUTE_SLOTS,
    index: Sequence[str] = KEYS,
) -> DataFrame:
    """Wide -> long: the inverse of :func:`widen`, with a row for every slot."""
    cells = F.array(
        *[
            F.struct(F.lit(s).alias("slot"), *[F.col(f"{v}_{s}").alias(v) for v in values])
            for s in slots
        ]
    )
    return wide.select(*index, F.inline(cells))


def windows_complete(long: DataFrame, expected: int = 10) -> DataFrame:
    """Per date: number of windows and whether all of them have the expected bar count."""
    return long.groupBy("date").agg(
        F.count(F.lit(1)).alias("windows"), F.bool_and(F.col("count") == expected).alias("complete")
    )


def on_the_minute(time: str = "time") -> Column:
    """Is it a whole minute, without seconds?"""
    return F.date_trunc("minute", time) == F.col(time).cast("timestamp")


def bars_at(bars_1m: DataFrame, slots: Sequence[str], time: str = "time") -> DataFrame:
    """Only the bars whose minute is one of the given ``HHMM`` labels."""
    return bars_1m.where(minute_of_day(time).isin([minute_of(s) for s in slots]))


def complete_symbols(bars_1m: DataFrame, slots: Sequence[str]) -> DataFrame:
    """(date, symbol) pairs with exactly one bar time per given slot.

    Counted per symbol and day; the partial counts make a hot symbol harmless.
    """
    return (
        bars_at(bars_1m, slots)
        .groupBy(*KEYS)
        .agg(F.count("time").alias("__n"))
        .where(F.col("__n") == len(slots))
        .select(*KEYS)
    )


def slot_values(
    bars_1m: DataFrame, slots: Sequence[str], value: str = "close", index: Sequence[str] = KEYS
) -> DataFrame:
    """One row per index with the value at exactly each slot's time, columns named by the slot."""
    rows = bars_at(bars_1m, slots).where(on_the_minute()).select(*index, value, minute_of_day("time").alias("__m"))
    return rows.groupBy(*index).agg(*[value_at(s, value).alias(s) for s in slots])


def value_at(slot: str, value: str, minute: str = "__m") -> Column:
    """Aggregate: the value of the bar at a slot, given the column with each bar's minute of the day."""
    return F.max(F.when(F.col(minute) == minute_of(slot), F.col(value)))
