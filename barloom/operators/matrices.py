"""Feature matrices: (slots, features) per symbol-day as array<array<double>>, slot-major."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.resample import KEYS


def matrix_from_long(
    long: DataFrame, features: Sequence[str], slots: Sequence[str], index: Sequence[str] = KEYS
) -> DataFrame:
    """(index, x): one row of features per slot, in slot order; absent slots are rows of NULL.

    A group holds at most one row per slot, so what is gathered is bounded.
    """
    row = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    by_slot = F.map_from_entries(F.collect_list(F.struct("slot", row.alias("v"))))
    blank = F.array(*[F.lit(None).cast("double") for _ in features])
    wanted = long.where(F.col("slot").isin(list(slots)))
    return wanted.groupBy(*index).agg(by_slot.alias("__rows")).select(
        *index, F.array(*[F.coalesce(F.try_element_at("__rows", F.lit(s)), blank) for s in slots]).alias("x")
    )


def matrix_from_wide(
    wide: DataFrame, features: Sequence[str], slots: Sequence[str], index: Sequence[str] = KEYS
) -> DataFrame:
    """The same matrix from ``{feature}_{slot}`` columns."""
    rows = [F.array(*[F.col(f"`{f}_{s}`").cast("double") for f in features]) for s in slots]
    return wide.select(*index, F.array(*rows).alias("x"))
