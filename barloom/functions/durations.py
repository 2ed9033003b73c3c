"""Durations written ``1d2h3m``: at most one of each unit, in that order."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHAPE = r"^(?:(\d+)d)?(?:(\d+)h)?(?:(\d+)m)?$"
MINUTES_PER_DAY = 1440


def parse_duration(text: str) -> tuple[int, int]:
    """(days, minutes) of a duration argument; minutes from 1440 on roll into days."""
    m = re.fullmatch(_SHAPE, text)
    if m is None:
        raise ValueError(f"bad duration {text!r}: write it like 1d2h3m, each unit once")
    d, h, mi = (int(g or 0) for g in m.groups())
    total = d * MINUTES_PER_DAY + h * 60 + mi
    if total == 0:
        raise ValueError(f"duration {text!r} must be longer than zero")
    return divmod(total, MINUTES_PER_DAY)


def duration_minutes(text: Column | str) -> Column:
    """Total minutes of a duration column; NULL for text that is no duration or is zero."""
    t = F.col(text) if isinstance(text, str) else text

    def unit(i: int) -> Column:
        part = F.regexp_extract(t, _SHAPE, i)
        return F.when(part == "", F.lit(0).cast("bigint")).otherwise(part.try_cast("bigint"))

    total = unit(1) * MINUTES_PER_DAY + unit(2) * 60 + unit(3)
    return F.when(t.rlike(_SHAPE) & (total > 0), total)


def split_duration(text: Column | str) -> tuple[Column, Column]:
    """(days, minutes) columns of a duration column, NULL where it does not parse."""
    total = duration_minutes(text)
    return F.call_function("div", total, F.lit(MINUTES_PER_DAY)), total % MINUTES_PER_DAY
