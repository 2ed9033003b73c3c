"""Slot names on the driver: argument checks, column names, pivot values."""

from __future__ import annotations

from barloom.functions.clock import AFTERNOON_OPEN, DAY_MINUTES, MORNING_OPEN, SESSION_MINUTES
from barloom.functions.durations import parse_duration

_INSIDE = {
    "both": lambda s, b, e: b <= s <= e,
    "left": lambda s, b, e: b <= s < e,
    "right": lambda s, b, e: b < s <= e,
    "none": lambda s, b, e: b < s < e,
}


def _label(minute: int) -> str:
    return f"{minute // 60:02d}{minute % 60:02d}"


def trading_slots(
    begin: str | None = None,
    end: str | None = None,
    freq: int = 1,
    right: bool = True,
    closed: str = "both",
) -> list[str]:
    """Bar labels of a trading day between two ``HHMM`` bounds.

    ``freq=10`` keeps every tenth one-minute label, the last of each ten; with
    left labels these are 0939, 0949, ...
    """
    if freq not in (1, 10):
        raise ValueError(f"freq must be 1 or 10, got {freq}")
    if closed not in _INSIDE:
        raise ValueError(f"closed must be one of {sorted(_INSIDE)}, got {closed!r}")
    shift = 1 if right else 0
    day = [
        _label(opening + shift + i)
        for opening in (MORNING_OPEN, AFTERNOON_OPEN)
        for i in range(freq - 1, SESSION_MINUTES, freq)
    ]
    inside = _INSIDE[closed]
    return [s for s in day if inside(s, begin or "0930", end or "1500")]


ONE_MINUTE_SLOTS = tuple(trading_slots())
TEN_MINUTE_SLOTS = tuple(trading_slots(freq=10))


def shift_slot(slot: str, duration: str) -> tuple[int, str]:
    """(trading days to add, end label) for a label plus a duration like ``1d2h3m``."""
    if slot not in ONE_MINUTE_SLOTS:
        raise ValueError(f"{slot!r} is not a bar of a trading session")
    days, minutes = parse_duration(duration)
    wrapped, position = divmod(ONE_MINUTE_SLOTS.index(slot) + minutes, DAY_MINUTES)
    return days + wrapped, ONE_MINUTE_SLOTS[position]
