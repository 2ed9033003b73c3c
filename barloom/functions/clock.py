"""Clock arithmetic for a two-session trading day, as Column expressions.

The day has two sessions of 120 one-minute bars. A bar is named by the minute
it ends in (right label, 0931 .. 1130 and 1301 .. 1500) or starts in (left
label, 0930 .. 1129 and 1300 .. 1459). Every conversion between a label and its
position 0 .. 239 is integer arithmetic, so no lookup join is needed.

Timestamps are zone-free (``timestamp_ntz``) or session-zone; only ``hour`` and
``minute`` are read, which keeps the expressions inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Session opening minutes (09:30 and 13:00) and session length.
MORNING_OPEN = 9 * 60 + 30
AFTERNOON_OPEN = 13 * 60
SESSION_MINUTES = 120
DAY_MINUTES = 2 * SESSION_MINUTES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column, b: int) -> Column:
    """Integer quotient, rounded toward zero, without a detour through doubles."""
    return F.call_function("div", a, F.lit(b)).cast("int")


def minute_of_day(time: Column | str) -> Column:
    """Minutes since midnight."""
    t = _col(time)
    return F.hour(t) * 60 + F.minute(t)


def label_of_minute(minutes: Column) -> Column:
    """Minutes since midnight -> ``HHMM``."""
    return F.lpad((int_div(minutes, 60) * 100 + minutes % 60).cast("string"), 4, "0")


def hhmm(time: Column | str) -> Column:
    """Timestamp -> ``HHMM`` of its minute."""
    t = _col(time)
    return F.lpad((F.hour(t) * 100 + F.minute(t)).cast("string"), 4, "0")


def minute_of(slot: str) -> int:
    """``HHMM`` argument -> minutes since midnight."""
    return int(slot[:2]) * 60 + int(slot[2:])


def slot_minute(slot: Column | str) -> Column:
    """``HHMM`` -> minutes since midnight."""
    s = _col(slot)
    return F.substring(s, 1, 2).cast("int") * 60 + F.substring(s, 3, 2).cast("int")


def at_minute(date: Column | str, minutes: Column) -> Column:
    """Date + minutes since midnight -> ``timestamp_ntz``."""
    return _col(date).cast("timestamp_ntz") + F.expr("INTERVAL '1' MINUTE") * minutes


def at_slot(date: Column | str, slot: Column | str) -> Column:
    """Date + ``HHMM`` -> ``timestamp_ntz``."""
    return at_minute(date, slot_minute(slot))


def in_session(time: Column | str) -> Column:
    """True for right-labelled bars of either session, both ends closed."""
    # One set lookup rather than four comparisons: the minute is computed once per row.
    minutes = [o + 1 + i for o in (MORNING_OPEN, AFTERNOON_OPEN) for i in range(SESSION_MINUTES)]
    return minute_of_day(time).isin(minutes)


def slot_position(slot: Column | str) -> Column:
    """Right label -> position 0 .. 239 in the day; NULL when it is no bar of a session."""
    m = slot_minute(slot)
    morning, afternoon = m - (MORNING_OPEN + 1), m - (AFTERNOON_OPEN + 1)
    return F.when(morning.between(0, SESSION_MINUTES - 1), morning).when(
        afternoon.between(0, SESSION_MINUTES - 1), afternoon + SESSION_MINUTES
    )


def slot_at_position(position: Column, right: bool = True) -> Column:
    """Position 0 .. 239 -> right (or left) label."""
    opening = F.when(position < SESSION_MINUTES, F.lit(MORNING_OPEN)).otherwise(
        F.lit(AFTERNOON_OPEN - SESSION_MINUTES)
    )
    return label_of_minute(opening + position + (1 if right else 0))


def add_session_minutes(slot: Column | str, days: Column, minutes: Column) -> tuple[Column, Column]:
    """Move a right label by whole days and session minutes.

    Returns (trading days to add, end label). Session minutes wrap over lunch
    and over the close of the day.
    """
    target = slot_position(slot) + minutes
    return (
        (int_div(target, DAY_MINUTES) + days).cast("int"),
        slot_at_position((target % DAY_MINUTES).cast("int")),
    )
