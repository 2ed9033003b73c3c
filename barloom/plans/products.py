"""The sixteen products: what each one reads, predicts and when it is used.

A product is named by the slot at which its prediction is used. It reads the
two trading hours before that slot (less, right after the open); at 0930 that
is the afternoon of the day before, so its labels are lagged and its results
are dated one trading day later.
"""

from __future__ import annotations

from dataclasses import dataclass

from barloom.functions.slots import trading_slots

# Slot of use -> first and last minute of the input range.
INPUT_RANGES = {
    "0930": ("1300", "1500"),
    "1000": ("0930", "1000"),
    "1030": ("0930", "1030"),
    "1100": ("0930", "1100"),
    "1300": ("0930", "1300"),
    "1330": ("1000", "1330"),
    "1400": ("1030", "1400"),
    "1430": ("1100", "1430"),
}
ENTRY_DELAY = 5
DAILY_HORIZONS = ("1D", "2D", "5D")
TARGET_HORIZON = "2D"


@dataclass(frozen=True)
class Product:
    name: str
    slot: str
    x_begin: str
    x_end: str
    y_columns: tuple[str, ...]
    target: str
    next_day: bool
    freq: int = 10

    @property
    def slots(self) -> list[str]:
        """Ten-minute input slots, oldest first."""
        return trading_slots(self.x_begin, self.x_end, freq=self.freq, closed="right")

    @property
    def minute_slots(self) -> list[str]:
        """One-minute bars of the input range."""
        return trading_slots(self.x_begin, self.x_end, freq=1, closed="right")


def _daily(slot: str) -> Product:
    lagged = slot == "0930"
    stem = f"{'lag_' if lagged else ''}rtn_v2v_{int(slot) + ENTRY_DELAY:04d}_"
    return Product(
        slot, slot, *INPUT_RANGES[slot], tuple(stem + h for h in DAILY_HORIZONS), stem + TARGET_HORIZON, lagged
    )


def _intraday(slot: str) -> Product:
    # The last slot has half an hour left before the close.
    span = "30m" if slot == "1430" else "1h"
    lagged = slot == "0930"
    label = f"{'lag_' if lagged else ''}{slot}_{span}"
    return Product(f"{slot}_{span}", slot, *INPUT_RANGES[slot], (label,), label, lagged)


PRODUCTS = {p.name: p for slot in INPUT_RANGES for p in (_daily(slot), _intraday(slot))}


def list_products() -> list[str]:
    return list(PRODUCTS)


def product(name: str) -> Product:
    if name not in PRODUCTS:
        raise ValueError(f"unknown product {name!r}; choose from {list_products()}")
    return PRODUCTS[name]
