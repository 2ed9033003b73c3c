"""Named feature sets and the column names that follow from them."""

from __future__ import annotations

from collections.abc import Iterable

from barloom.functions.slots import TEN_MINUTE_SLOTS
from barloom.operators.resample import MEAN_STD, slot_names, stat_names

# Bars that are never features.
EXCLUDED = """
data_source arrival_time arrival_time_from_trans arrival_time_v3 mpb tpb hml iopv twap twap_from_trans
total_trades_from_trans
""".split()

# Bars of set "v2".
V2 = """
data_source arrival_time open close high low high_to_now low_to_now accvolume volume accamount amount
open_amount close_amount high_amount low_amount iopv total_trades acc_total_trades
open_ask1_price open_ask1_size open_bid1_price open_bid1_size
close_ask1_price close_ask1_size close_bid1_price close_bid1_size
high_ask1_price high_ask1_size high_bid1_price high_bid1_size
low_ask1_price low_ask1_size low_bid1_price low_bid1_size
avg_ask1_price avg_ask1_size avg_bid1_price avg_bid1_size vwap_ask1_price vwap_bid1_price
open_mid_price close_mid_price mid_price_avg mid_price_std mid_price_skew mid_price_kurt
min_spread max_spread avg_spread
open_ask_amount10 open_bid_amount10 close_ask_amount10 close_bid_amount10 avg_ask_amount10 avg_bid_amount10
ask_volume10_avg bid_volume10_avg
open_vwap_ask_price10 open_avg_ask_price10 open_vwap_bid_price10 open_avg_bid_price10
close_vwap_ask_price10 close_avg_ask_price10 close_vwap_bid_price10 close_avg_bid_price10
vwap_ask_price10_avg avg_ask_price10_avg vwap_bid_price10_avg avg_bid_price10_avg
delta_amount_ask_algo1 delta_amount_bid_algo1 delta_amount_ask_algo2 delta_amount_bid_algo2
delta_amount_ask_algo3 delta_amount_bid_algo3 delta_amount_ask_algo4 delta_amount_bid_algo4
qimb1_avg qimb1_std qimb1_skew qimb1_kurt qimb10_avg qimb10_std qimb10_skew qimb10_kurt
tick_return_avg tick_return_std tick_return_skew tick_return_kurt
ask_amount10_chg_avg ask_amount10_chg_std ask_amount10_chg_skew ask_amount10_chg_kurt
bid_amount10_chg_avg bid_amount10_chg_std bid_amount10_chg_skew bid_amount10_chg_kurt
ask_amount10_ratio1_avg ask_amount10_ratio1_std ask_amount10_ratio1_skew ask_amount10_ratio1_kurt
bid_amount10_ratio1_avg bid_amount10_ratio1_std bid_amount10_ratio1_skew bid_amount10_ratio1_kurt
ask_amount10_ratio2_avg ask_amount10_ratio2_std ask_amount10_ratio2_skew ask_amount10_ratio2_kurt
bid_amount10_ratio2_avg bid_amount10_ratio2_std bid_amount10_ratio2_skew bid_amount10_ratio2_kurt
book10_ratio_avg book10_ratio_std book10_ratio_skew book10_ratio_kurt
book10_ratio_chg_avg book10_ratio_chg_std book10_ratio_chg_skew book10_ratio_chg_kurt
book10_rratio_avg book10_rratio_std book10_rratio_skew book10_rratio_kurt
book10_rratio_chg_avg book10_rratio_chg_std book10_rratio_chg_skew book10_rratio_chg_kurt
twap arrival_time_from_trans total_trades_from_trans twap_from_trans
buy_amount_by_bsflag_from_trans sell_amount_by_bsflag_from_trans
buy_amount_by_tick_from_trans sell_amount_by_tick_from_trans
buy_amount_by_quote_from_trans sell_amount_by_quote_from_trans
vwap qimb_1_close qimb_10 timb_bsflag timb_tick timb_quote mpb tpb hml
""".split()

# Bars of set "ttt".
TTT = """
big_order_bid_ask_ratio_avg big_order_bid_ask_ratio_kurt big_order_bid_ask_ratio_skew big_order_bid_ask_ratio_std
big_order_bid_ask_ratio_zscore big_order_price_kurt big_order_price_skew big_order_price_zscore
close_big_order_price_avg close_big_order_price_kurt close_big_order_price_skew close_big_order_price_std
close_big_order_price_zscore close_kurt close_skew
close_vwap_ratio_avg close_vwap_ratio_kurt close_vwap_ratio_skew close_vwap_ratio_std close_vwap_ratio_zscore
close_zscore imb5_avg imb5_kurt imb5_skew imb5_std imb5_zscore
swa_bid_ask_ratio_avg swa_bid_ask_ratio_kurt swa_bid_ask_ratio_skew swa_bid_ask_ratio_std swa_bid_ask_ratio_zscore
tick_return_zscore
vol_book_ratio_avg vol_book_ratio_kurt vol_book_ratio_skew vol_book_ratio_std vol_book_ratio_zscore vwap_twap_ratio
""".split()

_SETS: dict[str, list[str]] = {"v2": V2, "ttt": TTT}


def register_feature_set(name: str, bars: Iterable[str]) -> None:
    """Add or replace a named set, e.g. ``v3`` from ``register_feature_set("v3", table.columns)``."""
    _SETS[name] = list(bars)


def feature_bars(name: str = "v2_agg") -> list[str]:
    """Sorted bars of a set without the excluded ones; ``{set}_agg`` gives bar x {mean, std} names."""
    base = name.removesuffix("_agg")
    if base not in _SETS:
        raise ValueError(f"unknown feature set {name!r}; registered: {sorted(_SETS)}")
    bars = sorted(set(_SETS[base]) - set(EXCLUDED))
    return bars if base == name else stat_names(bars, MEAN_STD)


def wide_columns(bars: Iterable[str], slots: Iterable[str] = TEN_MINUTE_SLOTS) -> list[str]:
    """``{bar}_{stat}_{slot}``: bar by bar, then statistic, then slot."""
    return slot_names(stat_names(bars, MEAN_STD), slots)
