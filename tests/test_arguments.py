import datetime as dt

import pytest

from barloom.functions.dates import to_datetime, to_ymd, year_end
from barloom.functions.durations import parse_duration
from barloom.functions.slots import ONE_MINUTE_SLOTS, TEN_MINUTE_SLOTS, shift_slot, trading_slots
from barloom.plans.features import EXCLUDED, feature_bars, register_feature_set, wide_columns
from barloom.plans.products import list_products, product

NOON = dt.datetime(2022, 2, 1, 12, 30)
MIDNIGHT = dt.datetime(2022, 2, 1)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("20220201", MIDNIGHT), ("2022-02-01", MIDNIGHT), (20220201, MIDNIGHT),
        (dt.date(2022, 2, 1), MIDNIGHT), (MIDNIGHT, MIDNIGHT), (NOON, NOON),
    ],
)
def test_dates(value, expected):
    assert to_datetime(value) == expected
    assert to_ymd(value) == "2022-02-01"


def test_today_and_bad_dates():
    assert to_ymd("today", today=dt.date(2024, 5, 6)) == "2024-05-06"
    assert to_ymd("today") == dt.date.today().isoformat()
    assert year_end(2024) == dt.date(2024, 12, 31)
    for bad in (1.5, None, True):
        with pytest.raises(TypeError):
            to_datetime(bad)
    with pytest.raises(ValueError):
        to_datetime("2022/02/01")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1d2h3m", (1, 123)), ("1d2h", (1, 120)), ("1d3m", (1, 3)), ("2h3m", (0, 123)),
        ("1d", (1, 0)), ("2h", (0, 120)), ("3m", (0, 3)), ("25h", (1, 60)), ("1440m", (1, 0)),
    ],
)
def test_durations(text, expected):
    assert parse_duration(text) == expected


@pytest.mark.parametrize(
    "text",
    ["1d2h3m3m", "1d2h2h3m", "1d2h3m3h", "1d2h3m3d", "0m", "0d", "0h", "0d0h0m", "0d0h", "0d0m", "0h0m", "", "m", "3m2h", "3m\n"],
)
def test_bad_durations(text):
    with pytest.raises(ValueError):
        parse_duration(text)


@pytest.mark.parametrize(
    "duration, expected",
    [
        ("1d", (1, "1030")), ("10d", (10, "1030")), ("1d1h", (1, "1130")), ("1d1h1m", (1, "1301")),
        ("1d1m", (1, "1031")), ("1h", (0, "1130")), ("2h1m", (0, "1401")), ("3h1m", (1, "0931")), ("23h", (5, "1500")),
    ],
)
def test_slot_sums(duration, expected):
    assert shift_slot("1030", duration) == expected


def test_slots():
    assert len(ONE_MINUTE_SLOTS) == 240 and ONE_MINUTE_SLOTS[0] == "0931" and ONE_MINUTE_SLOTS[-1] == "1500"
    assert TEN_MINUTE_SLOTS[:2] == ("0940", "0950") and TEN_MINUTE_SLOTS[12] == "1310" and len(TEN_MINUTE_SLOTS) == 24
    assert trading_slots(right=False)[0] == "0930" and trading_slots(right=False)[-1] == "1459"
    assert trading_slots(freq=10, right=False)[:2] == ["0939", "0949"]
    assert trading_slots("0940", "1000", 10, closed="both") == ["0940", "0950", "1000"]
    assert trading_slots("0940", "1000", 10, closed="left") == ["0940", "0950"]
    assert trading_slots("0940", "1000", 10, closed="right") == ["0950", "1000"]
    assert trading_slots("0940", "1000", 10, closed="none") == ["0950"]
    with pytest.raises(ValueError):
        trading_slots(freq=5)
    with pytest.raises(ValueError):
        trading_slots(closed="open")
    with pytest.raises(ValueError):
        shift_slot("0930", "1m")


def test_products():
    bases = ["0930", "1000", "1030", "1100", "1300", "1330", "1400", "1430"]
    hours = [f"{b}_1h" for b in bases[:-1]] + ["1430_30m"]
    assert set(list_products()) == set(bases + hours)
    assert product("1030").y_columns == ("rtn_v2v_1035_1D", "rtn_v2v_1035_2D", "rtn_v2v_1035_5D")
    assert product("1030").target == "rtn_v2v_1035_2D" and not product("1030").next_day
    assert product("0930").target == "lag_rtn_v2v_0935_2D" and product("0930").next_day
    assert product("0930_1h").y_columns == ("lag_0930_1h",)
    assert product("1400_1h").target == "1400_1h" and product("1430_30m").target == "1430_30m"
    counts = {b: len(product(b).slots) for b in bases}
    assert counts == {"0930": 12, "1000": 3, "1030": 6, "1100": 9, "1300": 12, "1330": 12, "1400": 12, "1430": 12}
    assert product("1430").slots[:4] == ["1110", "1120", "1130", "1310"]
    assert len(product("1000").minute_slots) == 30
    with pytest.raises(ValueError):
        product("1500")


def test_feature_sets():
    assert len(EXCLUDED) == 11
    assert len(feature_bars("v2")) == 139 and len(feature_bars()) == 278 and len(feature_bars("ttt")) == 38
    assert feature_bars("v2") == sorted(feature_bars("v2")) and "twap" not in feature_bars("v2")
    assert feature_bars("v2_agg")[:2] == ["acc_total_trades_mean", "acc_total_trades_std"]
    assert len(wide_columns(feature_bars("v2"))) == 139 * 2 * 24
    assert wide_columns(["a"], ["0940", "0950"]) == ["a_mean_0940", "a_mean_0950", "a_std_0940", "a_std_0950"]
    with pytest.raises(ValueError):
        feature_bars("v9")
    register_feature_set("tiny", ["b", "a", "twap"])
    assert feature_bars("tiny") == ["a", "b"]
