import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barloom.functions import clock, dates, durations
from barloom.functions.slots import ONE_MINUTE_SLOTS, shift_slot, trading_slots
from barloom.operators import asof, calendar as cal, datesets, splits

START = dt.date(2024, 1, 1)
DAYS = [d for d in (START + dt.timedelta(i) for i in range(90)) if d.weekday() < 5]


@pytest.fixture(scope="module")
def days(spark):
    rows = [(d,) for d in DAYS] * 2
    random.Random(1).shuffle(rows)
    return cal.trading_calendar(spark.createDataFrame(rows, "date date"))


def _dates(df):
    return sorted(r["date"] for r in df.collect())


def test_table(spark, days):
    rows = sorted(days.collect())
    assert [r["date"] for r in rows] == DAYS and [r["idx"] for r in rows] == list(range(len(DAYS)))
    assert rows[0]["prev"] is None and rows[1]["prev"] == DAYS[0] and rows[-1]["next"] is None
    assert _dates(cal.calendar_between(days, "20240108", "2024-01-10")) == DAYS[5:8]
    nxt = {r["date"]: r["next"] for r in cal.calendar_next(days, 3).collect()}
    assert nxt[DAYS[0]] == DAYS[3] and nxt[DAYS[-3]] is None
    with pytest.raises(ValueError):
        cal.trading_dates(days, begin="1000-13-01")


def expected_shift(d, n):
    i = bisect.bisect_left(DAYS, d)
    if n == 0 or i == len(DAYS):
        return None
    if DAYS[i] != d and n > 0:
        n -= 1
    return DAYS[i + n] if 0 <= i + n < len(DAYS) else None


def test_shift_agrees_with_brute_force(spark, days):
    pairs = [(START + dt.timedelta(i), n) for i in range(-3, 95, 2) for n in (-7, -1, 0, 1, 2, 60)]
    df = spark.createDataFrame(pairs, "date date, n int")
    got = {(r["date"], r["n"]): r["shifted"] for r in cal.shift_dates(df, days, F.col("n")).collect()}
    assert got == {(d, n): expected_shift(d, n) for d, n in pairs}
    with pytest.raises(ValueError):
        cal.shift_dates(df, days, 0)


def test_scalar_forms(spark, days):
    assert cal.is_trading_day(days, "2024-01-02") and not cal.is_trading_day(days, "2024-01-06")
    for d, n in [(DAYS[4], 1), (DAYS[4], -2), (dt.date(2024, 1, 6), 1), (dt.date(2024, 1, 6), -1), (dt.date(2024, 1, 7), 5)]:
        assert cal.shift_date(days, d, n) == expected_shift(d, n)
    with pytest.raises(ValueError):
        cal.shift_date(days, DAYS[0], 0)
    for d, n in [(DAYS[0], -1), (DAYS[-1], 1), (dt.date(2030, 1, 1), -1)]:
        with pytest.raises(IndexError):
            cal.shift_date(days, d, n)


def test_clamp(days):
    evening, day = dt.datetime(2024, 3, 1, 23, 30), dt.datetime(2024, 3, 1, 12, 0)
    assert cal.clamp_range(days, "2024-01-06", "2024-01-12", evening) == (dt.date(2024, 1, 8), dt.date(2024, 1, 12))
    assert cal.clamp_range(days, "2024-01-06", "2024-01-12", day) == (dt.date(2024, 1, 8), dt.date(2024, 1, 11))
    assert cal.clamp_range(days, "2024-01-06", "2024-01-13", day) == (dt.date(2024, 1, 8), dt.date(2024, 1, 12))
    assert cal.clamp_range(days, "2024-01-12", "2024-01-12", day) is None
    assert cal.clamp_range(days, "2024-01-12", "today", dt.datetime(2024, 1, 15, 23, 1)) == (dt.date(2024, 1, 12), dt.date(2024, 1, 15))


def test_schedule(days):
    got = {r["time"]: r["next_time"] for r in cal.slot_schedule(days, "3h1m", ["1030", "0931"]).collect()}
    assert len(got) == 2 * len(DAYS)
    assert got[dt.datetime(2024, 1, 5, 10, 30)] == dt.datetime(2024, 1, 8, 9, 31)
    assert got[dt.datetime(2024, 1, 5, 9, 31)] == dt.datetime(2024, 1, 5, 14, 2)
    assert got[dt.datetime.combine(DAYS[-1], dt.time(10, 30))] is None
    for bad in ("0930", ["1030", "1200"], []):
        with pytest.raises(ValueError):
            cal.slot_schedule(days, "1h", bad)


def test_clock_columns(spark):
    rows = [(s, m) for s in ("0931", "1130", "1301", "1500", "1030") for m in (0, 1, 90, 239, 240, 1380)]
    df = spark.createDataFrame(rows, "slot string, m int")
    gap, end = clock.add_session_minutes("slot", F.lit(0), F.col("m"))
    for r in df.select("slot", "m", gap.alias("g"), end.alias("e")).collect():
        assert (r["g"], r["e"]) == (shift_slot(r["slot"], f"{r['m']}m") if 0 < r["m"] < 1440 else (0, r["slot"]))
    labels = spark.createDataFrame([(s,) for s in (*ONE_MINUTE_SLOTS, "0930", "1200", "1300")], "slot string")
    pos = labels.select("slot", clock.slot_position("slot").alias("p"))
    got = {r["slot"]: r["p"] for r in pos.collect()}
    assert [got[s] for s in ONE_MINUTE_SLOTS] == list(range(240)) and got["0930"] is got["1200"] is got["1300"] is None
    left = pos.where("p is not null").select("p", clock.slot_at_position(F.col("p"), right=False).alias("l"))
    assert [r["l"] for r in sorted(left.collect())] == trading_slots(right=False)


def test_text_columns(spark):
    rows = [("20220201",), ("2022-02-01",), ("2022-13-01",), ("20220231",), ("x",), ("2022-2-1",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(dates.parse_date("t")).collect()]
    assert got == [dt.date(2022, 2, 1)] * 2 + [None] * 5
    texts = ["1d2h3m", "3h1m", "1440m", "0m", "3m2h", "", "1d2h3m3m", "12"]
    d, m = durations.split_duration("t")
    got = [(r[0], r[1]) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(d, m).collect()]
    assert got == [(1, 123), (0, 181), (1, 0)] + [(None, None)] * 5


def test_date_sets(spark):
    a = spark.createDataFrame([(d,) for d in DAYS[:20]], "date date")
    b = spark.createDataFrame([(d,) for d in DAYS[5:30]] * 3, "date date")
    assert _dates(datesets.common_dates(a, b)) == DAYS[5:20]
    assert _dates(datesets.ready_dates(a, b)) == DAYS[5:14]
    assert _dates(datesets.pending_dates(b, a)) == DAYS[20:30]
    assert _dates(datesets.pending_dates(b, a, reload_last=6)) == DAYS[14:30]
    assert _dates(datesets.drop_latest(a, 50)) == []


def test_latest_versions(spark):
    marks = [DAYS[3], DAYS[10], DAYS[10] + dt.timedelta(5), DAYS[40]]
    versions = spark.createDataFrame([(m, f) for m in marks for f in "xy"], "milestone date, feature string")
    every = spark.createDataFrame([(START + dt.timedelta(i),) for i in range(90)] * 2, "date date")
    for n in (1, 3):
        got = {(r["date"], r["rank"]): r["milestone"] for r in asof.latest_versions(every, versions, n).collect()}
        want = {}
        for i in range(90):
            d = START + dt.timedelta(i)
            for k, m in enumerate(sorted((m for m in marks if m <= d), reverse=True)[:n], 1):
                want[(d, k)] = m
        assert got == want
    with pytest.raises(ValueError):
        asof.latest_versions(every, versions, 0)


def brute_split(milestone, n_train, n_eval, n_lag, n_test):
    i = bisect.bisect(DAYS, milestone)
    ev = i - n_lag - n_eval
    if ev < 0:
        return None
    return {"train": DAYS[max(ev - n_train, 0) : ev], "eval": DAYS[ev : i - n_lag], "test": DAYS[i : i + n_test]}


def test_splits(spark, days):
    miles = [START + dt.timedelta(i) for i in range(0, 95, 7)]
    df = spark.createDataFrame([(m,) for m in miles], "milestone date")
    got = {}
    for r in splits.split_dates(df, days, n_train=12, n_eval=6, n_lag=3, n_test=4).collect():
        got.setdefault((r["milestone"], r["split"]), []).append(r["date"])
    want = {}
    for m in miles:
        for name, ds in (brute_split(m, 12, 6, 3, 4) or {}).items():
            if ds:
                want[(m, name)] = ds
    assert {k: sorted(v) for k, v in got.items()} == want
    ranges = splits.split_ranges(days, "2024-03-02", 12, 6, 3, 4)
    b = brute_split(dt.date(2024, 3, 2), 12, 6, 3, 4)
    assert ranges == {k: (v[0], v[-1]) for k, v in b.items()}
    assert ranges["train"][1] < ranges["eval"][0] and ranges["eval"][1] < dt.date(2024, 3, 2) < ranges["test"][0]
    assert set(splits.split_ranges(days, "2024-03-02", 12, 6, 3)) == {"train", "eval"}
    for bad in [dict(milestone="2024-01-05"), dict(milestone="2024-01-11", n_eval=6, n_lag=3), dict(milestone="2024-12-31", n_eval=6, n_lag=3, n_test=2)]:
        with pytest.raises(ValueError):
            splits.split_ranges(days, **bad)
    data = spark.createDataFrame([(d, i) for d in DAYS for i in range(3)], "date date, i int")
    sizes = {r["split"]: r["n_rows"] for r in splits.split_sizes(splits.tag_split(data, ranges)).collect()}
    assert sizes == {"train": 36, "eval": 18, "test": 12}
