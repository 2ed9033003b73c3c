"""Return items loaded as they mature, lag rows off the calendar, and the wide dataset put together in place."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from barloom.operators.calendar import trading_calendar
from barloom.operators.resample import KEYS
from barloom.operators.returns import lag_table
from barloom.plans import dataset, return_items, return_tables
from barloom.plans.features import wide_columns
from barloom.sources import sinks
from checks import fixtures as fx

SF = "/root/testdata/sf0.001"
BARS, SLOTS = ["close", "volume"], ["0940", "0950", "1500"]


@pytest.fixture
def panel(spark):
    return fx.bar_1m(spark, SF).cache(), fx.calendar(spark, SF), fx.adj_factor(spark, SF)


def test_lag_rows_off_the_calendar_stay(spark):
    calendar = trading_calendar(spark.createDataFrame([(dt.date(2024, 1, d),) for d in (2, 3)], "date date"))
    rows = spark.createDataFrame([(dt.date(2024, 1, d), "s", 1.0 * d) for d in (2, 3, 6)], "date date, symbol string, v double")
    assert {(r["date"], r["lag_v"]) for r in lag_table(rows, calendar).collect()} == {(dt.date(2024, 1, 2), 3.0), (None, 6.0)}


@pytest.mark.parametrize("lag", [False, True])
def test_dates_are_written_until_they_are_mature(spark, panel, tmp_path, lag):
    bars, calendar, factors = panel
    days = sorted(r["date"] for r in calendar.collect())
    path = str(tmp_path / "item")

    def load(known):
        got = return_items.load_returns(spark, bars, factors, path, calendar, days[1], days[known], horizons=(1, 2), lag=lag, days_per_job=3)
        return [days.index(d) for d in got]

    assert load(5) == list(range(1, 6 - lag))
    assert load(5) == []
    # with two dates ahead (lag: three), the last two are written again, and the new ones
    assert load(7) == list(range(4 - lag, 8 - lag))
    assert load(7) == []
    whole = return_tables.return_table(bars.where(f"date <= '{days[7]}'"), calendar, factors, (1, 2))
    if lag:
        whole = return_tables.lag_return_table(whole, calendar)
    key = lambda r: (r["date"], r["symbol"])
    want = sorted((r for r in whole.where(f"date >= '{days[1]}'").collect()), key=key)
    got = sorted(spark.read.parquet(path).select(whole.columns).collect(), key=key)
    assert got == want


def test_a_known_date_before_the_calendar_loads_nothing(spark, panel, tmp_path):
    bars, calendar, factors = panel
    assert return_items.load_returns(spark, bars, factors, str(tmp_path / "x"), calendar, dt.date(2024, 1, 8), dt.date(2020, 1, 1)) == []


def _parts(spark, panel):
    bars, calendar, factors = panel
    rets = return_tables.return_table(bars, calendar, factors)
    return bars, fx.univ(spark, SF), rets, return_tables.lag_return_table(rets, calendar)


def test_wide_rows_are_not_shuffled(spark, panel):
    """No exchange above the pivot, and a place for every so many rows of a date."""
    bars, members, rets, lagged = _parts(spark, panel)
    days = sorted(r["date"] for r in panel[1].collect())
    with dataset.session_settings(spark, {**dataset.WIDE_SETTINGS, "spark.sql.adaptive.enabled": "false"}):
        rows = dataset.placed_rows(bars, members, rets, lagged, BARS, days, SLOTS, place_bytes=1 << 10)
        plan = rows.sortWithinPartitions("date", "symbol")._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("pivotfirst")]
    wide_side = [line for line in above.splitlines() if "Exchange" in line]
    # those above the pivot in the text are of the narrow side alone
    assert all("__bucket" in line or "Broadcast" in line or not re.search("close_mean", line) for line in wide_side)
    assert len(re.findall(r"Exchange hashpartitioning\(date#\d+, __bucket#\d+L, \d+\), REPARTITION_BY_NUM", plan)) == 2
    assert not re.findall(r"Exchange hashpartitioning\(date#\d+, symbol#\d+, __bucket", plan)


def test_placed_rows_are_the_joined_rows(spark, panel):
    bars, members, rets, lagged = _parts(spark, panel)
    days = sorted(r["date"] for r in panel[1].collect())[:5]
    placed = dataset.placed_rows(bars, members, rets, lagged, BARS, days, SLOTS, place_bytes=1 << 9)
    joined = dataset.dataset_rows(bars, members, rets, lagged, BARS, days, SLOTS)
    assert placed.columns == joined.columns and set(wide_columns(BARS, SLOTS)) <= set(placed.columns)
    key = lambda r: (r["date"], r["symbol"])
    assert sorted(placed.collect(), key=key) == sorted(joined.collect(), key=key)


def test_bars_in_buckets_are_aggregated_where_they_are_read(spark, panel, tmp_path):
    """By date and dealt by symbol: no partial aggregate is shuffled, and statistics move as 32-bit numbers."""
    bars, members, rets, lagged = _parts(spark, panel)
    days = sorted(r["date"] for r in panel[1].collect())[:5]
    twice = bars.unionByName(bars.limit(40)).withColumn("symbol", F.expr("IF(symbol LIKE '%3', NULL, symbol)"))
    twice = twice.withColumn("date", F.expr("IF(minute(time) = 7, NULL, date)")).localCheckpoint()
    path, plain = str(tmp_path / "bars"), str(tmp_path / "plain")
    sinks.write_by_date(twice, plain, sort=("symbol", "time"))
    try:
        sinks.write_by_date(twice, path, sort=("symbol", "time"), table="dealt_bars", buckets=3)
        dealt = spark.table("dealt_bars")
        assert dealt.select(twice.columns).exceptAll(twice).isEmpty() and dealt.count() == twice.count()
        dates = [sorted(r["date"] for r in sinks.loaded_dates(spark, p).collect()) for p in (path, plain)]
        assert dates[0] == dates[1] == sorted(r["date"] for r in twice.select("date").distinct().collect() if r["date"])
        with dataset.session_settings(spark, {**dataset.WIDE_SETTINGS, "spark.sql.adaptive.enabled": "false"}):
            rows = dataset.placed_rows(dealt, members, rets, lagged, BARS, days, SLOTS, place_bytes=1 << 9)
            plan = rows._jdf.queryExecution().executedPlan().toString()
            got = sorted(rows.collect(), key=lambda r: (r["date"], r["symbol"]))
        below = plan[plan.index("pivotfirst") :].splitlines()
        moved = [line for line in below if "Exchange" in line and "Broadcast" not in line]
        assert len(moved) == 1 and "__bucket" in moved[0]
        assert any("as float) AS v0_mean" in line for line in below[below.index(moved[0]) :])
        loose = dataset.dataset_rows(spark.read.parquet(plain), members, rets, lagged, BARS, days, SLOTS)
        assert got == sorted(loose.collect(), key=lambda r: (r["date"], r["symbol"]))
    finally:
        spark.sql("DROP TABLE IF EXISTS dealt_bars")
    with pytest.raises(ValueError, match="bucket"):
        sinks.write_by_date(twice, path, table="none")


def test_buckets_follow_the_rows_of_a_date(spark):
    d = dt.date(2024, 1, 2)
    rows = [(d, f"s{i}") for i in range(1000)] + [(dt.date(2024, 1, 3), "s0"), (None, "s1")]
    places = dataset.Places(spark.createDataFrame(rows, "date date, symbol string"), row_bytes=100, place_bytes=10_000)
    put = places.put(spark.createDataFrame(rows, "date date, symbol string"))
    assert places.number == 11 and put.rdd.getNumPartitions() == 11
    assert put.groupBy(*KEYS[:1]).agg({"__bucket": "max"}).collect()[0] is not None
    assert {r["date"]: r["n"] for r in put.groupBy("date").agg({"__bucket": "max"}).toDF("date", "n").collect()} == {d: 9, dt.date(2024, 1, 3): 0}
