import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.functions.slots import trading_slots
from barloom.operators import calendar as cal, datesets, returns
from barloom.plans import dataset, return_tables
from barloom.sources import incremental, readers, sinks, workdir

DAYS = [d for d in (dt.date(2024, 1, 8) + dt.timedelta(i) for i in range(28)) if d.weekday() < 5]
LATE = dt.datetime(2024, 6, 1, 23, 30)


@pytest.fixture(scope="module")
def days(spark):
    return cal.trading_calendar(spark.createDataFrame([(d,) for d in DAYS], "date date"))


def price(di, si, ti):
    return 10.0 + di + 3 * si + (ti % 7) / 10


@pytest.fixture(scope="module")
def bars(spark, tmp_path_factory):
    """Two symbols; B is suspended on the fourth day; volume is zero in A's first half hour of day one."""
    rows = []
    for di, d in enumerate(DAYS):
        for si, s in enumerate("AB"):
            if s == "B" and di == 3:
                continue
            for ti, t in enumerate(trading_slots()):
                v = 0.0 if (di, s) == (0, "A") and "0935" < t <= "1000" else 1.0 + ti % 3
                p = price(di, si, ti)
                rows.append((d, s, dt.datetime(d.year, d.month, d.day, int(t[:2]), int(t[2:])), p, v, p * v))
    df = spark.createDataFrame(rows, "date date, symbol string, time timestamp_ntz, close double, volume double, amount double")
    path = str(tmp_path_factory.mktemp("bars") / "bar_1m")
    sinks.write_by_date(df, path, sort=("symbol", "time"))
    return path


def by_key(df):
    return {(r["date"], r["symbol"]): r for r in df.collect()}


def test_intraday(spark, bars):
    assert len(returns.intraday_spans()) == 15 and returns.intraday_spans()["1100_1h"] == ("1105", "1330")
    assert "1430_1h" not in returns.intraday_spans()
    got = by_key(returns.intraday_returns(spark.read.parquet(bars)))
    slots = trading_slots()
    a, b = price(0, 0, slots.index("0935")), price(0, 0, slots.index("1000"))
    assert got[(DAYS[0], "A")]["0930_30m"] == pytest.approx(b / a - 1)
    got = by_key(returns.pairwise_returns(spark.read.parquet(bars), ["1120", "1400"], ["20m", "60m"]))
    a, b = price(2, 1, slots.index("1120")), price(2, 1, slots.index("1310"))
    assert got[(DAYS[2], "B")]["ret_1120_20m"] == pytest.approx(b / a - 1)
    for slot, d in [("1450", "20m"), ("0930", "20m"), ("1000", "1h"), ("1000", "1d1m")]:
        with pytest.raises(ValueError):
            returns.pairwise_returns(spark.read.parquet(bars), slot, d)


def test_return_table(spark, bars, days):
    df = spark.read.parquet(bars)
    factors = spark.createDataFrame([(d, s, 1.0 + i) for i, d in enumerate(DAYS) for s in "AB"], "date date, symbol string, adj_factor double")
    table = return_tables.return_table(df, days, factors)
    assert table.columns == ["date", "symbol", *return_tables.return_columns()] and len(table.columns) == 2 + 64 + 15
    got = by_key(table)
    i = trading_slots().index("0935")
    want = price(3, 0, i) * 4 / (price(1, 0, i) * 2) - 1
    assert got[(DAYS[1], "A")]["rtn_o2o_0935_2D"] == pytest.approx(want)
    # Suspended on the fourth day: two days before it there is no price two days on, but three days on there is.
    b = got[(DAYS[1], "B")]
    assert b["rtn_o2o_0935_2D"] is None and b["rtn_v2v_1005_2D"] is None and b["rtn_o2o_0935_3D"] is not None
    assert (DAYS[3], "B") not in got
    assert got[(DAYS[-1], "A")]["rtn_o2o_0935_1D"] is None
    # No volume: no VWAP, so no VWAP return either.
    assert got[(DAYS[0], "A")]["rtn_v2v_0935_1D"] is None and got[(DAYS[0], "A")]["rtn_v2v_1005_1D"] is not None
    plain = by_key(return_tables.return_table(df, days))
    assert plain[(DAYS[1], "A")]["rtn_o2o_0935_2D"] == pytest.approx(price(3, 0, i) / price(1, 0, i) - 1)
    text = table._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text

    lagged = by_key(return_tables.lag_return_table(table, days))
    assert set(lagged) == {(days_before, s) for (d, s) in got if d != DAYS[0] for days_before in [DAYS[DAYS.index(d) - 1]]}
    assert lagged[(DAYS[0], "A")]["lag_1000_1h"] == got[(DAYS[1], "A")]["1000_1h"]


def test_zero_price_gives_null(spark):
    t = lambda h, m: dt.datetime(2024, 1, 8, h, m)
    rows = [(DAYS[0], "A", t(9, 35), 0.0), (DAYS[0], "A", t(10, 0), 5.0)]
    df = spark.createDataFrame(rows, "date date, symbol string, time timestamp_ntz, close double")
    assert returns.intraday_returns(df).first()["0930_30m"] is None


def test_readers(spark, bars):
    df = readers.read_bars(spark, bars, ["close"], "2024-01-09", "20240110", at=["0935"])
    assert df.columns == ["date", "symbol", "time", "close"] and df.count() == 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "volume" not in plan
    assert readers.read_one_date(spark, bars, DAYS[3]).select("symbol").distinct().count() == 1
    cal2 = readers.read_calendar(spark, bars, end="2024-01-12")
    assert cal2.count() == 5
    flags = spark.createDataFrame(
        [(DAYS[0], "A", True, float("nan")), (DAYS[0], "B", None, 1.0), (DAYS[1], "A", True, 2.0)], "date date, symbol string, u boolean, x double"
    )
    assert readers.read_universe(spark, flags, "u").count() == 2 and readers.read_universe(spark, flags).count() == 3
    out = readers.read_dataset(spark, flags, ["date", "symbol", "x"], universe="u", date_range=("20240108", "20240108"), date_col="date")
    assert [tuple(r) for r in out.collect()] == [(DAYS[0], "A", None)]
    with pytest.raises(ValueError):
        readers.read_dataset(spark, flags, ["symbol"], date_range=("20240108", "20240108"), date_col="date")
    with pytest.raises(ValueError):
        readers.read_dataset(spark, flags, ["date"], date_range=("20240108", "20240108"))
    with pytest.raises(ValueError):
        readers.read_bars(spark, flags, ["nothing"])


def test_incremental(spark, days, tmp_path):
    path = str(tmp_path / "item")
    asked = []

    def source(first, last):
        asked.append((first, last))
        rows = [(d, s, len(asked)) for d in DAYS for s in "AB" if first <= d <= last]
        return spark.createDataFrame(rows, "date date, symbol string, load int")

    assert sinks.loaded_dates(spark, path).count() == 0
    assert incremental.load_item(spark, source, path, days, DAYS[0], DAYS[7], now=LATE) == DAYS[:8]
    assert incremental.load_item(spark, source, path, days, DAYS[0], DAYS[7], now=LATE) == []
    assert incremental.load_item(spark, source, path, days, DAYS[0], DAYS[9], now=LATE, reload_last=3, days_per_job=2) == DAYS[5:10]
    assert asked == [(DAYS[0], DAYS[7]), (DAYS[5], DAYS[6]), (DAYS[7], DAYS[8]), (DAYS[9], DAYS[9])]
    got = {r["date"]: r["load"] for r in spark.read.parquet(path).collect()}
    assert got == {**{d: 1 for d in DAYS[:5]}, DAYS[5]: 2, DAYS[6]: 2, DAYS[7]: 3, DAYS[8]: 3, DAYS[9]: 4}
    assert spark.read.parquet(path).count() == 20
    # By day the range ends before its last day.
    noon = LATE.replace(hour=12)
    assert incremental.load_item(spark, source, path, days, DAYS[9], DAYS[10], now=noon) == []


def test_adjusted_bar_source(spark, bars, days, tmp_path):
    factors = spark.createDataFrame([(d, "A", 2.0) for d in DAYS], "date date, symbol string, adj_factor double")
    source = incremental.adjusted_bar_source(spark.read.parquet(bars), factors)
    path = str(tmp_path / "bars")
    assert incremental.load_item(spark, source, path, days, DAYS[0], DAYS[2], now=LATE, days_per_job=2) == DAYS[:3]
    got = spark.read.parquet(path)
    assert got.count() == 3 * 2 * 240
    assert {(r[0], r[1]) for r in got.select("symbol", "adj_factor").distinct().collect()} == {("A", 2.0), ("B", None)}


def test_dataset(spark, bars, days, tmp_path):
    df = spark.read.parquet(bars)
    univ = spark.createDataFrame([(d, s, s == "A") for d in DAYS for s in "ABX"], "date date, symbol string, big boolean")
    rets = return_tables.return_table(df, days)
    paths = {n: str(tmp_path / n) for n in ("univ", "return", "lag_return")} | {"bar_1m": bars}
    sinks.write_by_date(univ, paths["univ"])
    sinks.write_by_date(rets, paths["return"])
    sinks.write_by_date(return_tables.lag_return_table(spark.read.parquet(paths["return"]), days), paths["lag_return"])
    out = str(tmp_path / "set")
    ready = DAYS[:-1][:-6]  # the last day has no lagged returns
    assert dataset.build_dataset(spark, paths, out, ["close"]) == ready
    got = spark.read.parquet(out)
    rows = by_key(got)
    assert set(rows) == {(d, s) for d in ready for s in "ABX"}
    assert rows[(DAYS[0], "X")]["close_mean_0940"] is None and rows[(DAYS[3], "B")]["1000_1h"] is None
    assert rows[(DAYS[0], "A")]["close_mean_0940"] == pytest.approx(10.24, rel=1e-6)
    assert dict(got.dtypes)["close_std_1500"] == "float" and dict(got.dtypes)["big"] == "boolean"
    assert dataset.build_dataset(spark, paths, out, ["close"], only_new=True) == []
    ten = str(tmp_path / "bar_10m")
    assert dataset.downsample_pending(spark, bars, ten, ["close"]) == DAYS
    assert dataset.downsample_pending(spark, bars, ten, ["close"]) == []
    assert spark.read.parquet(ten).count() == 2 * len(DAYS) - 1


def test_hot_date_is_split_over_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        hot = spark.range(200_000).select(F.lit(DAYS[0]).alias("date"), F.col("id").cast("string").alias("symbol"), F.rand(1).alias("x"))
        cold = spark.range(2_000).select(F.date_add(F.lit(DAYS[1]), (F.col("id") % 20).cast("int")).alias("date"), F.lit("S").alias("symbol"), F.rand(2).alias("x"))
        sinks.write_by_date(hot.unionByName(cold), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = spark.read.parquet(path).where(F.col("date") == DAYS[0]).select(F.input_file_name()).distinct().count()
    assert files > 1 and spark.read.parquet(path).count() == 202_000


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError):
        returns.interval_vwap(spark.range(10))


def test_dates_are_not_cut(spark):
    old = spark.createDataFrame([("1985-01-02",), ("1995-01-03",), (None,)], "date string")
    assert datesets.pending_dates(old, old.limit(0)).count() == 2
    assert datesets.ready_dates(old, old, hold_back=1).first()["date"] == dt.date(1985, 1, 2)
    calendar = cal.trading_calendar(old)
    assert calendar.count() == 2
    moved = cal.shift_dates(calendar.select("date"), calendar, 1).where("shifted IS NOT NULL").first()
    assert tuple(moved) == (dt.date(1985, 1, 2), dt.date(1995, 1, 3))


def test_rows_off_the_calendar_stay(spark):
    calendar = cal.trading_calendar(spark.createDataFrame([(DAYS[0],), (DAYS[2],)], "date date"))
    prices = spark.createDataFrame([(d, "A", float(i + 1)) for i, d in enumerate(DAYS[:3])], "date date, symbol string, p double")
    got = returns.forward_returns(prices, calendar, {"r": "p"}, [1]).orderBy("date").collect()
    assert [(r["date"], r["r_1D"]) for r in got] == [(DAYS[0], 2.0), (DAYS[1], None), (DAYS[2], None)]


def test_work_folder(spark):
    a, b = workdir.work_folder(spark, "x"), workdir.work_folder(spark, "x")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert a != b and (shared is None or a.startswith(shared.rstrip("/")))
