"""Tables bucketed by date and symbol."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators.returns import adjusted_bars
from barloom.sources import bucketed, incremental

FIRST = dt.date(2023, 1, 2)
DAYS = [FIRST + dt.timedelta(days=i) for i in range(250)]


@pytest.fixture
def unbroadcast(spark):
    """Small test tables are joined as large ones are."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def tables(spark, tmp_path):
    """Bars of 250 days in which one symbol has a third of the rows, and factors of most symbol-days."""
    day = F.date_add(F.lit(FIRST), (F.col("id") % 250).cast("int")).alias("date")
    n = F.floor(F.col("id") / 250)
    symbol = F.when(n % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), n.cast("string"))).alias("symbol")
    bars = spark.range(250 * 60).select(day, symbol, n.cast("int").alias("minute"), (n * 1.5).alias("close"))
    factors = bars.select("date", "symbol").distinct().where("symbol <> 'S7'").withColumn("adj_factor", F.dayofyear("date") / 100.0)
    bucketed.write_bucketed(bars, "bars_in_buckets", 8, str(tmp_path / "bars"))
    bucketed.write_bucketed(factors, "factors_in_buckets", 8, str(tmp_path / "factors"))
    yield bars, factors
    for name in ("bars_in_buckets", "factors_in_buckets"):
        spark.sql(f"DROP TABLE {name}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_year_of_bars_meets_its_factors_without_exchange(spark, tables, unbroadcast):
    bars, factors = tables
    source = bucketed.bucketed_bar_source(spark, "bars_in_buckets", "factors_in_buckets")
    year = source(DAYS[0], DAYS[-1])
    assert "Join" in plan(year) and "Exchange" not in plan(year)
    assert "Exchange" in plan(adjusted_bars(bars, factors))
    assert rows(year) == rows(adjusted_bars(bars, factors))
    part = source(DAYS[20], DAYS[29])
    assert "Exchange" not in plan(part) and part.count() == 10 * 60
    assert part.where("adj_factor IS NULL").select("symbol").distinct().collect() == [("S7",)]


def test_a_hot_symbol_is_dealt_by_its_days(spark, tables):
    of_file = spark.table("bars_in_buckets").groupBy(F.input_file_name()).count().collect()
    assert len(of_file) == 8 and max(r["count"] for r in of_file) < 2 * 250 * 60 / 8


def test_loads_from_buckets(spark, tables, tmp_path):
    days = spark.createDataFrame([(d,) for d in DAYS], "date date")
    source = bucketed.bucketed_bar_source(spark, "bars_in_buckets", "factors_in_buckets")
    path = str(tmp_path / "loaded")
    now = dt.datetime(2024, 1, 1, 23, 30)
    assert incremental.load_item(spark, source, path, days, DAYS[5], DAYS[9], now=now) == DAYS[5:10]
    assert spark.read.parquet(path).count() == 5 * 60


def test_null_keys_repeated_rows_and_no_rows(spark):
    data = spark.createDataFrame([(FIRST, "A", 1), (FIRST, "A", 1), (None, "A", 2), (FIRST, None, 3)], "date date, symbol string, v int")
    assert rows(bucketed.bucketed(data, "some", 3)) == rows(data)
    assert bucketed.bucketed(data.limit(0), "none", 3).collect() == []
    for wrong in (lambda: bucketed.bucketed(data, "some", 0), lambda: bucketed.bucketed(data.drop("date"), "some", 3)):
        with pytest.raises(ValueError):
            wrong()


def test_the_broadcast_of_a_span_is_counted(spark, tables, unbroadcast, monkeypatch):
    bars, factors = tables
    source = incremental.adjusted_bar_source(bars, factors)
    small = source(DAYS[0], DAYS[9])
    assert "BroadcastHashJoin" in plan(small)
    monkeypatch.setattr(incremental, "BROADCAST_ROWS", 100)
    large = source(DAYS[0], DAYS[9])
    assert "BroadcastHashJoin" not in plan(large) and rows(large) == rows(small)
