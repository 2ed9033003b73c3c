"""Panel tables derived from the test tables: Spark builders, and the same as SQL.

One symbol per twenty suppliers, so the panel grows with the data; twelve
weekdays and 240 session minutes per symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.clock import at_minute
from barloom.operators.calendar import trading_calendar

BARS = ("open", "high", "low", "close", "volume", "amount", "total_trades")
# Name of a universe member that never has bars.
GHOST = "S999999"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _date(p: Column) -> Column:
    week = F.call_function("div", p, F.lit(5)) * 7 + p % 5
    return F.date_add(F.lit("2024-01-08").cast("date"), week.cast("int"))


def _symbol(group: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(group.cast("string"), 6, "0"))


def bar_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars from lineitem. First and last trade are taken by a key that is a total order."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    order = (
        F.call_function("div", F.col("l_orderkey"), F.lit(240)) * 10_000_000_000
        + F.round(F.col("l_extendedprice") * 100).cast("bigint") * 100
        + F.col("l_quantity").cast("bigint")
    )
    p, k = F.col("l_partkey") % 12, F.col("l_orderkey") % 240
    trades = table(spark, sf_dir, "lineitem").select(
        p.alias("p"),
        k.alias("k"),
        (571 + k + F.when(k >= 120, 90).otherwise(0)).cast("int").alias("minute"),
        F.call_function("div", F.col("l_suppkey"), F.lit(20)).alias("g"),
        order.alias("ord"),
        price.alias("price"),
        "l_quantity",
        "l_extendedprice",
    )
    bars = trades.groupBy("p", "k", "g").agg(
        F.min("minute").alias("minute"),
        F.min_by("price", "ord").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "ord").alias("close"),
        F.sum("l_quantity").alias("volume"),
        F.sum("l_extendedprice").alias("amount"),
        F.count(F.lit(1)).alias("total_trades"),
    )
    date = _date(F.col("p"))
    return bars.select(
        date.alias("date"), _symbol(F.col("g")).alias("symbol"), at_minute(date, F.col("minute")).alias("time"), *BARS
    )


def nan_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars with ``close`` NaN where there was a single trade."""
    close = F.when(F.col("total_trades") == 1, F.lit(float("nan"))).otherwise(F.col("close"))
    return bar_1m(spark, sf_dir).withColumn("close", close)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 12).alias("p")).distinct()
    return trading_calendar(days.select(_date(F.col("p")).alias("date")))


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long calendar: the weekdays on which orders were placed."""
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return trading_calendar(days.where(F.dayofweek("date").between(2, 6)))


def _symbol_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_partkey") % 12).alias("p"), F.call_function("div", F.col("l_suppkey"), F.lit(20)).alias("g"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def univ(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe flags per symbol-day, and one member a day that has no bars."""
    known = _symbol_days(spark, sf_dir).select(
        _date(F.col("p")).alias("date"), _symbol(F.col("g")).alias("symbol"), (F.col("n") % 3 != 0).alias("euniv_largemid")
    )
    ghost = calendar(spark, sf_dir).select("date", F.lit(GHOST).alias("symbol"), F.lit(True).alias("euniv_largemid"))
    return known.unionByName(ghost)


def adj_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _symbol_days(spark, sf_dir).select(
        _date(F.col("p")).alias("date"), _symbol(F.col("g")).alias("symbol"), (F.lit(1.0) + (F.col("p") % 3) / 10.0).alias("adj_factor")
    )


# (prod, y, feature, weight, mean, std) of the model of the first milestone.
MODEL_TERMS = [
    (prod, y, feature, w, m, s)
    for prod, ys, features in (
        (
            "1000",
            ("rtn_v2v_1005_1D", "rtn_v2v_1005_2D", "rtn_v2v_1005_5D"),
            (("close_mean_0940", 0.5, 1500.0, 800.0), ("volume_mean_1000", -0.25, 100.0, 40.0), ("(intercept)", 0.125, None, None)),
        ),
        ("0930", ("lag_rtn_v2v_0935_2D",), (("close_mean_1310", 0.5, 1500.0, 800.0), ("close_mean_1500", 0.25, 1500.0, 700.0))),
    )
    for i, y in enumerate(ys)
    for feature, w0, m, s in features
    for w in (w0 * (i + 1),)
]


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model every third calendar date, its weights growing with its position."""
    days = calendar(spark, sf_dir).where(F.col("idx") % 3 == 1)
    terms = F.array(
        *[
            F.struct(
                F.lit(prod).alias("prod"),
                F.lit(y).alias("y"),
                F.lit(f).alias("feature"),
                F.lit(w).alias("w"),
                F.lit(m).cast("double").alias("mean"),
                F.lit(s).cast("double").alias("std"),
            )
            for prod, y, f, w, m, s in MODEL_TERMS
        ]
    )
    return days.select("date", "idx", F.inline(terms)).select(
        "prod",
        F.col("date").alias("milestone"),
        "y",
        "feature",
        (F.col("w") * (1 + F.col("idx") / 8.0)).alias("weight"),
        "mean",
        "std",
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of ticks: (time, symbol, value), one symbol per fifty users."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    # A glob, because a stream reads folders or patterns, not a single file.
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    return tick_columns(rows)


def tick_columns(events: DataFrame) -> DataFrame:
    symbol = F.concat(F.lit("U"), F.lpad(F.call_function("div", F.col("user_id"), F.lit(50)).cast("string"), 6, "0"))
    return events.select(F.col("ts").cast("timestamp").alias("time"), symbol.alias("symbol"), "value")


def _null(v) -> str:
    return "NULL" if v is None else repr(v)


_TERMS = ", ".join(f"('{p}', '{y}', '{f}', {w!r}::DOUBLE, {_null(m)}::DOUBLE, {_null(s)}::DOUBLE)" for p, y, f, w, m, s in MODEL_TERMS)
_DAY = "CAST(DATE '2024-01-08' + CAST(7 * (p // 5) + p % 5 AS INTEGER) AS DATE)"
_SYM = "'S' || lpad(CAST(g AS VARCHAR), 6, '0')"

# The same tables as common table expressions.
FIXTURE_SQL = f"""
trades AS (
  SELECT l_partkey % 12 AS p, l_orderkey % 240 AS k, l_suppkey // 20 AS g,
         (l_orderkey // 240) * 10000000000 + CAST(round(l_extendedprice * 100) AS BIGINT) * 100
           + CAST(l_quantity AS BIGINT) AS ord,
         l_extendedprice / l_quantity AS price, l_quantity, l_extendedprice
  FROM lineitem),
bar_1m AS (
  SELECT {_DAY} AS date, {_SYM} AS symbol,
         CAST({_DAY} AS TIMESTAMP) + to_minutes(CAST(571 + k + CASE WHEN k >= 120 THEN 90 ELSE 0 END AS INTEGER)) AS time,
         open, high, low, close, volume, amount, total_trades
  FROM (SELECT p, k, g, min_by(price, ord) AS open, max(price) AS high, min(price) AS low, max_by(price, ord) AS close,
               sum(l_quantity) AS volume, sum(l_extendedprice) AS amount, count(*) AS total_trades
        FROM trades GROUP BY p, k, g)),
slotted AS (
  SELECT *, strftime(time, '%H%M') AS hhmm,
         strftime(time_bucket(INTERVAL 10 MINUTE, time - INTERVAL 1 MINUTE) + INTERVAL 10 MINUTE, '%H%M') AS slot
  FROM bar_1m),
calendar AS (
  SELECT date, row_number() OVER (ORDER BY date) - 1 AS idx, lag(date) OVER (ORDER BY date) AS prev,
         lead(date) OVER (ORDER BY date) AS next
  FROM (SELECT DISTINCT date FROM bar_1m)),
order_calendar AS (
  SELECT date, row_number() OVER (ORDER BY date) - 1 AS idx, lag(date) OVER (ORDER BY date) AS prev,
         lead(date) OVER (ORDER BY date) AS next
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE isodow(o_orderdate) <= 5)),
symbol_days AS (SELECT p, g, count(*) AS n FROM trades GROUP BY p, g),
univ AS (
  SELECT {_DAY} AS date, {_SYM} AS symbol, n % 3 <> 0 AS euniv_largemid FROM symbol_days
  UNION ALL SELECT date, '{GHOST}', true FROM calendar),
adj_factor AS (SELECT {_DAY} AS date, {_SYM} AS symbol, 1.0::DOUBLE + (p % 3) / 10.0::DOUBLE AS adj_factor FROM symbol_days),
models AS (
  SELECT t.prod, c.date AS milestone, t.y, t.feature, t.w * (1 + c.idx / 8.0::DOUBLE) AS weight, t.mean, t.std
  FROM calendar c CROSS JOIN (VALUES {_TERMS}) t(prod, y, feature, w, mean, std)
  WHERE c.idx % 3 = 1)
"""


def with_fixtures(sql: str) -> str:
    """A query over the fixture tables: ``WITH ... SELECT`` or a bare ``SELECT``."""
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {FIXTURE_SQL.strip()},\n{body[5:]}"
    return f"WITH {FIXTURE_SQL.strip()}\n{body}"
