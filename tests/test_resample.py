import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from barloom.functions.slots import trading_slots
from barloom.functions.values import is_valid, nan_to_null, numeric_to_float, prefixed, renamed
from barloom.operators import resample
from barloom.plans import panel

D1, D2 = dt.date(2024, 1, 8), dt.date(2024, 1, 9)
SCHEMA = "date date, symbol string, time timestamp_ntz, x double, n int"


def at(day, hhmm, seconds=0):
    return dt.datetime(day.year, day.month, day.day, int(hhmm[:2]), int(hhmm[2:]), seconds)


def bars(spark, rows):
    return spark.createDataFrame([(d, s, at(d, t, sec), x, n) for d, s, t, sec, x, n in rows], SCHEMA)


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_windows_are_closed_and_skip_the_gap(spark):
    df = bars(spark, [
        (D1, "A", "0931", 0, 1.0, 1), (D1, "A", "0940", 0, 3.0, 1), (D1, "A", "0940", 30, 50.0, 1),
        (D1, "A", "0941", 0, 4.0, 1), (D1, "A", "0930", 0, 9.0, 1), (D1, "A", "1130", 0, 5.0, 1),
        (D1, "A", "1131", 0, 9.0, 1), (D1, "A", "1300", 0, 9.0, 1), (D1, "A", "1301", 0, 6.0, 1), (D1, "A", "1500", 0, 7.0, 1),
    ])
    got = as_dict(resample.resample_long(df, ["x", "n"]), "slot")
    assert {k[0]: (r["x_mean"], r["count"]) for k, r in got.items()} == {
        "0940": (2.0, 2), "0950": (4.0, 1), "1130": (5.0, 1), "1310": (6.0, 1), "1500": (7.0, 1)
    }
    assert got[("0940",)]["x_std"] == pytest.approx(math.sqrt(2)) and got[("0950",)]["x_std"] is None


def test_moments_nan_and_null(spark):
    vals = [1.0, 2.0, 4.0, 9.0]
    df = bars(spark, [(D1, "A", f"093{i + 1}", 0, v, 5) for i, v in enumerate(vals)]
              + [(D1, "B", "0931", 0, float("nan"), 1), (D1, "B", "0932", 0, 1.0, 1)]
              + [(D1, "C", "0931", 0, None, 1), (D1, "C", "0932", 0, 3.0, 1)])
    got = as_dict(resample.resample_long(df, ["x", "n"], resample.ALL_STATS), "symbol")
    a = got[("A",)]
    assert a["x_skew"] == pytest.approx(0.7684172579878226) and a["x_kurt"] == pytest.approx(-1.0)
    assert a["x_std"] == pytest.approx(statistics.stdev(vals))
    assert a["n_skew"] is None and a["n_kurt"] is None and a["n_std"] == 0.0
    assert math.isnan(got[("B",)]["x_mean"]) and got[("C",)]["x_mean"] == 3.0 and got[("C",)]["count"] == 2
    clean = as_dict(nan_to_null(resample.resample_long(df, ["x"])), "symbol")
    assert clean[("B",)]["x_mean"] is None
    with pytest.raises(ValueError):
        resample.stat_columns(["x"], ["median"])
    with pytest.raises(ValueError):
        resample.resample_long(df.drop("time"), ["x"])


def test_many_bars_give_the_same_as_few(spark):
    rows = [(D, s, t, 0, float(i % 7) + h, 1) for h, s in enumerate("AB") for D in (D1, D2) for i, t in enumerate(trading_slots())]
    df = bars(spark, rows)
    names = [f"b{i}" for i in range(30)]
    wide_bars = df.select("date", "symbol", "time", *[(F.col("x") * (i + 1) + i).alias(n) for i, n in enumerate(names)])
    many = resample.resample_long(wide_bars, names).select("date", "symbol", "slot", "b0_mean", "b29_std", "count")
    few = resample.resample_long(wide_bars, ["b0", "b29"]).select("date", "symbol", "slot", "b0_mean", "b29_std", "count")
    assert many.count() == few.count() == 2 * 2 * 24
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()

    wide = panel.downsample_wide(wide_bars, names)
    assert wide.count() == 4 and len(wide.columns) == 2 + 30 * 2 * 24
    assert dict(wide.dtypes)["b7_std_1500"] == "float"
    by_long = numeric_to_float(resample.widen(resample.resample_long(wide_bars, names), resample.stat_names(names, ("mean", "std"))))
    assert wide.exceptAll(by_long.select(*wide.columns)).isEmpty()


def test_many_bars_are_moved_once(spark):
    """Minute rows are shuffled, not the blocks made of them; no exchange at all where they lie by symbol-day."""
    rows = [(s, t, i) for s in ("A", "B", None) for i, t in enumerate(trading_slots())] * 2
    rows = [(D1, s, t, 0, float(i % 7) if i % 5 else None, k) for k, (s, t, i) in enumerate(rows)]
    df = bars(spark, rows).withColumn("date", F.expr("IF(n % 3 = 0, NULL, date)"))
    names = [f"b{i}" for i in range(30)]
    made = ["date", "symbol", "time", *[f"x * {i + 1} + {i} AS `{n}`" for i, n in enumerate(names)]]

    def exchanges(out):
        return [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]

    loose = resample.resample_long(df.selectExpr(*made), names)
    at_places = resample.resample_long(resample.place(df.drop("n"), *resample.KEYS).selectExpr(*made), names, placed=True)
    # the caller's word alone: wrong, and the rows are right all the same
    wrong = resample.resample_long(df.selectExpr(*made).repartition(3, "time"), names, placed=True)
    assert len(exchanges(loose)) == len(exchanges(at_places)) == 1
    assert not any("block" in line for line in exchanges(loose) + exchanges(at_places))
    few = resample.resample_long(df.selectExpr(*made), ["b0", "b29"])
    want = few.select("date", "symbol", "slot", *[F.round(c, 6).alias(c) for c in ("b0_mean", "b0_std", "b29_mean", "b29_std")], "count")
    for out in (loose, at_places, wrong):
        got = out.select("date", "symbol", "slot", *[F.round(c, 6).alias(c) for c in ("b0_mean", "b0_std", "b29_mean", "b29_std")], "count")
        assert got.count() == want.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_long_wide_long(spark):
    df = bars(spark, [(D1, "A", t, 0, float(i), 1) for i, t in enumerate(trading_slots("0930", "1030"))] + [(D2, "B", "1301", 0, 2.0, 1)])
    long = resample.resample_long(df, ["x"], ("mean",))
    wide = resample.widen(long, ["x_mean"])
    back = resample.unwiden(wide, ["x_mean"])
    assert back.count() == 2 * 24
    kept = back.where(F.col("x_mean").isNotNull())
    assert kept.exceptAll(long.select("date", "symbol", "slot", "x_mean")).isEmpty() and kept.count() == long.count()
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2


def _morning(spark):
    full = trading_slots("0930", "1000", closed="right")
    rows = [(d, "A", t, 0, 1.0, 1) for d in (D1, D2) for t in full]
    rows += [(D1, "B", t, 0, 1.0, 1) for t in full[:-1]] + [(D2, "B", t, 0, 2.0, 1) for t in full]
    rows += [(D1, "C", t, 0, 1.0, 1) for t in full[:-1]] + [(D1, "C", "0940", 30, 99.0, 1)]
    rows += [(D1, "E", t, 0, 1.0, 1) for t in full]
    return bars(spark, rows)


def test_completeness_is_per_symbol_and_day(spark):
    df = _morning(spark)
    slots = trading_slots("0930", "1000", closed="right")
    got = {(r["date"], r["symbol"]) for r in resample.complete_symbols(df, slots).collect()}
    # C has thirty bar times, though one of them is in no window.
    assert got == {(D1, "A"), (D2, "A"), (D2, "B"), (D1, "C"), (D1, "E")}


@pytest.mark.parametrize("one_day", [True, False])
def test_online_features(spark, one_day):
    univ = spark.createDataFrame([(d, s) for d in (D1, D2) for s in "ABCX"], "date date, symbol string")
    out = panel.online_features(_morning(spark), ["x", "n"], ("0930", "1000"), univ, one_day=one_day)
    got = as_dict(out, "date", "symbol")
    assert set(got) == {(D1, "A"), (D2, "A"), (D2, "B"), (D1, "C")}
    assert got[(D2, "B")]["x_mean_0950"] == 2.0 and got[(D1, "C")]["x_mean_0940"] == 1.0
    assert set(out.columns) == {"date", "symbol", *resample.slot_names(resample.stat_names(["x", "n"], ("mean", "std")), ["0940", "0950", "1000"])}
    assert set(as_dict(panel.online_features(_morning(spark), ["x"], ("0930", "1000")), "date", "symbol")) == set(got) | {(D1, "E")}
    every = as_dict(panel.slot_range_features(_morning(spark), ["x"], ("0930", "1000"), univ), "date", "symbol")
    assert len(every) == 8 and every[(D1, "X")]["x_mean_0940"] is None and every[(D1, "B")]["x_mean_1000"] == 1.0


def test_window_report(spark):
    rows = resample.windows_complete(resample.resample_long(_morning(spark), ["x"]))
    got = as_dict(rows, "date")
    assert got[(D1,)]["complete"] is False and got[(D2,)]["complete"] is True and got[(D2,)]["windows"] == 6


def test_hot_symbol(spark):
    """A third of all rows in one symbol-day, in one minute: whole result, bounded partial rows."""
    hot = spark.range(60_000).select(
        F.lit(D1).alias("date"), F.lit("HOT").alias("symbol"), F.lit(at(D1, "0935")).cast("timestamp_ntz").alias("time"),
        (F.col("id") % 10).cast("double").alias("x"),
    )
    rest = spark.range(120_000).select(
        F.lit(D1).alias("date"), F.concat(F.lit("S"), (F.col("id") % 500)).alias("symbol"),
        F.lit(at(D1, "0936")).cast("timestamp_ntz").alias("time"), F.col("id").cast("double").alias("x"),
    )
    got = as_dict(resample.resample_long(hot.unionByName(rest), ["x"]), "symbol")
    assert len(got) == 501 and got[("HOT",)]["count"] == 60_000 and got[("HOT",)]["x_mean"] == pytest.approx(4.5)
    assert got[("S7",)]["count"] == 240


def test_value_helpers(spark):
    df = spark.createDataFrame([(1, 2.5, float("nan"), True, "a")], "i int, d double, e double, b boolean, s string")
    row = nan_to_null(df, ["d"]).first()
    assert math.isnan(row["e"])
    assert nan_to_null(df).first()["e"] is None
    assert dict(numeric_to_float(df).dtypes) == {"i": "float", "d": "float", "e": "float", "b": "boolean", "s": "string"}
    assert prefixed(df, "lag_", keep=["s"]).columns == ["lag_i", "lag_d", "lag_e", "lag_b", "s"]
    two = spark.createDataFrame([(1.0, 2.0)], "x_avg_0940 double, x_stddevSamp_0940 double")
    assert renamed(two, {"avg": "mean", "stddevSamp": "std"}).columns == ["x_mean_0940", "x_std_0940"]
    assert [r[0] for r in df.select(is_valid("d"), is_valid("e")).select("*").toPandas().T.values.tolist()] == [True, False]
