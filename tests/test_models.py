import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import calendar as cal, matrices, scaling
from barloom.plans import alpha, scoring, training

DAYS = [d for d in (dt.date(2024, 1, 8) + dt.timedelta(i) for i in range(60)) if d.weekday() < 5]
MODELS = training.MODEL_SCHEMA


@pytest.fixture(scope="module")
def days(spark):
    return cal.trading_calendar(spark.createDataFrame([(d,) for d in DAYS], "date date"))


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_zscores(spark):
    vals = {DAYS[0]: [1.0, 2.0, 4.0], DAYS[1]: [5.0, 5.0], DAYS[2]: [7.0]}
    df = spark.createDataFrame([(d, v, 3.0, "k") for d, vs in vals.items() for v in vs], "date date, x double, c double, s string")
    fit = scaling.normaliser("zscore", df, ["x", "c"])
    every = [v for vs in vals.values() for v in vs]
    assert fit.params["x"] == pytest.approx((statistics.mean(every), statistics.stdev(every)))
    out = fit.transform(df)
    assert out.columns == df.columns
    assert all(r["c"] is None and r["s"] == "k" for r in out.collect())
    zs = [r["x"] for r in out.collect()]
    assert statistics.mean(zs) == pytest.approx(0) and statistics.stdev(zs) == pytest.approx(1)
    assert {r["feature"] for r in fit.to_table(spark).collect()} == {"x", "c"}
    cs = scaling.normaliser("cs_zscore", df, ["x"]).transform(df)
    got = {}
    for r in cs.collect():
        got.setdefault(r["date"], []).append(r["x"])
    assert sorted(got[DAYS[0]]) == pytest.approx(sorted((v - 7 / 3) / statistics.stdev(vals[DAYS[0]]) for v in vals[DAYS[0]]))
    assert got[DAYS[1]] == [None, None] and got[DAYS[2]] == [None]
    with pytest.raises(ValueError):
        scaling.normaliser("minmax", df, ["x"])


@pytest.fixture(scope="module")
def models(spark):
    rows = []
    for i, m in enumerate([DAYS[2], DAYS[5], DAYS[9]]):
        for y in ("y1", "y2"):
            rows += [("P", m, y, "(intercept)", 1.0 * i, None, None), ("P", m, y, "a", 2.0 + i, 1.0, 2.0)]
        rows.append(("P", m, "y1", "b", 1.0, 0.0, 1.0))
        rows.append(("P", m, "y2", "flat", 9.0, 3.0, 0.0))
    return spark.createDataFrame(rows, MODELS)


def test_linear_scores(spark, models):
    data = spark.createDataFrame(
        [(d, s, a, b, 5.0) for d in DAYS[:12] for s, a, b in [("A", 3.0, 4.0), ("N", None, float("nan")), ("M", None, 4.0)]],
        "date date, symbol string, a double, b double, flat double",
    ).withColumn("flat", F.when(F.col("symbol") != "N", F.col("flat")))
    x = ["a", "b", "flat"]
    one = by_key(scoring.score_linear(data, models, x, ["y1", "y2"], 1), "date", "symbol")
    assert (DAYS[1], "A") not in one and (DAYS[2], "A") in one
    assert one[(DAYS[2], "A")]["y1"] == pytest.approx(2 * 1 + 4) and one[(DAYS[2], "A")]["y2"] == pytest.approx(2.0)
    assert one[(DAYS[5], "A")]["y1"] == pytest.approx(1 + 3 * 1 + 4)
    assert one[(DAYS[5], "N")]["y1"] is None and one[(DAYS[5], "M")]["y1"] == pytest.approx(1 + 4)
    several = by_key(scoring.score_linear(data, models, x, ["y1", "y2"], [1, 2]), "date", "symbol", "n_latest")
    for (d, s), r in one.items():
        assert several[(d, s, 1)]["y1"] == r["y1"]
    assert several[(DAYS[5], "A", 2)]["y1"] == pytest.approx((6 + 8) / 2)
    assert several[(DAYS[2], "A", 2)]["y1"] == pytest.approx(6)
    none = scoring.score_linear(data.where(F.col("date") < DAYS[2]), models, x, ["y1"], 1)
    assert none.count() == 0
    with pytest.raises(Exception, match="not among the inputs"):
        scoring.score_linear(data, models, ["a", "b"], ["y2"], 1).collect()


def test_long_histories_of_models_are_cut(spark, models, monkeypatch):
    data = spark.createDataFrame(
        [(d, "A", 3.0, 4.0, 1.0) for d in DAYS[:12]] * 2, "date date, symbol string, a double, b double, flat double"
    )
    want = sorted(scoring.score_linear(data, models, ["a", "b", "flat"], ["y1"], [1, 3]).collect())
    assert len(want) == 40  # rows keep their multiplicity
    monkeypatch.setattr(scoring, "SENT_BYTES", 1)
    monkeypatch.setattr(scoring, "SLICE_BYTES", 50)
    assert sorted(scoring.score_linear(data, models, ["a", "b", "flat"], ["y1"], [1, 3]).collect()) == want
    days = data.select("date").where(F.col("date") > DAYS[6]).distinct()
    late = data.join(days, "date")
    got = scoring.score_linear(late, models, ["a", "b", "flat"], ["y1"], [1, 3], dates=days)
    assert sorted(got.collect()) == [r for r in want if r["date"] > DAYS[6]]


def test_partial_models(spark):
    rows = [
        ("P", DAYS[2], "y1", "(intercept)", 7.0, None, None),
        ("P", DAYS[3], "y2", "a", 2.0, 1.0, 2.0), ("P", DAYS[3], "y2", "a", 4.0, 1.0, 2.0),
        ("P", DAYS[3], "y2", "b", float("nan"), 0.0, 1.0), ("P", DAYS[3], "y2", "b", 5.0, float("nan"), 1.0),
        ("P", DAYS[3], "y2", "(intercept)", None, None, None),
    ]
    models = spark.createDataFrame(rows, MODELS)
    data = spark.createDataFrame([(DAYS[2], "A", 3.0, 1.0), (DAYS[4], "A", 3.0, 1.0), (None, "A", 1.0, 1.0)], "date date, symbol string, a double, b double")
    dense = by_key(scoring.score_linear(data, models, ["a", "b"], ["y1", "y2"], 2), "date", "symbol")
    assert tuple(dense[(DAYS[2], "A")])[2:] == (7.0, None)
    assert tuple(dense[(DAYS[4], "A")])[2:] == (7.0, 6.0)
    singles = scoring.linear_predictions(data, models, ["a", "b"], 2)
    assert by_key(scoring.ensemble(singles, ["y1", "y2"], 2), "date", "symbol") == dense


def test_nan_in_training(spark):
    rows = [(DAYS[0], f"S{i}", float(i), float("nan") if i == 3 else float(i % 7), 2.0 * i - (i % 7) if i != 3 else float("nan")) for i in range(60)]
    train = spark.createDataFrame(rows, "date date, symbol string, a double, b double, y double")
    models = training.train_linear(train, ["a", "b"], ["y"], "P", DAYS[0])
    w = by_key(models, "feature")
    assert w[("b",)]["weight"] / w[("b",)]["std"] == pytest.approx(-1, rel=1e-6)
    scored = scoring.score_linear(train, models, ["a", "b"], ["y"], 1).collect()
    assert len(scored) == 60 and all(r["y"] is not None for r in scored)


def test_null_matrices(spark):
    frame = spark.createDataFrame([(1, [[1.0, 2.0]]), (2, None), (3, [[None, 4.0]])], "k int, x array<array<double>>")
    got = scoring.score_with(frame, lambda x: np.nansum(x, axis=(1, 2))[:, None], ["y"], (1, 2)).collect()
    assert {(r["k"], r["y"]) for r in got} == {(1, 3.0), (2, 0.0), (3, 4.0)}


def test_wide_normalisers(spark):
    columns = [f"c{i}" for i in range(600)]
    frame = spark.range(20).selectExpr("id", "CAST('2024-01-0' || (id % 2 + 1) AS DATE) AS date", *[f"CAST(id * {i} AS DOUBLE) AS c{i}" for i in range(600)])
    fitted = scaling.ZScore.fit(frame, columns)
    assert fitted.params["c0"] == (0.0, 0.0) and fitted.params["c599"][0] == pytest.approx(9.5 * 599)
    row = fitted.transform(frame).where("id = 19").first()
    assert row["c0"] is None and row["c599"] == pytest.approx(row["c1"]) and row["c1"] == pytest.approx(9.5 / statistics.stdev(range(20)))
    daily = scaling.CrossSectionalZScore(columns, days=2).transform(frame).where("id = 19").first()
    assert daily["c7"] == pytest.approx(9 / statistics.stdev(range(1, 20, 2)))


def test_matrices_and_any_model(spark, models):
    rows = [(d, s, slot, float(i), float(10 * i)) for d in DAYS[:8] for s in "AB" for i, slot in enumerate(["0940", "0950", "1000"]) if (s, slot) != ("B", "0950")]
    long = spark.createDataFrame(rows, "date date, symbol string, slot string, f double, g double")
    slots = ["0940", "0950", "1000"]
    m = matrices.matrix_from_long(long, ["f", "g"], slots)
    got = by_key(m, "date", "symbol")
    assert got[(DAYS[0], "A")]["x"] == [[0.0, 0.0], [1.0, 10.0], [2.0, 20.0]]
    assert got[(DAYS[0], "B")]["x"] == [[0.0, 0.0], [None, None], [2.0, 20.0]]
    wide = long.groupBy("date", "symbol").agg(*[F.max(F.when(F.col("slot") == s, F.col(v))).alias(f"{v}_{s}") for v in "fg" for s in slots])
    assert by_key(matrices.matrix_from_wide(wide, ["f", "g"], slots), "date", "symbol")[(DAYS[0], "B")]["x"] == got[(DAYS[0], "B")]["x"]

    def last_slot(x):
        return x[:, -1, :] + np.nan_to_num(x[:, 1, :])

    scored = by_key(scoring.score_with(m, last_slot, ["u", "v"], (3, 2)), "date", "symbol")
    assert (scored[(DAYS[0], "A")]["u"], scored[(DAYS[0], "A")]["v"]) == (3.0, 30.0)
    assert scored[(DAYS[0], "B")]["v"] == 20.0

    marks = [DAYS[2], DAYS[5]]

    def versioned(x, milestone):
        return x[:, -1, :1] * (1 + marks.index(milestone))

    ens = by_key(scoring.score_versions(m, models, versioned, ["u"], (3, 2), n_latest=2), "date", "symbol")
    assert (DAYS[1], "A") not in ens
    assert ens[(DAYS[3], "A")]["u"] == 2.0 and ens[(DAYS[7], "A")]["u"] == pytest.approx((2 + 4) / 2)


def test_training(spark, days):
    rng = np.random.default_rng(3)
    rows = []
    for d in DAYS:
        for s in range(20):
            a, b = rng.normal(5, 2), rng.normal(-1, 3)
            rows.append((d, f"S{s}", float(a), float(b), 7.0, float(2 * a - 3 * b + 4)))
    df = spark.createDataFrame(rows, "date date, symbol string, a double, b double, flat double, y double")
    milestone = DAYS[30]
    # A later day must not matter.
    df = df.withColumn("y", F.when(F.col("date") > F.lit(DAYS[30]), F.lit(1e6)).otherwise(F.col("y")))
    got, tagged = training.train_on_milestone(df, days, ["a", "b", "flat"], ["y"], "P", milestone, n_train=20, n_eval=4, n_lag=2)
    assert {r["split"] for r in tagged.select("split").distinct().collect()} == {"train", "eval"}
    w = by_key(got, "feature")
    assert w[("a",)]["weight"] / w[("a",)]["std"] == pytest.approx(2, rel=1e-6)
    assert w[("b",)]["weight"] / w[("b",)]["std"] == pytest.approx(-3, rel=1e-6)
    assert {r["milestone"] for r in w.values()} == {milestone}
    scored = scoring.score_linear(df.where(F.col("date") == F.lit(DAYS[30])), got, ["a", "b", "flat"], ["y"], 1)
    both = scored.withColumnRenamed("y", "p").join(df, ["date", "symbol"]).collect()
    assert len(both) == 20 and all(r["p"] == pytest.approx(r["y"], rel=1e-6) for r in both)


def test_alpha(spark, days, tmp_path):
    preds = spark.createDataFrame(
        [(DAYS[4], "A", 0.5), (DAYS[4], "B", float("nan")), (DAYS[5], "A", None)], "date date, symbol string, lag_rtn_v2v_0935_2D double"
    )
    rows = alpha.alpha_rows(preds, "0930", days)
    assert rows.columns == ["date", "time", "symbol", "alpha"]
    got = by_key(rows, "date", "symbol")
    assert got[(DAYS[5], "A")]["alpha"] == 0.5 and got[(DAYS[5], "A")]["time"] == dt.datetime.combine(DAYS[5], dt.time(9, 30))
    valid = by_key(alpha.alpha_validity(rows), "date")
    assert tuple(valid[(DAYS[5],)])[1:] == (2, 1) and tuple(valid[(DAYS[6],)])[1:] == (1, 0)
    same_day = preds.withColumnRenamed("lag_rtn_v2v_0935_2D", "rtn_v2v_1005_2D")
    assert by_key(alpha.alpha_rows(same_day, "1000", days), "date", "symbol")[(DAYS[4], "A")]["time"].hour == 10
    path = str(tmp_path / "alpha")
    alpha.write_alpha(rows, path, "0930")
    with pytest.raises(Exception, match="calendar ends too early"):
        alpha.write_alpha(rows.withColumn("date", F.lit(None).cast("date")), path, "0930")
    alpha.write_alpha(rows.where(F.col("date") == DAYS[6]).withColumn("alpha", F.lit(9.0)), path, "0930")
    back = by_key(spark.read.parquet(path), "date", "symbol")
    assert len(back) == 3 and back[(DAYS[6], "A")]["alpha"] == 9.0 and back[(DAYS[5], "A")]["alpha"] == 0.5
    assert alpha.alpha_online(None, None, "1000", ["close"], days, "2024-01-13") is None
