"""Vectors of moments, normalisers on odd values, and models from summed products."""

import datetime as dt
import math

import numpy as np
import pytest

from barloom.operators import moments, scaling
from barloom.operators.calendar import trading_calendar
from barloom.plans import scoring, walk_forward

INF, NAN = float("inf"), float("nan")
DAYS = [dt.date(2024, 1, d) for d in range(2, 14)]


@pytest.fixture
def wide(spark):
    """60 rows of 40 columns over three dates and a NULL one, with gaps and one infinity."""
    rng = np.random.default_rng(3)
    x = rng.normal(100, 5, (60, 40))
    x[rng.random(x.shape) < 0.1] = NAN
    x[:, 7], x[5, 3], x[:20, 9] = 2.5, INF, NAN
    days = [[None, *DAYS[:3]][i % 4] for i in range(60)]
    columns = [f"c{i}" for i in range(40)]
    schema = "date date, " + ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame([(d, *map(float, r)) for d, r in zip(days, x)], schema).repartition(5), x, days, columns


def close(got, want):
    return (got is None and want is None) or (got is not None and want is not None and math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-9))


def plain(x):
    there = x[~np.isnan(x)]
    if np.isinf(there).any():
        return None, None
    return (there.mean() if len(there) else None), (there.std(ddof=1) if len(there) > 1 else None)


@pytest.mark.parametrize("few", [0, 64])
def test_statistics_by_date_and_of_all(wide, few, monkeypatch):
    df, x, days, columns = wide
    monkeypatch.setattr(scaling, "FEW", few)  # vectors, or aggregates side by side
    monkeypatch.setattr(moments, "HELD_BYTES", 24 * 40 * 2)
    for row in scaling.statistics(df, columns, "date").collect():
        own = x[[d == row["key"] for d in days]]
        assert all(close(m, w) for m, w in zip(row["mean"], (plain(own[:, i])[0] for i in range(40))))
        assert all(close(s, w) for s, w in zip(row["std"], (plain(own[:, i])[1] for i in range(40))))
    whole = scaling.ZScore.fit(df, columns).params
    for i, c in enumerate(columns):
        assert all(close(a, b) for a, b in zip(whole[c], plain(x[:, i])))


def test_an_infinity_makes_its_column_null(spark):
    df = spark.createDataFrame([(DAYS[0], 1.0, 1.0), (DAYS[0], INF, 3.0), (DAYS[1], 2.0, NAN)], "date date, a double, b double")
    scaler = scaling.ZScore.fit(df, ["a", "b"])
    assert scaler.params["a"] == (None, None) and scaler.params["b"] == (2.0, math.sqrt(2))
    assert [r["a"] for r in scaler.transform(df).collect()] == [None] * 3
    within = scaling.CrossSectionalZScore(["a"]).transform(df).collect()
    assert [r["a"] for r in within] == [None] * 3


def test_rows_without_a_date_stay(spark):
    df = spark.createDataFrame([(DAYS[0], 1.0), (DAYS[0], 3.0), (None, 5.0)], "date date, a double")
    got = {(r["date"], r["a"] and round(r["a"], 6)) for r in scaling.CrossSectionalZScore(["a"]).transform(df).collect()}
    assert got == {(DAYS[0], -0.707107), (DAYS[0], 0.707107), (None, None)}


@pytest.fixture
def panel(spark):
    rng = np.random.default_rng(5)
    rows = []
    for d in DAYS:
        for s in range(30):
            a, b, c = rng.normal(50, 10), rng.normal(-3, 1), 4.0
            y = 0.2 * a - 1.5 * b + rng.normal(0, 0.5)
            rows.append((d, f"S{s}", None if s % 7 == 0 else a, NAN if s % 5 == 0 else b, c, None if s % 4 == 0 else y, s % 3 != 0))
    return spark.createDataFrame(rows, "date date, symbol string, a double, b double, c double, y double, member boolean")


def reference(panel, first, last, regs, lo, hi):
    rows = [r for r in panel.collect() if r["member"]]
    ok = lambda v: v is not None and not math.isnan(v)
    train = [r for r in rows if first <= r["date"] <= last]
    stats = {c: plain(np.array([r[c] if ok(r[c]) else NAN for r in train])) for c in "abc"}

    def design(some):
        some = [r for r in some if ok(r["y"])]
        z = [[(r[c] - stats[c][0]) / stats[c][1] if ok(r[c]) and stats[c][1] else 0.0 for c in "abc"] for r in some]
        return np.array(z), np.array([r["y"] for r in some])

    z, y = design(train)
    ze, ye = design([r for r in rows if lo <= r["date"] <= hi])
    out = {}
    for reg in regs:
        zc, yc = z - z.mean(0), y - y.mean()
        w = np.linalg.lstsq(zc.T @ zc / len(y) + reg * np.eye(3), zc.T @ yc / len(y), rcond=None)[0]
        b = y.mean() - z.mean(0) @ w
        out[reg] = w, b, float(((ye - ze @ w - b) ** 2).mean()), len(ye)
    return stats, out


def test_walk_forward_against_plain_fits(spark, panel):
    calendar = trading_calendar(spark.createDataFrame([(d,) for d in DAYS], "date date"))
    regs = (0.0, 0.5, 50.0)
    models, errors = walk_forward.train_walk_forward(
        panel, calendar, [DAYS[7], DAYS[10], DAYS[1]], ["a", "b", "c"], ["y"], "p", regs=regs, universe="member", n_train=4, n_eval=2, n_lag=1
    )
    models, errors = models.collect(), errors.collect()
    assert {r["milestone"] for r in models} == {DAYS[7], DAYS[10]}  # the third has no full evaluation window
    for at in (7, 10):
        ev = at + 1 - 3
        stats, want = reference(panel, DAYS[max(0, ev - 4)], DAYS[ev - 1], regs, DAYS[ev], DAYS[ev + 1])
        for e in (e for e in errors if e["milestone"] == DAYS[at]):
            assert close(e["mse"], want[e["reg"]][2]) and e["n_eval"] == want[e["reg"]][3]
            assert e["chosen"] == (e["reg"] == min(regs, key=lambda g: want[g][2]))
        best = min(regs, key=lambda g: want[g][2])
        got = {m["feature"]: m for m in models if m["milestone"] == DAYS[at]}
        assert close(got["(intercept)"]["weight"], want[best][1])
        for i, c in enumerate("abc"):
            assert math.isclose(got[c]["weight"], want[best][0][i], rel_tol=1e-6, abs_tol=1e-9)
            assert close(got[c]["mean"], stats[c][0]) and math.isclose(got[c]["std"], stats[c][1], abs_tol=1e-9)


def test_a_label_without_training_rows_has_no_model(spark, panel):
    calendar = trading_calendar(spark.createDataFrame([(d,) for d in DAYS], "date date"))
    blank = panel.selectExpr("date", "symbol", "a", "CAST(NULL AS DOUBLE) AS y", "b AS z")
    models, errors = walk_forward.train_walk_forward(blank, calendar, [DAYS[9]], ["a"], ["y", "z"], "p", n_train=4, n_eval=2, n_lag=1)
    assert {r["y"] for r in models.collect()} == {"z"} and {r["y"] for r in errors.collect()} == {"z"}
    none = walk_forward.train_walk_forward(blank, calendar, [DAYS[0]], ["a"], ["z"], "p", n_train=4, n_eval=2, n_lag=1)
    assert none[0].count() == 0 and none[1].count() == 0


def test_models_within_dates_score_as_they_were_trained(spark, panel):
    calendar = trading_calendar(spark.createDataFrame([(d,) for d in DAYS], "date date"))
    models, _ = walk_forward.train_walk_forward(
        panel, calendar, [DAYS[9]], ["a", "b", "c"], ["y"], "p", normaliser="cs_zscore", n_train=4, n_eval=2, n_lag=1
    )
    weight = {m["feature"]: m["weight"] for m in models.collect()}
    assert {m["normaliser"] for m in models.collect()} == {"cs_zscore"}
    z = scaling.CrossSectionalZScore(["a", "b", "c"]).transform(panel.where("date = '2024-01-12'")).collect()
    want = {r["symbol"]: weight["(intercept)"] + sum(weight[c] * (r[c] or 0.0) for c in "abc") for r in z}
    got = scoring.score_linear(panel, models, ["a", "b", "c"], ["y"]).where("date = '2024-01-12'").collect()
    assert len(got) == 30 and all(close(r["y"], want[r["symbol"]]) for r in got)


def test_rows_outside_of_the_dates_fail(spark):
    rows = spark.createDataFrame([(DAYS[1], "s", 1.0), (DAYS[4], "s", 1.0), (DAYS[8], "s", 1.0)], "date date, symbol string, a double")
    models = spark.createDataFrame(
        [("p", DAYS[i], "y", "(intercept)", w, None, None) for i, w in ((0, 2.0), (3, 5.0), (7, 9.0))], scoring_schema()
    )
    one = spark.createDataFrame([(DAYS[4],)], "date date")
    with pytest.raises(Exception, match="outside of the dates"):
        scoring.score_linear(rows, models, ["a"], ["y"], dates=one).collect()
    got = scoring.score_linear(rows, models, ["a"], ["y"], date_range=(DAYS[0], DAYS[8])).collect()
    assert sorted(r["y"] for r in got) == [2.0, 5.0, 9.0]
    assert [r["y"] for r in scoring.score_linear(rows.where(f"date = '{DAYS[4]}'"), models, ["a"], ["y"], dates=one).collect()] == [5.0]


def scoring_schema():
    from barloom.plans.training import MODEL_SCHEMA

    return MODEL_SCHEMA
