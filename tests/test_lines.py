"""Normal equations that add up along dates, against fits by library on the same rows, fold by fold."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from seriesmill.operators import lines, metrics, models, splits


@pytest.fixture(scope="module")
def panel(spark):
    rng, rows = random.Random(7), []
    for p in range(12):
        for k in range(40):
            day = dt.date(2000 + k // 12, k % 12 + 1, 28)
            a, b = rng.gauss(1e6, 3), rng.choice([None, 0.0, rng.gauss(0, 1)]) if k > 5 else rng.gauss(0, 1)
            y = None if rng.random() < 0.1 else 2 * (a - 1e6) - 3 * (b or 0) + p + rng.gauss(0, 1)
            rows.append((f"p{p}", day, a, b, 5.0, y))
    return spark.createDataFrame(rows, "product string, month_end date, a double, b double, same double, y double").cache()


def expected(train, test, names):
    """rmse and mae by numpy's least squares."""
    x, y = (np.array([[r[c] for c in names] for r in rows]) for rows in (train, test))
    centre = x.mean(axis=0)
    beta = np.linalg.lstsq(np.c_[x - centre, np.ones(len(x))], np.array([r["y"] for r in train]), rcond=None)[0]
    e = np.array([r["y"] for r in test]) - np.c_[y - centre, np.ones(len(y))] @ beta
    return np.sqrt((e * e).mean()), np.abs(e).mean()


@pytest.mark.parametrize("sliding", [False, True])
def test_folds(panel, sliding):
    known = [r for r in panel.collect() if None not in (r.a, r.b, r.y)]
    parameters = dict(n_splits=4, min_train=12, test=3, gap=1, sliding=sliding)
    found = {r.fold: r for r in lines.line_folds(panel, ["a", "b", "same"], "y", **parameters).collect()}
    bounds = splits.folds(panel, **parameters).collect()
    assert len(found) == len(bounds) == 4
    for f in bounds:
        part = lambda lo, hi: [r for r in known if lo <= r.month_end <= hi]
        rmse, mae = expected(part(f.train_from, f.train_to), part(f.test_from, f.test_to), ["a", "b"])
        assert (found[f.fold].rmse, found[f.fold].mae) == pytest.approx((rmse, mae), rel=1e-7)


def test_same_as_callables(panel):
    parameters = dict(n_splits=3, min_train=12, test=3)
    rows = panel.na.drop()
    fit = lambda df: models.train(df, LinearRegression(labelCol="y", solver="normal"), ["b"])
    want = splits.cross_validate(rows, fit, lambda m, df: metrics.evaluate(m.transform(df), "y").first().asDict(), **parameters)
    got = lines.cross_validate_line(rows, ["b"], "y", **parameters)
    table = lambda df: {r.metric: pytest.approx((r["mean"], r["std"]), rel=1e-7) for r in df.collect()}
    assert table(want).keys() == table(got).keys() and {r.metric: (r["mean"], r["std"]) for r in got.collect()} == table(want)


def test_walk_forward(panel):
    rows = panel.na.drop()
    fit = lambda df: models.train(df, LinearRegression(labelCol="y", solver="normal"), ["b"])
    want = splits.walk_forward_fit(rows, fit, lambda m, df: m.transform(df), refit_every=5, horizon=2)
    got = lines.walk_forward_line(rows, ["b"], "y", refit_every=5, horizon=2)
    key = lambda df: {(r.step, r["product"], r.month_end): r.prediction for r in df.collect()}
    mine = key(got)
    assert mine and mine == pytest.approx(key(want), rel=1e-7)


def test_reads_do_not_grow_with_the_folds(panel, spark, tmp_path):
    panel.write.parquet(str(tmp_path / "panel"))
    stored = spark.read.parquet(str(tmp_path / "panel"))
    jobs = {}
    for n in (2, 9):
        text = lines.line_folds(stored, ["a"], "y", n_splits=n, min_train=12, test=3)._jdf.queryExecution().toString()
        jobs[n] = text.split("Physical Plan")[-1].count(f"{tmp_path}/panel")
    assert jobs[2] == jobs[9] == 1


def test_groups_and_groups_without_rows(panel):
    found = {r["product"]: r for r in lines.lines_by(panel.withColumn("y", F.when(F.col("product") != "p3", F.col("y"))), ["b"], "y", ["product"]).collect()}
    assert found["p3"].n_train == 0 and found["p3"].intercept is None
    rows = [r for r in panel.collect() if r["product"] == "p4" and None not in (r.b, r.y)]
    slope, intercept = np.polyfit([r.b for r in rows], [r.y for r in rows], 1)
    assert (found["p4"].intercept, found["p4"].coefficients[0]) == pytest.approx((intercept, slope))


def test_nothing(panel):
    assert lines.line_folds(panel.limit(0), ["a"], "y").collect() == []
    assert lines.walk_forward_line(panel.limit(0), ["a"], "y").collect() == []
