"""Smoothing of series in pieces against the fold of whole series, and exact splits against all splits there are."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from seriesmill import PanelSpec
from seriesmill.operators import ewma, stumps

SPEC = PanelSpec("series", "t", "x")


@pytest.fixture(scope="module")
def long_rows(spark):
    rng, rows = random.Random(3), []
    for series, n in (("a", 3_000), ("b", 1), ("c", 700), (None, 40), ("none", 30), ("late", 500)):
        for t in range(n):
            null = series == "none" or (series == "late" and t < 300) or rng.random() < 0.1
            rows.append((series, t, None if null else rng.gauss(0, 10)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "series string, t long, x double").repartition(3)


@pytest.mark.parametrize("work", [ewma.ewma, ewma.ewm_volatility, ewma.ewma_crossover, ewma.adaptive_ewma])
def test_pieces_are_the_fold(spark, long_rows, monkeypatch, work):
    monkeypatch.setattr(ewma, "PIECE_BITS", 7)
    whole, cut = work(long_rows, SPEC), work(long_rows, SPEC, long_series=True)
    assert sorted(whole.columns) == sorted(cut.columns)
    key = lambda r: (r["series"] or "", r["t"])
    one, two = (sorted(df.select(*sorted(whole.columns)).collect(), key=key) for df in (whole, cut))
    assert len(one) == len(two)
    for a, b in zip(one, two):
        assert [v is None for v in a] == [v is None for v in b]
        assert [v for v in a if isinstance(v, (int, float))] == pytest.approx([v for v in b if isinstance(v, (int, float))], rel=1e-9, abs=1e-9)


def test_no_array_holds_a_long_series(spark, monkeypatch):
    monkeypatch.setattr(ewma, "PIECE_BITS", 6)
    df = spark.range(20_000).select(F.lit("one").alias("series"), F.col("id").alias("t"), F.sin("id").alias("x"))
    out = ewma.ewma(df, SPEC, (0.3,), long_series=True)
    state, want = None, {}
    for r in df.orderBy("t").collect():
        state = r.x if state is None else 0.3 * r.x + 0.7 * state
        want[r.t] = state
    got = {r.t: r.ewma_30 for r in out.collect()}
    assert got == pytest.approx(want)
    longest = []
    real = F.collect_list
    monkeypatch.setattr(F, "collect_list", lambda c: longest.append(c) or real(c))
    ewma.ewma(df, SPEC, (0.3,), long_series=True)
    assert len(longest) == 3  # pieces for their maps, maps along a series, pieces with their rows


def every_split(rows, feature, label):
    pairs = sorted((r[feature], r[label]) for r in rows if r[feature] is not None and r[label] is not None)
    error = lambda ys: sum((y - sum(ys) / len(ys)) ** 2 for y in ys)
    whole, best = error([y for _, y in pairs]), None
    for lo, hi in zip(sorted({v for v, _ in pairs}), sorted({v for v, _ in pairs})[1:]):
        cut = (lo + hi) / 2
        left, right = [y for v, y in pairs if v <= cut], [y for v, y in pairs if v > cut]
        gain = whole - error(left) - error(right)
        if best is None or gain > best[0] + 1e-9:
            best = (gain, cut, sum(left) / len(left), sum(right) / len(right), gain / whole)
    return best


@pytest.mark.parametrize("seed", range(3))
def test_best_splits(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        a = rng.choice([0.0, 0.0, rng.gauss(0, 1)])
        rows.append((a, rng.randrange(4), None if rng.random() < 0.3 else rng.random(), 7, None if rng.random() < 0.1 else 1e6 + (a > 0.3) * 5 + rng.gauss(0, 1)))
    df = spark.createDataFrame(rows, "a double, b int, c double, same int, y double").repartition(5)
    found = {r.feature: r for r in stumps.best_splits(df, ["a", "b", "c", "same"], "y").collect()}
    assert set(found) == {"a", "b", "c"}
    for f in found:
        gain, cut, left, right, share = every_split(df.collect(), f, "y")
        assert tuple(found[f])[1:] == pytest.approx((cut, left, right, sum(r[f] is not None and r.y is not None for r in df.collect()), gain, share), rel=1e-5)
    assert stumps.best_splits(df.limit(0), ["a"], "y").collect() == []
