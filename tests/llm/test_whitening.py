"""Whitening against a library's eigensolver over the exact covariance, and the eigensolver's steps by themselves."""

from __future__ import annotations

import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from seriesmill.llm import whitening
from seriesmill.llm.queries import QUERIES
from seriesmill.llm.whitening import leading_components, whiten

from ..oracle import SF


def plain(rows: list[tuple], most: int = 32):
    """n, x-vectors with ids, the exact covariance and its eigenpairs, by one plain loop."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    xs = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in kept if len(v) == d]
    n, sums = len(xs), [sum(x[k] for _, x in xs) for k in range(d)]
    deviations = [[n * c - s for c, s in zip(x, sums)] for _, x in xs]
    v = np.array([[float(Fraction(sum(r[a] * r[b] for r in deviations), n**3)) for b in range(d)] for a in range(d)])
    values, vectors = np.linalg.eigh(v)
    return xs, deviations, v, values[::-1][:most], vectors[:, ::-1][:, :most]


def held_against_plain(found: list, rows: list[tuple], name: str = "vec_id", most: int = 32) -> None:
    xs, deviations, v, values, vectors = plain(rows, most)
    n, k = len(xs), int((values > whitening.SMALLEST * values[0]).sum())
    wanted = Counter((i, c, n, sum(x * x for x in d)) for (i, _), d in zip(xs, deviations) for c in range(1, k + 1))
    assert Counter((r[name], r["component"], r["n"], r["deviation"]) for r in found) == wanted
    explained = {r["component"]: r["explained"] for r in found}
    np.testing.assert_allclose([explained[c] for c in range(1, k + 1)], values[:k] / np.trace(v), rtol=1e-9, atol=1e-14)
    assert len({r["identity_error"] for r in found}) == 1 and 0 <= found[0]["identity_error"] < 1e-6
    z = np.array(deviations, dtype=float) / n @ (vectors[:, :k] / np.sqrt(values[:k]))
    ids = Counter(i for i, _ in xs)
    mine = {(r[name], r["component"]): r["whitened"] for r in found if ids[r[name]] == 1}
    gaps = np.abs(np.diff(values, append=0)) / values[0]
    for c in range(k):
        if min(gaps[c], gaps[c - 1] if c else 1) < 1e-6:
            continue  # components of equal eigenvalues are not unique
        pairs = [(mine[i, c + 1], z[r, c]) for r, (i, _) in enumerate(xs) if ids[i] == 1]
        a, b = np.array(pairs).T
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8 / min(gaps[c], gaps[c - 1] if c else 1, 1e-2)


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = QUERIES["op12_whitening"](spark, SF).collect()
    held_against_plain(found, rows)
    assert {r["component"] for r in found} == set(range(1, 33))
    z = np.array([r["whitened"] for r in sorted(found, key=lambda r: (r["vec_id"], r["component"]))]).reshape(-1, 32)
    centred = z - z.mean(axis=0)
    assert abs(np.abs(centred.T @ centred / len(z) - np.eye(32)).max() - found[0]["identity_error"]) < 1e-9


def matrices():
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 8, 40):
        b = rng.standard_normal((n, n))
        yield b @ b.T
    yield np.zeros((5, 5))
    yield np.eye(40)
    yield np.diag(np.r_[np.ones(20), 2 * np.ones(20)])
    q = np.linalg.qr(rng.standard_normal((50, 50)))[0]
    yield q @ np.diag(np.r_[5 * np.ones(10), 1 + 1e-9 * np.arange(30), np.zeros(10)]) @ q.T
    yield (b * 10.0 ** -np.arange(40.0)) @ b.T
    yield np.diag(np.abs(np.arange(-10.0, 11))) + np.eye(21, k=1) + np.eye(21, k=-1)
    yield 1e-200 * (b @ b.T)


@pytest.mark.parametrize("a", list(matrices()))
def test_components(a):
    values, z = leading_components(a, 32)
    scale = np.abs(a).max() or 1
    np.testing.assert_allclose(values / scale, np.linalg.eigvalsh(a / scale)[::-1][:32], atol=1e-13 * len(a))
    assert np.abs(a @ z - z * values).max() < 1e-13 * len(a) * scale
    assert np.abs(z.T @ z - np.eye(z.shape[1])).max() < 1e-13


def test_tridiagonal_and_counts():
    b = np.random.default_rng(3).standard_normal((12, 12))
    a = b + b.T
    diagonal, off, _ = whitening.tridiagonal(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    np.testing.assert_allclose(np.linalg.eigvalsh(t), np.linalg.eigvalsh(a), atol=1e-12)
    at = np.linspace(-10, 10, 101)
    assert whitening.below(diagonal, off * off, at, 1e-30).tolist() == [(np.linalg.eigvalsh(a) < x).sum() for x in at]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [nan] * 5), (104, [1.0, 2.0, inf, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [nan] * 9), (None, [0.5] * 5), (7, [1e4, -1e4, 0.0, 0.0, 0.0])]
    many = rows + odd + [(200, [0.25] * 5)] * 30
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in many], "vec_id long, embedding array<float>, component int, whitened string").repartition(3)
    found = whiten(df).collect()
    single = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in many]
    held_against_plain(found, single)
    assert {r["vec_id"] for r in found} & {100, 101, 102, 103, 104, 105, 106} == set() and sum(r["vec_id"] is None for r in found) == 5


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]])
def test_nothing_to_scale(spark, rows):
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and found.collect() == []


def test_constant_dimension_and_large_values(spark):
    rows = [(i, [1e9 + i, 5.0, -1e13 * (i % 3), float(i * i % 7)]) for i in range(20)]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("component = 1")
    with pytest.raises(Exception, match="too large"):
        found.collect()  # a deviation here has more digits than a long
    rows = [(i, [1e5 + i, 5.0, -3e5 * (i % 3), float(i * i % 7)]) for i in range(20)]
    held_against_plain(whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), rows)


def test_exact_products():
    y = np.array([[2**40, 3], [-(2**41), 2**30 + 1]])
    assert whitening.exact(y, y).tolist() == (y.astype(object).T @ y.astype(object)).tolist()
