"""Whitening of embeddings: components of their covariance, found without a library's eigensolver, and every row's projections.

Entries c become whole numbers x = floor(64 c) + 1,000,000. Three passes over the table, each leaving one small set of sums per task
that Spark adds up by cell: sums S of each dimension; products of the entries centred at the whole number next to their mean, which
are exact, as is the remaining shift, so that the covariance is the exact one rounded once, in any order of tasks; and the products
of the whitened rows, whose covariance's distance from the identity is reported. A dimension's or cell's sum is all that reaches the
driver, never rows.

There the covariance is tridiagonalised by Householder reflections; the leading eigenvalues are bisected by Sturm counts, all at
once; inverse iteration gives the tridiagonal matrix's eigenvectors, those of close eigenvalues being orthogonalised against each
other; the reflections carry them back. Components and eigenvalues then go to the tasks with the code, (components x dimensions)
numbers. Of either sign the one is taken whose largest entry is positive.

Rows whose vector is null or holds a null or non-finite entry have no result. The dimension is that of the longest other vector; a
shorter vector lacks entries, which count as null. Ids may be null or repeat: every row counts. Equal eigenvalues have any
orthonormal components of their space. Components whose eigenvalue is below SMALLEST of the largest have no scale and are left out,
so equal rows, or a single one, have none. A table without vectors gives no rows. Only the two columns named are read, so others may
have any name. Values that don't fit a long are an error. There are no texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues below this share of the largest are rounding.
SMALLEST = 2.0**-36
#: Whole numbers below it are exact as doubles.
EXACT = 2**53


# Tridiagonal eigenproblem


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and off-diagonal of a matrix similar to the symmetric ``a``, and the unit vectors of the reflections that led there."""
    a, mirrors = a.copy(), []
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        length = math.hypot(*v)
        if length:
            v[0] += math.copysign(length, v[0])
            v /= math.hypot(*v)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1, k] = -math.copysign(length, a[k + 1, k])
        mirrors.append(v)
    return a.diagonal().copy(), a.diagonal(-1).copy(), mirrors


def below(diagonal: np.ndarray, squares: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """How many eigenvalues lie below each of ``at``: the negative terms of the Sturm sequence. ``squares``: of the off-diagonal."""
    q = diagonal[0] - at
    found = (q < 0).astype(np.int64)
    for d, s in zip(diagonal[1:], squares):
        q = np.where(np.abs(q) < least, -least, q)
        q = d - at - s / q
        found += q < 0
    return found


def leading_values(diagonal: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The largest ``most`` eigenvalues, falling, by bisection of all their brackets at once."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    span = max(abs(diagonal - reach).max(), abs(diagonal + reach).max(), np.finfo(float).tiny)
    least = span * 2.0**-100
    lo, hi = np.full(most, (diagonal - reach).min() - span * 2.0**-50), np.full(most, (diagonal + reach).max() + span * 2.0**-50)
    rank = n - 1 - np.arange(most)  # counted from the least
    while True:
        middle = lo + (hi - lo) / 2
        if ((middle <= lo) | (middle >= hi) | (hi - lo <= span * 2.0**-60)).all():
            return middle
        over = below(diagonal, off * off, middle, least) > rank
        lo, hi = np.where(over, lo, middle), np.where(over, middle, hi)


def solve(diagonal: np.ndarray, off: np.ndarray, value: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - value) x = b by elimination with row exchanges; pivots below ``least`` are raised to it."""
    n = len(diagonal)
    main, upper, second, x = (diagonal - value).tolist(), [*off.tolist(), 0.0], [0.0] * n, b.tolist()
    for i, lower in enumerate(off.tolist()):
        if abs(main[i]) < abs(lower):
            factor = main[i] / lower
            main[i], main[i + 1], old = lower, upper[i] - factor * main[i + 1], main[i + 1]
            upper[i], second[i], upper[i + 1] = old, upper[i + 1], -factor * upper[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            pivot = main[i] if abs(main[i]) > least else least
            main[i], factor = pivot, lower / pivot
            main[i + 1] -= factor * upper[i]
            x[i + 1] -= factor * x[i]
    if abs(main[-1]) < least:
        main[-1] = least
    for i in range(n - 1, -1, -1):
        x[i] = (x[i] - (upper[i] * x[i + 1] if i + 1 < n else 0.0) - (second[i] * x[i + 2] if i + 2 < n else 0.0)) / main[i]
    return np.array(x)


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit eigenvector in each column. Values closer than a thousandth of the matrix's norm are a cluster: its vectors are kept orthogonal."""
    n, norm = len(diagonal), max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    least, out, first, last = norm * 2.0**-53, np.empty((n, len(values))), 0, math.inf
    for k, value in enumerate(values.tolist()):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        # Equal values would iterate towards the same vector.
        last = value = min(value, last - 8 * least) if k > first else value
        x = np.random.RandomState(k).standard_normal(n)
        for _ in range(5):
            for _ in range(2):
                x -= out[:, first:k] @ (out[:, first:k].T @ x)
            x = solve(diagonal, off, value, x / np.linalg.norm(x), least)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= out[:, first:k] @ (out[:, first:k].T @ x)
            x /= np.linalg.norm(x)
        out[:, k] = x
    return out


def leading_components(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of the symmetric ``a``, falling, and a unit eigenvector in each column, its largest entry positive."""
    scale = np.abs(a).max(initial=0.0)
    if not scale:
        return np.zeros(min(most, len(a))), np.eye(len(a))[:, :most]
    diagonal, off, mirrors = tridiagonal(a / scale)
    values = leading_values(diagonal, off, min(most, len(a)))
    z = vectors_of(diagonal, off, values)
    for k in range(len(mirrors) - 1, -1, -1):
        z[k + 1 :] -= 2 * np.outer(mirrors[k], mirrors[k] @ z[k + 1 :])
    largest = z[np.abs(z).argmax(axis=0), np.arange(z.shape[1])]
    return values * scale, z * np.where(largest < 0, -1.0, 1.0)


# Passes over the table


def lengths_kept(batch: pa.RecordBatch) -> np.ndarray:
    """The length of each row's vector, and -1 where it is null or holds what is no finite number."""
    v = batch.column(1)
    lengths = v.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(v.flatten().to_numpy(zero_copy_only=False)))])
    ends = np.cumsum(np.maximum(lengths, 0))
    return np.where(bad[ends] == bad[ends - np.maximum(lengths, 0)], lengths, -1)


def whole_numbers(batch: pa.RecordBatch, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``batch`` with a vector of ``d`` finite entries, and those entries as whole numbers."""
    lengths, flat = lengths_kept(batch), batch.column(1).flatten().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == d)
    starts = np.cumsum(np.maximum(batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0))[rows] - d
    c = np.floor(SCALE * flat[starts[:, None] + np.arange(d)])
    if len(c) and np.abs(c).max() >= 2.0**62:
        raise OverflowError("an entry does not fit a long")
    return rows, c.astype(np.int64) + SHIFT


def most_of(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a'b of whole numbers, exactly: as doubles where all sums fit them."""
    if len(a) * most_of(a) * most_of(b) < EXACT:
        return (a.astype(np.float64).T @ b.astype(np.float64)).astype(np.int64).astype(object)
    return a.astype(object).T @ b.astype(object)


def cells(sums: np.ndarray, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The upper half of a matrix of sums as rows i, j, v."""
    i, j = np.triu_indices(len(sums))
    v = sums[i, j].tolist()
    for at in range(0, len(v), 65_536):
        part = slice(at, at + 65_536)
        yield pa.RecordBatch.from_arrays([pa.array(i[part], pa.int32()), pa.array(j[part], pa.int32()), pa.array([Decimal(x) for x in v[part]] if pa.types.is_decimal(kind) else v[part], kind)], names=["i", "j", "v"])


WHOLE = pa.decimal128(38, 0)


def added(rows: DataFrame, work, kind: str) -> list:
    """The sums of all tasks' cells: as many rows as there are cells, and each task sends one row for each."""
    return rows.mapInArrow(work, f"i int, j int, v {kind}").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()


def longest(rows: DataFrame) -> int:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max((int(lengths_kept(b).max(initial=-1)) for b in batches), default=-1)
        yield pa.RecordBatch.from_arrays([pa.array([most], pa.int32())], names=["d"])

    return rows.mapInArrow(work, "d int").agg(F.max("d")).first()[0] or 0


def sums_of(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows with a vector, and the sum of each dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, dtype=object)
        for b in batches:
            x = whole_numbers(b, d)[1]
            n, total = n + len(x), total + exact(np.ones((len(x), 1), dtype=np.int64), x)[0] if len(x) else total
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d), pa.int32()), pa.array(np.zeros(d + 1), pa.int32()), pa.array([Decimal(v) for v in [n, *total]], WHOLE)], names=["i", "j", "v"])

    found = {r["i"]: int(r["v"]) for r in added(rows, work, "decimal(38,0)")}
    return found.get(-1, 0), [found.get(k, 0) for k in range(d)]


def covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance, divisor n: entries are centred at the whole number next to their mean, then multiplied."""
    d = len(sums)
    near = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            y = whole_numbers(b, d)[1] - near
            total = total + exact(y, y) if len(y) else total
        if not isinstance(total, int):
            yield from cells(total, WHOLE)

    left = [s - n * m for s, m in zip(sums, near.tolist())]  # at most n / 2
    out = np.zeros((d, d))
    for r in added(rows, work, "decimal(38,0)"):
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = (n * int(r["v"]) - left[r["i"]] * left[r["j"]]) / (n * n)
    return out


@dataclass(frozen=True)
class Whitener:
    """n rows of these sums; a component in each column; their eigenvalues and shares of the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, as Python's numbers where a long is too short."""
        if most_of(x) * self.n + most_of(self.sums) < 2**63:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums

    def projected(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(np.float64) @ (self.components / np.sqrt(self.values))


def fit(rows: DataFrame, most: int = 32) -> Whitener | None:
    """The whitener of ``rows(id, v)``; None without vectors, or where all are equal."""
    d = longest(rows)
    n, sums = sums_of(rows, d) if d > 0 else (0, [])
    if not n:
        return None
    v = covariance(rows, n, sums)
    values, components = leading_components(v, most)
    kept = values > SMALLEST * values[0] if values[0] > 0 else np.zeros(len(values), dtype=bool)
    return Whitener(n, np.array(sums, dtype=object), components[:, kept], values[kept], values[kept] / np.trace(v)) if kept.any() else None


def identity_error(rows: DataFrame, w: Whitener) -> float:
    """The largest entry, without sign, of the whitened rows' covariance less the identity. A column of ones carries their sums."""
    k = len(w.values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            x = whole_numbers(b, len(w.sums))[1]
            if len(x):
                z = np.column_stack([w.projected(w.deviations(x)), np.ones(len(x))])
                total += z.T @ z
        if total[k, k]:
            yield from cells(total, pa.float64())

    found = {(r["i"], r["j"]): r["v"] / w.n for r in added(rows, work, "double")}
    return max(abs(v - found[i, k] * found[j, k] - (i == j)) for (i, j), v in found.items() if j < k)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 32) -> DataFrame:
    """Per row with a vector and component: ``key``, component, n, deviation, whitened, explained and identity_error."""
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    schema = f"{key} {rows.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    w = fit(rows, most)
    if w is None:
        return df.sparkSession.createDataFrame([], schema)
    error, k = identity_error(rows, w), len(w.values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = whole_numbers(b, len(w.sums))
            if not len(x):
                continue
            deviations = w.deviations(x)
            wide = deviations if len(w.sums) * most_of(deviations) ** 2 < 2**63 else deviations.astype(object)
            squares = pa.array((wide * wide).sum(axis=1).tolist(), pa.int64())
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)),
                    squares.take(pa.array(np.repeat(np.arange(m), k))), pa.array(w.projected(deviations).ravel()), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error)),
                ],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(work, schema)
