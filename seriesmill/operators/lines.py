"""Linear models by normal equations that add up along dates: every fold and every refit from one pass over the panel.

A date leaves one row: how many rows it has, the means of features and label, and their covariances, which Spark's aggregates
add up without cancellation. Sums about a common centre run up along these rows, so a range of dates is a difference of two of
them, and a model of it is a small system of equations. Rows are read once for all models and once for all predictions, however many
folds or refits there are. Other kinds of models go through ``splits.cross_validate`` and ``splits.walk_forward_fit``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored
from ..spec import PanelSpec
from .metrics import evaluate, long_metrics
from .splits import fold_metrics, folds, walk_forward


def moments(panel: DataFrame, features: Sequence[str], label: str, by: Sequence[str]) -> DataFrame:
    """Per ``by``: n, means m_i and covariances c_i_j of features and label, over rows that have all of them; n is 0 where none has."""
    names = [*features, label]
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in names))
    v = [F.when(whole, F.col(c).cast("double")) for c in names]
    pairs = [(i, j) for i in range(len(v)) for j in range(i, len(v))]
    known = lambda c, name: F.coalesce(c, F.lit(0.0)).alias(name)
    return panel.groupBy(*by).agg(F.count_if(whole).alias("n"), *[known(F.avg(x), f"m_{i}") for i, x in enumerate(v)], *[known(F.covar_pop(v[i], v[j]), f"c_{i}_{j}") for i, j in pairs])


def centred_sums(table: DataFrame, size: int) -> DataFrame:
    """``table`` of ``moments`` with centre, the means of all rows, and sums: n, sums and products of the columns less their centre, as one array."""
    n = F.col("n")
    centre = table.agg(F.array(*[F.coalesce(F.try_divide(F.sum(n * F.col(f"m_{i}")), F.sum(n)), F.lit(0.0)) for i in range(size)]).alias("centre"))
    off = [F.col(f"m_{i}") - F.col("centre")[i] for i in range(size)]
    products = [n * (F.col(f"c_{i}_{j}") + off[i] * off[j]) for i in range(size) for j in range(i, size)]
    return table.crossJoin(F.broadcast(centre)).withColumn("sums", F.array(n.cast("double"), *[n * x for x in off], *products))


def along_dates(table: DataFrame, size: int, spec: PanelSpec) -> DataFrame:
    """(date, centre, upto, before): centred sums up to and including each date, and before it. As many rows as there are dates."""
    rows, width = centred_sums(table, size), 1 + size + size * (size + 1) // 2
    up_to = Window.orderBy(spec.date).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.array(*[F.sum(F.col("sums")[k]).over(up_to) for k in range(width)]))
    return rows.select(spec.d.alias("date"), "centre", "upto", F.zip_with("upto", "sums", lambda a, b: a - b).alias("before"))


def solved(sums: np.ndarray, centre: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and coefficients of the least-squares line; of columns that don't vary, or depend on others, the smallest ones."""
    size = len(centre)
    n, first = sums[0], sums[1 : 1 + size] / max(sums[0], 1.0)
    second = np.zeros((size, size))
    second[np.triu_indices(size)] = sums[1 + size :]
    second = (second + np.triu(second, 1).T) / max(n, 1.0) - np.outer(first, first)
    scale = np.sqrt(np.maximum(second.diagonal(), 0.0))
    safe = np.where(scale > 1e-12 * (np.abs(centre) + 1e-300), scale, np.inf)[:-1]
    inner = second[:-1, :-1] / np.outer(safe, safe)
    coefficients = np.linalg.pinv(inner, rcond=1e-12, hermitian=True) @ (second[:-1, -1] / safe) / safe
    means = centre + first
    return means[-1] - coefficients @ means[:-1], coefficients


def fitted(ranges: DataFrame) -> DataFrame:
    """``ranges`` with sums and centre replaced by n_train, intercept and coefficients; rows without training rows have none."""
    kept = ranges.drop("sums", "centre")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema) + ", n_train long, intercept double, coefficients array<double>"

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            models = [solved(np.array(s, dtype=float), np.array(c, dtype=float)) for s, c in zip(df["sums"], df["centre"])]
            n = [int(round(s[0])) for s in df["sums"]]
            yield df.drop(columns=["sums", "centre"]).assign(n_train=n, intercept=[m[0] if k else None for m, k in zip(models, n)], coefficients=[m[1].tolist() if k else None for m, k in zip(models, n)])

    return ranges.mapInPandas(work, schema)


def fit_ranges(bounds: DataFrame, dates: DataFrame, start: str | None, end: str) -> DataFrame:
    """A model for each row of ``bounds``, of the dates from ``start`` (by default all before) to ``end``."""
    last = dates.select(F.col("date").alias(end), "centre", F.col("upto").alias("_upto"))
    out = bounds.join(last, end)
    if start is None:
        return fitted(out.withColumnRenamed("_upto", "sums"))
    first = dates.select(F.col("date").alias(start), F.col("before").alias("_before"))
    out = out.join(first, start).withColumn("sums", F.zip_with("_upto", "_before", lambda a, b: a - b))
    return fitted(out.drop("_upto", "_before"))


def predicted(features: Sequence[str]) -> Column:
    """What a row's model says of its features; null where either is missing."""
    return reduce(lambda a, b: a + b, [F.col("coefficients")[i] * F.col(f).cast("double") for i, f in enumerate(features)], F.col("intercept"))


def line_folds(panel: DataFrame, features: Sequence[str], label: str, spec: PanelSpec = PanelSpec(), **parameters) -> DataFrame:
    """(fold, rmse, r2, mae, mape) of a line fitted and tested on each fold in time; ``parameters`` are those of ``splits.folds``."""
    table = stored(moments(panel, features, label, [spec.date]), "date-moments")
    bounds = folds(table, spec, **parameters)
    models = fit_ranges(bounds, along_dates(table, len(features) + 1, spec), "train_from", "train_to")
    # A row for each fold and date of its test.
    days = table.select(spec.d.alias("_day"))
    models = models.join(days, F.col("_day").between(F.col("test_from"), F.col("test_to"))).select("fold", F.col("_day").alias(spec.date), "intercept", "coefficients")
    rows = panel.select(spec.date, F.col(label).alias("label"), *[f for f in features if f != spec.date]).join(models, spec.date)
    return evaluate(rows.withColumn("prediction", predicted(features)), by=["fold"])


def cross_validate_line(panel: DataFrame, features: Sequence[str], label: str, spec: PanelSpec = PanelSpec(), **parameters) -> DataFrame:
    """(metric, mean, std) over the folds of ``line_folds``."""
    return fold_metrics(long_metrics(line_folds(panel, features, label, spec, **parameters), ["fold"]))


def walk_forward_line(panel: DataFrame, features: Sequence[str], label: str, spec: PanelSpec = PanelSpec(), initial: int = 24, refit_every: int = 1, horizon: int = 1) -> DataFrame:
    """(step, the panel's columns, prediction) for the rows of each step's test date, by the line of its last refit."""
    table = stored(moments(panel, features, label, [spec.date]), "date-moments")
    steps = walk_forward(table, spec, initial, refit_every, horizon).select("step", F.col("test_date").alias(spec.date), "refit_to")
    models = fit_ranges(steps.select("refit_to").distinct(), along_dates(table, len(features) + 1, spec), None, "refit_to")
    models = steps.join(models, "refit_to").select("step", spec.date, "intercept", "coefficients")
    return panel.join(models, spec.date).withColumn("prediction", predicted(features)).select("step", *panel.columns, "prediction")


def lines_by(panel: DataFrame, features: Sequence[str], label: str, by: Sequence[str]) -> DataFrame:
    """(by, n_train, intercept, coefficients): a line for each group, all from one pass."""
    table = moments(panel, features, label, by)
    size = len(features) + 1
    n = F.col("n").cast("double")
    sums = F.array(n, *[F.lit(0.0)] * size, *[n * F.col(f"c_{i}_{j}") for i in range(size) for j in range(i, size)])
    return fitted(table.select(*by, sums.alias("sums"), F.array(*[F.col(f"m_{i}") for i in range(size)]).alias("centre")))
