"""Forecast accuracy from one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def metric_columns(label: str = "label", prediction: str = "prediction") -> list[Column]:
    """rmse, r2, mae and mape (percent, over labels that are not zero), of rows that have both."""
    both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    y = F.when(both, F.col(label))
    e = y - F.col(prediction)
    mse = F.avg(e * e)
    return [
        F.sqrt(mse).alias("rmse"),
        (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"),
        F.avg(F.abs(e)).alias("mae"),
        (100 * F.avg(F.when(y != 0, F.abs(e / F.when(y != 0, y))))).alias("mape"),
    ]


def evaluate(rows: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by).agg(*metric_columns(label, prediction)) if by else rows.agg(*metric_columns(label, prediction))


def evaluate_each(rows: DataFrame, predictions: Sequence[str], label: str = "label", by: Sequence[str] = (), model: str = "model") -> DataFrame:
    """Metrics of several prediction columns: one pass, (by, model, rmse, r2, mae, mape)."""
    long = rows.select(*by, label, *predictions).unpivot([*by, label], list(predictions), model, "prediction")
    return evaluate(long, label, "prediction", [*by, model])


def long_metrics(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, metric, value) of a metrics table."""
    return table.unpivot(list(by), ["rmse", "r2", "mae", "mape"], "metric", "value")


def best_stop(scores: DataFrame, patience: int = 3, min_delta: float = 0.0, larger_is_better: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """When training would stop over ``scores(iteration, score)``, and the best iteration until then.

    A score improves if it beats the best so far by more than ``min_delta``; training stops after ``patience`` scores
    in a row that don't.
    """
    s = F.col("score") * (-1 if larger_is_better else 1)
    along = Window.partitionBy(*by).orderBy("iteration")
    before = F.min("s").over(along.rowsBetween(Window.unboundedPreceding, -1))
    rows = scores.withColumn("s", s).withColumn("improved", before.isNull() | (F.col("s") < before - min_delta))
    rows = rows.withColumn("row", F.row_number().over(along))
    rows = rows.withColumn("since", F.col("row") - F.last(F.when(F.col("improved"), F.col("row")), True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy(*by)
    stopped = F.min(F.when(F.col("since") >= patience, F.col("iteration"))).over(whole)
    seen = rows.withColumn("stop_iteration", F.coalesce(stopped, F.max("iteration").over(whole))).where(F.col("iteration") <= F.col("stop_iteration"))
    best = [F.max("stop_iteration").alias("stop_iteration"), F.min_by("iteration", F.struct("s", "iteration")).alias("best_iteration"), F.min_by("score", F.struct("s", "iteration")).alias("best_score")]
    return seen.groupBy(*by).agg(*best) if by else seen.agg(*best)
