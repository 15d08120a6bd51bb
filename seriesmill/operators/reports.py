"""Tables behind importance reports, model selection and dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("rmse", "r2", "mae", "mape")


def top_features(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


def compare_importance(tables: DataFrame, models: Sequence[str]) -> DataFrame:
    """(feature, a column per model) of ``tables(feature, model, importance)``; a feature that a model lacks counts 0."""
    return tables.groupBy("feature").pivot("model", list(models)).agg(F.first("importance")).na.fill(0.0)


def select_features(importance: DataFrame, threshold: float = 0.01, most: int | None = None) -> DataFrame:
    """(feature, importance, rank): those at or over the threshold, at most ``most``."""
    ranked = importance.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")))
    kept = ranked.where(F.col("importance") >= threshold)
    return kept.where(F.col("rank") <= most) if most else kept


def selection_summary(importance: DataFrame, selected: DataFrame) -> DataFrame:
    """One row: features before and after, and the reduction in percent."""
    counts = importance.agg(F.count("*").alias("n_all")).crossJoin(selected.agg(F.count("*").alias("n_selected")))
    return counts.withColumn("reduction_percent", 100 * (1 - F.try_divide("n_selected", "n_all")))


def importance_summary(importance: DataFrame) -> DataFrame:
    i = F.col("importance")
    return importance.agg(F.count("*").alias("n_features"), F.avg(i).alias("mean"), F.stddev_pop(i).alias("std"), F.max(i).alias("max"))


def champions(metrics: DataFrame) -> DataFrame:
    """``metrics(category, model, rmse, ...)`` with rank and role: rank 1 is the champion, 2 the challenger."""
    order = Window.partitionBy("category").orderBy(F.asc_nulls_last("rmse"), "model")
    out = metrics.withColumn("rank", F.row_number().over(order))
    return out.withColumn("role", F.when(F.col("rank") == 1, "champion").when(F.col("rank") == 2, "challenger")).where("role is not null")


def tag_champions(predictions: DataFrame, metrics: DataFrame) -> DataFrame:
    """Predictions of champions and challengers, with is_champion."""
    roles = champions(metrics).select(F.col("category").alias("SalesPattern"), F.col("model").alias("Model"), (F.col("role") == "champion").alias("is_champion"))
    return predictions.join(F.broadcast(roles), ["SalesPattern", "Model"])


def top_runs(metrics: DataFrame, metric: str = "rmse", k: int = 5) -> DataFrame:
    """The k best runs by a metric: least error, or largest r2."""
    best = F.desc_nulls_last(metric) if metric == "r2" else F.asc_nulls_last(metric)
    return metrics.orderBy(best, *[c for c in ("category", "model") if c in metrics.columns]).limit(k)


def best_per_metric(metrics: DataFrame) -> DataFrame:
    """One row: the best model by rmse, mape and r2."""
    key = lambda m, sign: F.struct(sign * F.col(m), F.col("model"))
    return metrics.agg(*[F.min_by("model", key(m, s)).alias(f"best_{m}") for m, s in (("rmse", 1), ("mape", 1), ("r2", -1))])


def metric_table(long: DataFrame) -> DataFrame:
    """(model, rmse, r2, mae, mape) of ``long(model, metric, value)``."""
    return long.groupBy("model").pivot("metric", list(METRICS)).agg(F.first("value"))


def category_table(metrics: DataFrame, models: Sequence[str], metric: str = "rmse") -> DataFrame:
    """(category, a column per model) of one metric; 0 where there is none."""
    return metrics.groupBy("category").pivot("model", list(models)).agg(F.first(metric)).na.fill(0.0)


def residual_histogram(rows: DataFrame, width: float = 10.0, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(model, bin, n): residuals in bins of fixed width; bin b holds [b, b + 1) widths."""
    residual = F.col(label) - F.col(prediction)
    binned = rows.where(residual.isNotNull()).select("model", F.floor(residual / width).cast("long").alias("bin"))
    return binned.groupBy("model", "bin").agg(F.count("*").alias("n"))


def actual_and_predicted(rows: DataFrame, products: Sequence[str], columns: Sequence[str], label: str = "label", keys: Sequence[str] = ("product", "month_end")) -> DataFrame:
    """(keys, series, value) of some products: the actual values and each prediction, long."""
    few = rows.where(F.col(keys[0]).isin(list(products)))
    return few.select(*keys, F.col(label).alias("actual"), *columns).unpivot(list(keys), ["actual", *columns], "series", "value").where("value is not null")
