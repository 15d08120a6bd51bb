"""Ensembles of prediction columns. Base models write columns of their own, so nothing is joined back by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_large
from ..sources.tables import remove, stored
from ..spec import PanelSpec
from .metrics import evaluate_each
from .models import WEIGHT, in_counts, packs_of, small_tasks, takes_weights
from .splits import folds


def simple_average(columns: Sequence[str]) -> Column:
    """The mean of the columns; null if any is null."""
    return reduce(lambda a, b: a + b, map(F.col, columns)) / len(columns)


def weighted_average(columns: Sequence[str], weights: dict[str, float] | None = None) -> Column:
    """Weights are scaled to 1; without any, all columns weigh the same."""
    weights = weights or dict.fromkeys(columns, 1.0)
    total = sum(weights.get(c, 0.0) for c in columns)
    return reduce(lambda a, b: a + b, [F.col(c) * (weights.get(c, 0.0) / total) for c in columns])


def row_median(columns: Sequence[str]) -> Column:
    """The lower median of the columns of a row, nulls left out."""
    known = F.array_sort(F.array_compact(F.array(*columns)))
    return F.try_element_at(known, F.ceil(F.size(known) / 2).cast("int"))


def join_predictions(frames: Sequence[DataFrame], names: Sequence[str], keys: Sequence[str] = ("product", "month_end")) -> DataFrame:
    """Predictions that come as tables of their own, side by side; joined on the whole key, so no row multiplies."""
    out = frames[0].select(*keys, F.col("prediction").alias(names[0]))
    for df, name in zip(frames[1:], names[1:]):
        out = out.join(as_large(df.select(*keys, F.col("prediction").alias(name))), list(keys), "left")
    return out


def weight_table(validation: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """(model, rmse, weight): inverse rmse scaled to 1; a model without error counts as rmse 1."""
    scores = evaluate_each(validation, columns, label).select("model", "rmse")
    raw = F.when(F.col("rmse") == 0, 1.0).otherwise(F.try_divide(F.lit(1.0), F.col("rmse")))
    return scores.withColumn("raw", raw).select("model", "rmse", (F.col("raw") / F.sum("raw").over(Window.partitionBy())).alias("weight"))


def apply_weights(rows: DataFrame, weights: DataFrame, columns: Sequence[str], output: str = "prediction") -> DataFrame:
    """The weighted mean by a weight table; the table is one broadcast row."""
    row = weights.agg(*[F.max(F.when(F.col("model") == c, F.col("weight"))).alias(f"_w_{c}") for c in columns])
    mixed = reduce(lambda a, b: a + b, [F.col(c) * F.col(f"_w_{c}") for c in columns])
    return rows.crossJoin(F.broadcast(row)).withColumn(output, mixed).drop(*[f"_w_{c}" for c in columns])


def best_model(validation: DataFrame, columns: Sequence[str], category: str = "category", label: str = "label") -> DataFrame:
    """(category, model): the least validation rmse of each class, ties by name."""
    scores = evaluate_each(validation, columns, label, [category])
    first = Window.partitionBy(category).orderBy(F.asc_nulls_last("rmse"), "model")
    return scores.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").select(category, "model")


def best_by_category(rows: DataFrame, best: DataFrame, columns: Sequence[str], category: str = "category", output: str = "prediction") -> DataFrame:
    """Each row's prediction by the best model of its class; the average where the class is not known."""
    picked = reduce(lambda c, name: c.when(F.col("model") == name, F.col(name)), columns[1:], F.when(F.col("model") == columns[0], F.col(columns[0])))
    return rows.join(F.broadcast(best), category, "left").withColumn(output, picked.otherwise(simple_average(columns))).drop("model")


def compare_strategies(rows: DataFrame, validation: DataFrame, columns: Sequence[str], label: str = "label", category: str = "category") -> DataFrame:
    """(strategy, rmse, r2, mae, mape) of all strategies in one pass over ``rows``; weights and best models come from ``validation``."""
    out = rows.withColumns({"average": simple_average(columns), "median": row_median(columns)})
    out = apply_weights(out, weight_table(validation, columns, label), columns, "weighted")
    out = best_by_category(out, best_model(validation, columns, category, label), columns, category, "best")
    return evaluate_each(out, ["average", "weighted", "median", "best"], label, model="strategy")


def _lower(base: Sequence, features: Sequence[str], label: str) -> Pipeline:
    """Base models over the assembled features, each with a prediction column of its own."""
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return Pipeline(stages=[assemble, *[e.copy().setFeaturesCol("features").setLabelCol(label).setPredictionCol(f"base_{i}") for i, e in enumerate(base)]])


def _upper(n_base: int, features: Sequence[str], label: str, meta, use_features: bool) -> Pipeline:
    inputs = [f"base_{i}" for i in range(n_base)] + (list(features) if use_features else [])
    combine = VectorAssembler(inputCols=inputs, outputCol="base_features", handleInvalid="skip")
    return Pipeline(stages=[combine, (meta or LinearRegression()).copy().setFeaturesCol("base_features").setLabelCol(label).setPredictionCol("prediction")])


def _weighed(stages: Pipeline, rows: DataFrame) -> Pipeline:
    """The same stages, fitted with weights where ``rows`` are counted ones."""
    if WEIGHT not in rows.columns:
        return stages
    return Pipeline(stages=[e.copy().setWeightCol(WEIGHT) if e.hasParam("weightCol") else e for e in stages.getStages()])


def _counts(rows: DataFrame, base: Sequence, meta, columns: Sequence[str]) -> tuple[DataFrame, str] | None:
    """Large tables as distinct rows with their counts, where all models know weights."""
    return in_counts(rows, columns) if all(map(takes_weights, [*base, *([meta] if meta else [])])) else None


def fit_stack(rows: DataFrame, base: Sequence, features: Sequence[str], label: str = "label", meta=None, use_features: bool = False, validation: DataFrame | None = None) -> PipelineModel:
    """Base models, then a linear model of their predictions, fitted on ``validation`` (by default the same rows).

    The stages form one PipelineModel: each adds a column of its own. On the same rows a base model that overfits gets a large
    weight; ``fit_stack_in_time`` has none of it. Large tables are fitted as packs of equal rows with weights.
    """
    columns = [*features, label]
    counts = _counts(rows, base, meta, columns)
    known = small_tasks(packs_of(counts[0], columns)) if counts else rows
    lower = _weighed(_lower(base, features, label), known).fit(known)
    above = lower.transform(known if validation is None else validation)
    upper = _weighed(_upper(len(base), features, label, meta, use_features), above).fit(above)
    if counts:
        remove(rows.sparkSession, counts[1])
    return PipelineModel([*lower.stages, *upper.stages])


def out_of_fold(rows: DataFrame, base: Sequence, features: Sequence[str], label: str = "label", spec: PanelSpec = PanelSpec(), **parameters) -> DataFrame:
    """The rows that some fold in time tests, with fold and the predictions base_0, base_1, ... of models that were fitted before them.

    ``parameters`` are those of ``splits.folds``, a row of which is a fit; folds' results are written once. Counted rows are fitted with their weights.
    """
    out = None
    for f in folds(rows, spec, **parameters).orderBy("fold").collect():
        part = lambda lo, hi: rows.where(spec.d.between(F.lit(lo), F.lit(hi)))
        known = part(f.train_from, f.train_to)
        lower = _weighed(_lower(base, features, label), known).fit(known)
        tested = lower.transform(part(f.test_from, f.test_to)).select(F.lit(f.fold).alias("fold"), *rows.columns, *[f"base_{i}" for i in range(len(base))])
        out = tested if out is None else out.unionByName(tested)
    if out is None:
        raise ValueError("too few dates for a fold")
    return stored(out, "out-of-fold")


def fit_stack_in_time(rows: DataFrame, base: Sequence, features: Sequence[str], label: str = "label", meta=None, use_features: bool = False, spec: PanelSpec = PanelSpec(), **parameters) -> PipelineModel:
    """A stack whose top model has only seen predictions of rows later than those its base models were fitted on; the base models are then fitted on all rows."""
    columns = [spec.date, *features, label]
    counts = _counts(rows, base, meta, columns)
    known = small_tasks(packs_of(counts[0], columns)) if counts else rows
    tested = out_of_fold(known, base, features, label, spec, **parameters)
    above = small_tasks(tested) if counts else tested
    upper = _weighed(_upper(len(base), features, label, meta, use_features), above).fit(above)
    lower = _weighed(_lower(base, features, label), known).fit(known)
    if counts:
        remove(rows.sparkSession, counts[1])
    return PipelineModel([*lower.stages, *upper.stages])
