"""Splits in time: cuts, folds and walk-forward steps. Train always precedes test.

Folds are a small table of date bounds, made from the distinct dates; rows meet it in a broadcast range join, of keys and
dates only, so features are not multiplied by the folds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_large
from ..functions.quantiles import cuts
from ..spec import PanelSpec


def time_cut(panel: DataFrame, spec: PanelSpec = PanelSpec(), share: float = 0.8) -> DataFrame:
    """``panel`` with is_train: dates before the exact quantile of the rows' dates. Dates carry no time zone."""
    cut = cuts(panel, spec.date, (share,)).withColumnRenamed("q0", "cut_date")
    return panel.crossJoin(F.broadcast(cut)).withColumn("is_train", spec.d < F.col("cut_date"))


def holdout(panel: DataFrame, spec: PanelSpec = PanelSpec(), share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(earlier, last ``share``) by date; duplicates stay."""
    rows = time_cut(panel, spec, 1 - share)
    return rows.where("is_train").drop("is_train", "cut_date"), rows.where("not is_train").drop("is_train", "cut_date")


def periods(panel: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """(period, i, n): the distinct dates, numbered. As many rows as there are dates."""
    dates = panel.select(spec.d.alias("period")).where("period is not null").distinct()
    return dates.select("period", (F.row_number().over(Window.orderBy("period")) - 1).alias("i"), F.count("*").over(Window.partitionBy()).alias("n"))


def folds(panel: DataFrame, spec: PanelSpec = PanelSpec(), n_splits: int = 5, min_train: int = 12, test: int = 3, gap: int = 0, sliding: bool = False) -> DataFrame:
    """(fold, train_from, train_to, test_from, test_to), all ends included; fewer folds where dates run out, none where they are too few.

    ``gap`` periods lie between train and test. Sliding folds train on ``min_train`` periods each, expanding ones on all before.
    """
    dates = periods(panel, spec)
    step = F.greatest(F.lit(1), F.floor((F.col("n") - min_train - test) / n_splits))
    bounds = dates.agg(F.max("n").alias("n")).where(F.col("n") >= min_train + test)
    bounds = bounds.select("n", step.cast("int").alias("step"), F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold"))
    start = F.col("fold") * F.col("step") if sliding else F.lit(0)
    behind = min_train + F.col("fold") * F.col("step")
    bounds = bounds.select("fold", start.alias("a"), (behind - 1).alias("b"), (behind + gap).alias("c"), (behind + gap + test - 1).alias("d"), "n").where("d < n")
    index = F.broadcast(dates.agg(F.map_from_entries(F.collect_list(F.struct("i", "period"))).alias("date")))
    named = bounds.crossJoin(index)
    return named.select("fold", *[F.element_at("date", F.col(k).cast("int")).alias(n) for k, n in zip("abcd", ("train_from", "train_to", "test_from", "test_to"))])


def fold_rows(panel: DataFrame, table: DataFrame, spec: PanelSpec = PanelSpec(), keep: Sequence[str] = (), roles: Sequence[str] = ("train", "test")) -> DataFrame:
    """(product, date, fold, role) and the columns ``keep``: which rows train and test in which fold."""
    train = spec.d.between(F.col("train_from"), F.col("train_to"))
    test = spec.d.between(F.col("test_from"), F.col("test_to"))
    wanted = {("train",): train, ("test",): test}.get(tuple(roles), train | test)
    joined = panel.select(spec.product, spec.date, *keep).join(F.broadcast(table), wanted)
    return joined.select(spec.product, spec.date, "fold", F.when(train, "train").otherwise("test").alias("role"), *keep)


def fold_metrics(scores: DataFrame) -> DataFrame:
    """(metric, mean, std) over the folds of ``scores(fold, metric, value)``; std is 0 for one fold."""
    return scores.groupBy("metric").agg(F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"))


def cross_validate(panel: DataFrame, train: Callable[[DataFrame], object], evaluate: Callable[[object, DataFrame], dict[str, float]], spec: PanelSpec = PanelSpec(), **parameters) -> DataFrame:
    """Fit and evaluate on every fold; (metric, mean, std). The few fold bounds are read; fits themselves are Spark jobs."""
    found = []
    for f in folds(panel, spec, **parameters).orderBy("fold").collect():
        part = lambda lo, hi: panel.where(spec.d.between(F.lit(lo), F.lit(hi)))
        model = train(part(f.train_from, f.train_to))
        found += [(f.fold, k, float(v)) for k, v in evaluate(model, part(f.test_from, f.test_to)).items()]
    return fold_metrics(panel.sparkSession.createDataFrame(found, "fold int, metric string, value double"))


def walk_forward(panel: DataFrame, spec: PanelSpec = PanelSpec(), initial: int = 24, refit_every: int = 1, horizon: int = 1) -> DataFrame:
    """(step, test_date, train_to, refit_to): each step predicts the date ``horizon`` after what it may know, with the model of its last refit."""
    dates = periods(panel, spec)
    steps = dates.where(F.col("i") >= initial + horizon - 1).select((F.col("i") - initial - horizon + 1).cast("int").alias("step"), F.col("period").alias("test_date"))
    index = F.broadcast(dates.agg(F.map_from_entries(F.collect_list(F.struct("i", "period"))).alias("date")))
    known = initial - 1 + F.col("step")
    refit = initial - 1 + F.col("step") - F.pmod("step", F.lit(refit_every))
    return steps.crossJoin(index).select("step", "test_date", F.element_at("date", known.cast("int")).alias("train_to"), F.element_at("date", refit.cast("int")).alias("refit_to"))


def walk_forward_means(panel: DataFrame, steps: DataFrame, spec: PanelSpec = PanelSpec(), rows: int = 4) -> DataFrame:
    """Each step's actual value and the mean of the last ``rows`` values up to its refit: a forecast from one window and one join, no loop."""
    means = panel.select(spec.product, spec.d.alias("refit_to"), F.avg(spec.v).over(spec.last_rows(rows)).alias("prediction"))
    wanted = F.broadcast(steps)
    known = means.join(wanted, "refit_to").select(spec.product, "step", "test_date", "prediction")
    actual = panel.select(spec.product, spec.d.alias("test_date"), spec.v.alias("label"))
    return known.join(as_large(actual), [spec.product, "test_date"])


def walk_forward_fit(panel: DataFrame, fit: Callable[[DataFrame], object], predict: Callable[[object, DataFrame], DataFrame], spec: PanelSpec = PanelSpec(), initial: int = 24, refit_every: int = 1, horizon: int = 1) -> DataFrame:
    """(step, then what ``predict`` gives) for the rows of each step's test date, with the model of the step's last refit.

    Models are fitted by ``fit`` on all rows up to their refit date, one Spark job each; steps that share a model are predicted
    together. The table of steps has a row per date and is read to the driver.
    """
    models: dict = {}
    for s in walk_forward(panel, spec, initial, refit_every, horizon).orderBy("step").collect():
        models.setdefault(s.refit_to, []).append((s.step, s.test_date))
    out = None
    for refit_to, steps in models.items():
        model = fit(panel.where(spec.d <= F.lit(refit_to)))
        dates = panel.sparkSession.createDataFrame(steps, f"step int, {spec.date} {dict(panel.dtypes)[spec.date]}")
        rows = predict(model, panel.join(F.broadcast(dates), spec.date))
        out = rows if out is None else out.unionByName(rows)
    return out
