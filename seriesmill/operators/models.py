"""Regression models on the feature panel: one set per demand class, early stopping, validation curves, importances."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import CATEGORIES, as_large, tasks_of
from ..functions.deals import deal, dealt_all
from ..functions.numbering import numbered
from ..sources.tables import STORED, remove, scratch_path, stored, stored_at
from ..spec import PanelSpec
from .metrics import best_stop, evaluate
from .splits import folds

FEATURES = ("quantity", "months_since_last_order", "last_order_quantity", "month", "year", "lag_1", "lag_2", "lag_3", "ma_4_month", "ma_8_month", "cov_quantity")
LABEL = "lead_month_1"


def estimators(label: str = LABEL, seed: int = 42) -> dict[str, object]:
    """Linear regression, random forest and boosted trees with the usual settings."""
    return {
        "linear": LinearRegression(labelCol=label),
        "random_forest": RandomForestRegressor(labelCol=label, seed=seed),
        "boosted_trees": GBTRegressor(labelCol=label, seed=seed),
    }


def pipeline(estimator, features: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"), estimator])


#: How many rows a fit reads one by one, and the rows of a task of a larger fit.
FEW_ROWS, TASK_ROWS = 2_000_000, 200_000
#: The column that says how many rows a row stands for.
WEIGHT = "_weight"


def counted(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct rows of ``columns``, each with how many rows it stands for, as WEIGHT; rows that have a WEIGHT stand for as many."""
    weight = F.sum(WEIGHT) if WEIGHT in rows.columns else F.count("*").cast("double")
    return rows.groupBy(*dict.fromkeys(columns)).agg(weight.alias(WEIGHT))


def in_counts(rows: DataFrame, columns: Sequence[str], *partition_by: str) -> tuple[DataFrame, str] | None:
    """``counted`` rows, written once, and their path; None for FEW_ROWS rows or less. One pass over ``rows`` serves all fits that start from it."""
    counts, path = stored_at(counted(rows, [*partition_by, *columns]), "counts", *partition_by)
    if (counts.agg(F.sum(WEIGHT)).first()[0] or 0) <= FEW_ROWS:
        remove(rows.sparkSession, path)
        return None
    return counts, path


def takes_weights(estimator) -> bool:
    """Whether an estimator can be given counted rows: it knows weights, and has none of its own."""
    return estimator.hasParam("weightCol") and not estimator.isSet("weightCol")


def packs_of(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a WEIGHT as packs of equal rows of ``columns``.

    Sums over rows, and so lines and trees, are the same from packs as from rows. A pack has n / FEW_ROWS rows at most (rounded up, of n rows),
    so there are FEW_ROWS packs at most besides one for each distinct row; bootstrap samples and random folds draw packs.
    """
    size = max(1, -(-int(counts.agg(F.sum(WEIGHT)).first()[0] or 0) // FEW_ROWS))
    each = counts.withColumn("_packs", F.ceil(F.col(WEIGHT) / size).cast("int")).withColumn(WEIGHT, F.col(WEIGHT) / F.col("_packs"))
    return each.select(*dict.fromkeys(columns), WEIGHT, F.explode(F.sequence(F.lit(1), "_packs")).alias("_pack")).drop("_pack")


def in_packs(rows: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, str] | None:
    """Packs of equal rows with their WEIGHT, of counts that are written once, and the path of these; None for FEW_ROWS rows or less, which are fitted one by one."""
    found = in_counts(rows, columns)
    return found and (packs_of(found[0], columns), found[1])


def small_tasks(packs: DataFrame) -> DataFrame:
    """Packs take few bytes in files, so their rows say how many tasks read them."""
    return packs.repartition(max(packs.sparkSession.sparkContext.defaultParallelism, -(-packs.count() // TASK_ROWS)))


def train(rows: DataFrame, estimator, features: Sequence[str] = FEATURES, grid: dict[str, Sequence] | None = None, n_folds: int = 3, parallelism: int = 2, seed: int = 42) -> PipelineModel:
    """A fitted pipeline; with a grid, the best of random folds by rmse. Large tables are fitted as packs of equal rows with weights."""
    return train_all(rows, [(estimator, features)], grid, n_folds, parallelism, seed)[0]


def train_all(rows: DataFrame, fits: Sequence[tuple[object, Sequence[str]]], grid: dict[str, Sequence] | None = None, n_folds: int = 3, parallelism: int = 2, seed: int = 42) -> list[PipelineModel]:
    """``train`` for each (estimator, features), which share a label: a large table is counted once for all fits. Rows with a WEIGHT are counted ones."""
    label = fits[0][0].getLabelCol()
    usable = rows.where(F.col(label).isNotNull())
    columns = list(dict.fromkeys([*(f for _, features in fits for f in features), label]))
    if WEIGHT in rows.columns:
        found = stored_at(counted(usable, columns), "counts")
    else:
        found = in_counts(usable, columns) if all(takes_weights(e) for e, _ in fits) else None
    if not found:
        return [fit(usable, e, features, grid, n_folds, parallelism, seed) for e, features in fits]
    packs = small_tasks(packs_of(found[0], columns))
    models = [fit(packs, e.copy().setWeightCol(WEIGHT), features, grid, n_folds, parallelism, seed) for e, features in fits]
    remove(rows.sparkSession, found[1])
    return models


def whole(features: Sequence[str]) -> Column:
    """Whether a row has all features."""
    return reduce(lambda a, b: a & b, (F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")) for f in features))


def side_by_side(models: Sequence[PipelineModel], rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """``rows`` with a prediction column of each model, for one pass that scores all, and the columns' names; null where a feature of the model is missing."""
    names = [f"_said{i}" for i in range(len(models))]
    for i, (model, name) in enumerate(zip(models, names)):
        inputs = model.stages[0].getInputCols()
        assembled = VectorAssembler(inputCols=inputs, outputCol=f"_x{i}", handleInvalid="keep").transform(rows)
        said = model.stages[-1].copy().setFeaturesCol(f"_x{i}").setPredictionCol(name).transform(assembled).drop(f"_x{i}")
        rows = said.withColumn(name, F.when(whole(inputs), F.col(name)))
    return rows, names


def errors(models: Sequence[PipelineModel], rows: DataFrame, label: str, by: Sequence[str] = ()) -> dict[tuple, float]:
    """The rmse of each model, by (number of the model, *by), from one pass over rows, or over counted ones."""
    scored, names = side_by_side(models, rows)
    weight = F.col(WEIGHT) if WEIGHT in rows.columns else F.lit(1.0)
    long = scored.select(*by, label, weight.alias("_n"), F.posexplode(F.array(*names)).alias("_model", "_p")).where(F.col(label).isNotNull() & F.col("_p").isNotNull())
    error = F.col(label) - F.col("_p")
    return {tuple(r)[:-1]: r[-1] for r in long.groupBy("_model", *by).agg(F.sqrt(F.sum(error * error * F.col("_n")) / F.sum("_n"))).collect()}


def fit(usable: DataFrame, estimator, features: Sequence[str], grid: dict[str, Sequence] | None = None, n_folds: int = 3, parallelism: int = 2, seed: int = 42) -> PipelineModel:
    """``train`` on rows as they are."""
    label, weight = estimator.getLabelCol(), {"weightCol": WEIGHT} if WEIGHT in usable.columns else {}
    if not grid:
        return pipeline(estimator, features).fit(usable)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    search = CrossValidator(
        estimator=pipeline(estimator, features), estimatorParamMaps=builder.build(), evaluator=RegressionEvaluator(labelCol=label, metricName="rmse", **weight), numFolds=n_folds, seed=seed, parallelism=parallelism
    )
    return search.fit(usable).bestModel


def train_in_time(rows: DataFrame, estimator, features: Sequence[str], grid: Sequence[dict], spec: PanelSpec = PanelSpec(), **fold_parameters) -> tuple[dict, PipelineModel]:
    """The grid point with the least mean rmse over folds that follow in time, and its fit on all rows.

    A large table is counted by date and values once; folds and the last fit start from that. A fold's points are scored in one pass.
    """
    label, table = estimator.getLabelCol(), folds(rows, spec, **fold_parameters).collect()
    found = in_counts(rows.where(F.col(label).isNotNull()), [spec.date, *features, label]) if takes_weights(estimator) else None
    source = found[0] if found else rows
    tried = [(estimator.copy({estimator.getParam(k): v for k, v in point.items()}), features) for point in grid]
    scores = [[] for _ in grid]
    for f in table:
        models = train_all(source.where(spec.d.between(F.lit(f.train_from), F.lit(f.train_to))), tried)
        rmse = errors(models, source.where(spec.d.between(F.lit(f.test_from), F.lit(f.test_to))), label)
        for i in range(len(grid)):
            scores[i].append(rmse[i,])
    means = [sum(s) / len(s) for s in scores]
    best = means.index(min(means))
    model = train(source, tried[best][0], features)
    if found:
        remove(rows.sparkSession, found[1])
    return grid[best], model


def train_per_category(panel: DataFrame, models: dict[str, object], features: Sequence[str] = FEATURES, categories: Sequence[str] = CATEGORIES) -> dict[tuple[str, str], PipelineModel]:
    """Models by (category, name); classes without usable rows have none.

    Usable rows, of large tables distinct ones with their counts, are written once, in a folder for each class, so that a fit reads its own class and no other.
    """
    label = next(iter(models.values())).getLabelCol()
    usable = panel.select(*dict.fromkeys(["product_category", label, *features])).na.drop().where(F.col("product_category").isin(*categories))
    counts = in_counts(usable, [*features, label], "product_category") if all(map(takes_weights, models.values())) else None
    rows, path = counts or stored_at(usable, "class-rows", "product_category")
    present = {r["product_category"] for r in rows.select("product_category").distinct().collect()}
    found = {}
    for c in (c for c in categories if c in present):
        own = rows.where(F.col("product_category") == c)
        fitted = train_all(own, [(e, features) for e in models.values()]) if counts else [fit(own, e, features) for e in models.values()]
        found |= {(c, n): model for n, model in zip(models, fitted)}
    remove(panel.sparkSession, path)
    return found


def score(models: dict[tuple[str, str], PipelineModel], panel: DataFrame, keep: Sequence[str] = ("product", "month_end")) -> DataFrame:
    """(keep, label, prediction, SalesPattern, Model) of every model on its class's rows, in one pass over ``panel``.

    Features are assembled once for each list of them. A model is a column that is only computed on rows of its class, and a row has
    one prediction for each name of a model; rows that lack a feature of a model have none of it.
    """
    label = next(iter(models.values())).stages[-1].getLabelCol()
    lists = list(dict.fromkeys(tuple(m.stages[0].getInputCols()) for m in models.values()))
    out = panel
    for i, names in enumerate(lists):
        out = VectorAssembler(inputCols=list(names), outputCol=f"_x{i}", handleInvalid="keep").transform(out)
    said: dict[str, list] = {}
    for j, ((category, name), model) in enumerate(models.items()):
        i = lists.index(tuple(model.stages[0].getInputCols()))
        out = model.stages[-1].copy().setFeaturesCol(f"_x{i}").setPredictionCol(f"_p{j}").transform(out)
        said.setdefault(name, []).append(((F.col("product_category") == category) & whole(lists[i]), F.col(f"_p{j}")))
    # The first case that holds; predictions are never null, so a null means that there is none.
    chosen = lambda cases: reduce(lambda c, case: c.when(*case), cases[1:], F.when(*cases[0]))
    each = F.inline(F.array(*[F.struct(chosen(cases).alias("prediction"), F.lit(name).alias("Model")) for name, cases in said.items()]))
    rows = out.select(*keep, F.col(label).cast("double").alias("label"), F.col("product_category").alias("SalesPattern"), each).where("prediction is not null")
    return rows.select(*keep, "label", "prediction", "SalesPattern", "Model")


def boosting_curve(train_rows: DataFrame, validation: DataFrame, features: Sequence[str], label: str = LABEL, most: int = 50, loss: str = "squared", seed: int = 42, **parameters) -> DataFrame:
    """(iteration, score): the validation loss after each tree, of one fit with ``most`` trees."""
    model = train(train_rows, GBTRegressor(labelCol=label, maxIter=most, seed=seed, **parameters), features)
    scored = model.stages[0].transform(validation.where(F.col(label).isNotNull()))
    losses = model.stages[-1].evaluateEachIteration(scored, loss)
    return train_rows.sparkSession.createDataFrame([(i + 1, float(x)) for i, x in enumerate(losses)], "iteration int, score double")


def of_trees(trees: Sequence, weights: Sequence[float]) -> GBTRegressionModel:
    """The boosted model that these regression trees make."""
    context = SparkContext._active_spark_context
    array = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    shares = context._gateway.new_array(context._jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        array[i], shares[i] = tree._java_obj, float(weight)
    return GBTRegressionModel(context._jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"grown_{len(trees)}", array, shares))


def grow_boosting(
    train_rows: DataFrame, validation: DataFrame, features: Sequence[str], label: str = LABEL, most: int = 50, patience: int = 3, min_delta: float = 0.0, loss: str = "squared", step: float = 0.1, seed: int = 42, **parameters
) -> tuple[GBTRegressionModel, list[float]]:
    """Boosted trees that stop while they grow: the model, and the validation loss after each of its trees.

    A tree is fitted to what the trees before it leave of the label, and no further one is grown once ``patience`` losses in a row
    have not beaten the best by more than ``min_delta``. Rows, of large tables as packs of equal ones with weights, are written once; what is left of a label is computed from
    the trees so far, as one column, when the next tree reads them.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    train_rows, validation = (df.where(F.col(label).isNotNull()) for df in (train_rows, validation))
    packs, weight = in_packs(train_rows, [*features, label]), F.col(WEIGHT)
    rows = packs[0] if packs else train_rows.withColumn(WEIGHT, F.lit(1.0))
    assembled = lambda df: assembler.transform(df).select("features", F.col(label).cast("double").alias("y"), WEIGHT)
    (rows, path), (held, held_path) = stored_at(assembled(rows), "boosting"), stored_at(assembled(counted(validation, [*features, label])), "boosting")
    rows, held = (small_tasks(rows), small_tasks(held)) if packs else (rows, held)
    tree = DecisionTreeRegressor(labelCol="left", weightCol=WEIGHT, seed=seed, **parameters)
    trees, weights, curve, best, since = [], [], [], math.inf, 0
    error = F.col("y") - F.col("prediction")
    while len(trees) < most and since < patience:
        # The gradient of squared errors is twice what is left.
        left = of_trees(trees, weights).transform(rows).select("features", WEIGHT, (2 * error).alias("left")) if trees else rows.withColumnRenamed("y", "left")
        trees.append(tree.fit(left))
        weights.append(step if weights else 1.0)
        curve.append(of_trees(trees, weights).transform(held).agg(F.sum((error * error if loss == "squared" else F.abs(error)) * weight) / F.sum(weight)).first()[0])
        best, since = (curve[-1], 0) if curve[-1] < best - min_delta else (best, since + 1)
    for p in (path, held_path, *([packs[1]] if packs else [])):
        remove(train_rows.sparkSession, p)
    return of_trees(trees, weights), curve


def boosting_stop(train_rows: DataFrame, validation: DataFrame, features: Sequence[str], patience: int = 3, min_delta: float = 0.0, **parameters) -> DataFrame:
    """Where boosting stops, and the best iteration until then; no tree is grown behind the stop."""
    _, curve = grow_boosting(train_rows, validation, features, patience=patience, min_delta=min_delta, **parameters)
    scores = train_rows.sparkSession.createDataFrame([(i + 1, x) for i, x in enumerate(curve)], "iteration int, score double")
    return best_stop(scores, patience, min_delta)


#: Trees that one fit grows at a time: a row in memory has a number for each.
LOT = 50


def fit_forest(train_rows: DataFrame, features: Sequence[str], label: str, n: int, seed: int, **parameters) -> PipelineModel:
    """A forest of n trees, grown in lots of LOT, each with a seed of its own."""
    usable = train_rows.where(F.col(label).isNotNull())
    packs = in_packs(usable, [*features, label])
    rows, weight = (small_tasks(packs[0]), {"weightCol": WEIGHT}) if packs else (usable, {})
    lots = [fit(rows, RandomForestRegressor(labelCol=label, numTrees=min(LOT, n - i), seed=seed + i, **weight, **parameters), features) for i in range(0, n, LOT)]
    if packs:
        remove(train_rows.sparkSession, packs[1])
    if len(lots) == 1:
        return lots[0]
    context, trees = SparkContext._active_spark_context, [t for m in lots for t in m.stages[-1].trees]
    array = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    for i, tree in enumerate(trees):
        array[i] = tree._java_obj
    whole = RandomForestRegressionModel(context._jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(f"grown_{n}", array, len(features)))
    return PipelineModel([lots[0].stages[0], whole])


def leaf_values(forest) -> DataFrame:
    """One row: for each tree of a forest its leaves' predictions, in the order in which the forest numbers them. They come from the model's own files."""
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").where("nodeData.leftChild < 0")
    leaves = nodes.groupBy("treeID").agg(F.transform(F.array_sort(F.collect_list(F.struct("nodeData.id", "nodeData.prediction"))), lambda n: n["prediction"]).alias("leaves"))
    STORED.append(path)
    return leaves.agg(F.transform(F.array_sort(F.collect_list(F.struct("treeID", "leaves"))), lambda t: t["leaves"]).alias("leaves"))


def forest_curve(train_rows: DataFrame, validation: DataFrame, features: Sequence[str], label: str = LABEL, counts: Sequence[int] = (10, 20, 50, 100), seed: int = 42, **parameters) -> DataFrame:
    """(iteration, score): validation rmse for the first n trees of one forest of ``max(counts)``.

    Equal rows of ``validation`` are answered once and weighed. The forest says which leaf of each tree a row reaches, as one column; the leaves' values are one broadcast row, as large as the
    forest. So all trees' answers are one array and the plan is the same for any number of trees.
    """
    model = fit_forest(train_rows, features, label, max(counts), seed, **parameters)
    forest = model.stages[-1].copy().setLeafCol("_leaf")
    held = small_tasks(stored(counted(validation.where(F.col(label).isNotNull()), [*features, label]), "held"))
    rows = forest.transform(model.stages[0].transform(held))
    rows = rows.select(F.col(label).alias("_y"), WEIGHT, vector_to_array("_leaf").alias("_leaf")).crossJoin(F.broadcast(leaf_values(forest)))
    answers = F.transform("_leaf", lambda leaf, tree: F.element_at(F.element_at("leaves", tree + 1), leaf.cast("int") + 1))
    rows = rows.select("_y", WEIGHT, answers.alias("_answers"))
    wanted = F.inline(F.array(*[F.struct(F.lit(n).alias("iteration"), (F.aggregate(F.slice("_answers", 1, n), F.lit(0.0), lambda a, b: a + b) / n).alias("_p")) for n in counts]))
    error = F.col("_y") - F.col("_p")
    return rows.select("_y", WEIGHT, wanted).groupBy("iteration").agg(F.sqrt(F.sum(error * error * F.col(WEIGHT)) / F.sum(WEIGHT)).alias("score"))


def validation_curve(train_rows: DataFrame, validation: DataFrame, estimator, parameter: str, values: Sequence, features: Sequence[str]) -> DataFrame:
    """(value, train_rmse, validation_rmse) for each value of a parameter. All models are scored in one pass over the rows of both kinds."""
    label = estimator.getLabelCol()
    models = train_all(train_rows, [(estimator.copy({estimator.getParam(parameter): v}), features) for v in values])
    columns = list(dict.fromkeys([*features, label]))
    both = train_rows.select(F.lit(False).alias("_held"), *columns).unionByName(validation.select(F.lit(True).alias("_held"), *columns))
    rmse = errors(models, both, label, ["_held"])
    found = [(float(v), rmse.get((i, False)), rmse.get((i, True))) for i, v in enumerate(values)]
    return train_rows.sparkSession.createDataFrame(found, "value double, train_rmse double, validation_rmse double")


def best_value(curve: DataFrame) -> DataFrame:
    return curve.agg(F.min_by("value", "validation_rmse").alias("best_value"), F.min("validation_rmse").alias("validation_rmse"))


def native_importance(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(feature, importance) of a tree model, largest first."""
    names, found = model.stages[0].getInputCols(), model.stages[-1].featureImportances.toArray()
    return rows.sparkSession.createDataFrame([(n, float(x)) for n, x in zip(names, found)], "feature string, importance double").orderBy(F.desc("importance"), "feature")


def numbered_at_random(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with _n, their number in the order of a seeded hash of all their columns: the same however they lie in partitions."""
    return numbered(rows, [F.xxhash64(F.lit(seed), *rows.columns), *rows.columns], "_n", tasks_of(rows.sparkSession, rows.count()))


def in_random_order(rows: DataFrame, seed: int) -> DataFrame:
    """``numbered_at_random``, written once."""
    return stored(numbered_at_random(rows, seed), "random-order")


def dealt(ordered: DataFrame, n: int, column: str, seed: int) -> DataFrame:
    """Rows in random order, ``n`` of them, with one column's values dealt to other rows."""
    a, b = deal(n, seed)
    values = ordered.select(F.col("_n").alias("_m"), F.col(column).alias("_v"))
    source = F.pmod(F.col("_n").cast("decimal(38,0)") * a + b, F.lit(max(n, 1))).cast("long")
    return ordered.withColumn("_m", source).join(as_large(values), "_m").withColumn(column, F.col("_v")).drop("_n", "_m", "_v")


def shuffled(rows: DataFrame, column: str, seed: int) -> DataFrame:
    """``rows`` with one column's values dealt to other rows."""
    ordered = in_random_order(rows, seed)
    return dealt(ordered, ordered.count(), column, seed)


def line_at(line: LinearRegressionModel, values: Sequence[Column]) -> Column:
    """What a fitted line says of these values of its features, as an expression."""
    terms = (F.lit(float(w)) * v for w, v in zip(line.coefficients.toArray(), values, strict=True))
    return reduce(lambda a, b: a + b, terms) + F.lit(float(line.intercept))


def permutation_importance(model: PipelineModel, rows: DataFrame, features: Sequence[str], repeats: int = 3, seed: int = 42, metric: str = "rmse") -> DataFrame:
    """(feature, importance, std): how much a metric worsens when a feature's values are dealt anew, over ``repeats`` deals.

    Every row is scored as it is and once for each deal, and the metrics of all deals are sums of one pass. A line is an expression; other
    models transform a row for each deal.
    """
    last, label, inputs = model.stages[-1], model.stages[-1].getLabelCol(), model.stages[0].getInputCols()
    columns = list(dict.fromkeys([*inputs, label]))
    ordered = numbered_at_random(stored(rows.select(*columns).na.drop(), "known"), seed)
    deals = [(f, seed + repeats * i + k) for i, f in enumerate(features) for k in range(repeats)]
    line = isinstance(last, LinearRegressionModel)
    made = []
    for k, (f, _) in enumerate([(None, 0), *deals], -1):
        values = [F.col(f"_dealt{k}" if c == f else c) for c in inputs]
        made.append(F.struct(F.lit(k).alias("_deal"), *([line_at(last, values).alias("prediction")] if line else [v.alias(c) for c, v in zip(inputs, values)])))
    tried = dealt_all(ordered, ordered.count(), columns, deals).select(F.col(label).alias("_label"), F.inline(F.array(*made))).withColumnRenamed("_label", label)
    said = tried if line else model.transform(tried)
    scores = evaluate(said, label, "prediction" if line else last.getPredictionCol(), ["_deal"]).select("_deal", F.col(metric).alias("value"))
    whole = scores.agg(F.max(F.when(F.col("_deal") < 0, F.col("value"))).alias("base"), F.collect_list(F.struct("_deal", "value")).alias("deals"))
    loss = (F.col("value") - F.col("base")) * (-1 if metric == "r2" else 1)
    named = F.element_at(F.array(*map(F.lit, features)), F.floor(F.col("_deal") / repeats).cast("int") + 1)
    each = whole.select("base", F.inline("deals")).where("_deal >= 0").select(named.alias("feature"), loss.alias("loss"))
    return each.groupBy("feature").agg(F.avg("loss").alias("importance"), F.stddev_pop("loss").alias("std"))


def selection_scores(train_rows: DataFrame, validation: DataFrame, estimator, features: Sequence[str], selected: Sequence[str], model: PipelineModel | None = None) -> DataFrame:
    """(features, n_features, rmse) of one model fitted with all features, which may be given, and one with the selected ones, scored in one pass."""
    label, sets = estimator.getLabelCol(), [("all", list(features)), ("selected", list(selected))]
    models = ([model] if model else []) + train_all(train_rows, [(estimator, some) for _, some in sets[bool(model) :]])
    rmse = errors(models, validation, label)
    return train_rows.sparkSession.createDataFrame([(name, len(some), rmse.get((i,))) for i, (name, some) in enumerate(sets)], "features string, n_features int, rmse double")
