"""Queries that fit models. Fits read all rows of whole panels; trees are few and flat, as their number and depth are parameters."""

from __future__ import annotations

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import ensemble as N
from ..operators import lines
from ..operators import metrics as M
from ..operators import models as L
from ..operators import panel as P
from ..operators import reports as R
from ..operators import scoring, splits, stumps
from ..sources.tables import stored
from . import fixtures as X
from .check_queries import _DATES, _METRICS
from .fixtures import CLASSES, sql

FEATURES = ("quantity", "lag_1", "lag_2", "ma_4_month", "month")


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of all series, with the classes that were known at the cut, as a table that fits read again and again."""
    cut = F.lit("2000-06-30").cast("date")
    panel = P.model_features(X.panel(spark, sf_dir), as_of=cut)
    return stored(P.long_enough(panel).select("product", "month_end", "product_category", L.LABEL, *FEATURES, "year"), "model-panel")


def _cut(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    known = df.na.drop()
    return known.where("month_end <= date'2000-06-30'"), known.where("month_end > date'2000-06-30'")


def _known(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _cut(_panel(spark, sf_dir))


def _small() -> dict[str, object]:
    return {
        "linear": LinearRegression(labelCol=L.LABEL),
        "random_forest": RandomForestRegressor(labelCol=L.LABEL, numTrees=5, maxDepth=4, seed=42),
        "boosted_trees": GBTRegressor(labelCol=L.LABEL, maxIter=4, maxDepth=3, seed=42),
    }


def linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line through (quantity, next month's), as SQL can fit it too."""
    rows = stored(P.lags(X.panel(spark, sf_dir), steps=()).select("product", "month_end", "quantity", L.LABEL), "line")
    model = L.train(rows, LinearRegression(labelCol=L.LABEL, solver="normal"), ["quantity"])
    return model.transform(rows.na.drop()).select("product", "month_end", F.round("prediction", 4).alias("prediction"))


def models_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _cut(_panel(spark, sf_dir))
    return scoring.validation_metrics(L.train_per_category(train, _small(), FEATURES), test)


def model_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best forest of a grid by random folds, on later months."""
    train, test = _known(spark, sf_dir)
    model = L.train(train, RandomForestRegressor(labelCol=L.LABEL, seed=42), FEATURES, {"maxDepth": [2, 4], "numTrees": [4, 8]})
    return M.evaluate(model.transform(test), L.LABEL)


def model_grid_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best depth by folds that follow in time."""
    train, test = _known(spark, sf_dir)
    best, model = L.train_in_time(train, DecisionTreeRegressor(labelCol=L.LABEL, seed=42), FEATURES, [{"maxDepth": 2}, {"maxDepth": 4}], n_splits=2, min_train=30, test=6)
    return M.evaluate(model.transform(test), L.LABEL).withColumn("max_depth", F.lit(best["maxDepth"]))


def cross_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _known(spark, sf_dir)[0]
    fit = lambda df: L.train(df, LinearRegression(labelCol=L.LABEL), FEATURES)
    return splits.cross_validate(rows, fit, lambda model, df: M.evaluate(model.transform(df), L.LABEL).first().asDict(), n_splits=2, min_train=36, test=6)


def boosting_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.boosting_stop(*_known(spark, sf_dir), FEATURES, most=20, maxDepth=3)


def forest_size_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.forest_curve(*_known(spark, sf_dir), FEATURES, counts=(10, 20, 50, 100, 200), maxDepth=4)


def depth_validation_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.validation_curve(*_known(spark, sf_dir), DecisionTreeRegressor(labelCol=L.LABEL, seed=42), "maxDepth", [1, 3], FEATURES)


def native_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _known(spark, sf_dir)
    return L.native_importance(L.train(train, _small()["random_forest"], FEATURES), train)


def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _known(spark, sf_dir)
    return L.permutation_importance(L.train(train, _small()["linear"], FEATURES), test, list(FEATURES))


def stacked_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two base models, their average, and two stacks of them on later months: one fitted on the base models' own rows, one on later rows than theirs."""
    train, test = _known(spark, sf_dir)
    base = [LinearRegression(), DecisionTreeRegressor(maxDepth=3, seed=42)]
    out = N.fit_stack(train, base, FEATURES, L.LABEL, use_features=True).transform(test).withColumn("average", N.simple_average(["base_0", "base_1"]))
    own = M.evaluate_each(out, ["base_0", "base_1", "average", "prediction"], L.LABEL)
    in_time = N.fit_stack_in_time(train, base, FEATURES, L.LABEL, use_features=True, n_splits=3, min_train=36, test=6).transform(test)
    return own.union(M.evaluate_each(in_time.withColumnRenamed("prediction", "out_of_fold"), ["out_of_fold"], L.LABEL)).select("model", *rounded(["rmse", "mae"], 4))


def champion_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next month's demand of every series that sold in the last month, by its class's champion and challenger."""
    panel = _panel(spark, sf_dir)
    train, test = _cut(panel)
    models = L.train_per_category(train, {k: v for k, v in _small().items() if k != "boosted_trees"}, FEATURES)
    metrics = scoring.validation_metrics(models, test)
    return scoring.tag_champions(L.score(models, P.latest_month(panel)), metrics)


def _line() -> LinearRegression:
    return LinearRegression(labelCol=L.LABEL, solver="normal")


def cross_validated_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross validation in time of a line through (quantity, next month's), as SQL can fit it too: all folds from one pass."""
    rows = _known(spark, sf_dir)[0]
    out = lines.cross_validate_line(rows, ["quantity"], L.LABEL, n_splits=2, min_train=36, test=6)
    return out.where("metric in ('rmse', 'mae')").select("metric", *rounded(["mean", "std"], 4))


def walk_forward_refits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walk-forward validation of the same line, fitted anew every twelfth step, two months ahead of what it knows."""
    rows = stored(P.lags(X.panel(spark, sf_dir), steps=()).select("product", "month_end", "quantity", L.LABEL).na.drop(), "line")
    out = lines.walk_forward_line(rows, ["quantity"], L.LABEL, refit_every=12, horizon=2)
    return M.evaluate(out, L.LABEL, by=["step"]).select("step", *rounded(["rmse", "mae"], 4))


def cross_validated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folds of ``cross_validated``, its five features in one line, from one pass."""
    rows = _known(spark, sf_dir)[0]
    return lines.cross_validate_line(rows, FEATURES, L.LABEL, n_splits=2, min_train=36, test=6).select("metric", *rounded(["mean", "std"], 4))


#: Features with few values, on which a tree's splits are exact.
CALENDAR = ("month", "year")


def _stump() -> DecisionTreeRegressor:
    return DecisionTreeRegressor(labelCol=L.LABEL, maxDepth=1, seed=42)


def stump_grid_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether one split of the calendar is better than none, by folds that follow in time, and the chosen tree on later months, as SQL can say too."""
    train, test = _known(spark, sf_dir)
    best, model = L.train_in_time(train, _stump(), CALENDAR, [{"maxDepth": 0}, {"maxDepth": 1}], n_splits=2, min_train=36, test=6)
    return M.evaluate(model.transform(test), L.LABEL).select(F.lit(best["maxDepth"]).alias("max_depth"), *rounded(["rmse", "mae"], 4))


def stump_validation_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The errors of trees without and with one split of the calendar, on their own months and on later ones."""
    return L.validation_curve(*_known(spark, sf_dir), _stump(), "maxDepth", [0, 1], CALENDAR).select("value", *rounded(["train_rmse", "validation_rmse"], 4))


def stump_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of one split has all its importance in one feature; how much each feature's own best split would explain."""
    train, _ = _known(spark, sf_dir)
    tree = L.native_importance(L.train(train, _stump(), CALENDAR), train)
    return tree.join(stumps.best_splits(train, CALENDAR, L.LABEL), "feature").select("feature", "importance", "cut", *rounded(["left_mean", "right_mean", "share"], 6))


def importance_of_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest's own importances, the features they select, and the error with all features and with those."""
    train, test = _known(spark, sf_dir)
    forest = _small()["random_forest"]
    counts = L.in_counts(train, [*FEATURES, L.LABEL])
    rows = counts[0] if counts else train
    model = L.train(rows, forest, FEATURES)
    selected = R.select_features(L.native_importance(model, train), 0.01, 3).orderBy("rank")
    names = [r["feature"] for r in selected.collect()]  # a row per feature
    return L.selection_scores(rows, test, forest, FEATURES, names, model).withColumn("names", F.lit(",".join(names)))


def scoring_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole scoring run from daily sales: next month's demand by each class's champion and challenger, lines through one feature each."""
    daily = X.lines(spark, sf_dir)
    panel = P.long_enough(P.add_features(stored(P.monthly_rollup(daily, "part", "d", "q"), "months")), 6)
    panel = stored(panel.select("product", "month_end", "product_category", L.LABEL, "quantity", "ma_4_month"), "model-panel")
    train, test = panel.where("month_end <= date'2000-06-30'"), panel.where("month_end > date'2000-06-30'")
    models = {k: m for name, feature in (("last", "quantity"), ("mean", "ma_4_month")) for k, m in L.train_per_category(train, {name: _line()}, [feature]).items()}
    out = scoring.run(daily, models, scoring.validation_metrics(models, test), "part", "d", "q")
    return out.select("product", "month_end", F.round("prediction", 4).alias("prediction"), "SalesPattern", "Model", "is_champion")


QUERIES = {f.__name__: f for f in (
    linear_fit, models_by_category, model_grid_search, model_grid_in_time, cross_validated, boosting_early_stop, forest_size_curve, depth_validation_curve, native_importance,
    permutation_importance, stacked_ensemble, champion_scores, cross_validated_line, cross_validated_lines, walk_forward_refits, importance_of_forest, scoring_run, stump_grid_in_time, stump_validation_curve, stump_importance,
)}

_KNOWN = "known as (select * from (select product, month_end, quantity, lead(quantity) over (partition by product order by month_end) as y from panel) where y is not null)"

#: Classes as they were known at the cut.
_CUT_CLASSES = CLASSES.replace(" quantity > 0", " quantity > 0 and month_end <= date '2000-06-30'").replace("(quantity > 0", "(quantity > 0 and month_end <= date '2000-06-30'")
_ALL_KNOWN = "everything as (select *, month(month_end) as month, year(month_end) as year from (select product, month_end, quantity, lag(quantity, 2) over w as lag_2, lead(quantity) over w as y from panel window w as (partition by product order by month_end)) join classed using (product) where total_orders >= 5 and y is not null and lag_2 is not null), known as (from everything where month_end <= date '2000-06-30'), later as (from everything where month_end > date '2000-06-30')"
_FOLDS = (
    _DATES.format(source="known"),
    "bounds2 as (select f.fold, 36 + f.fold * step - 1 as b, 36 + f.fold * step as c, 36 + f.fold * step + 5 as d from (select greatest(1, (max(n) - 42) // 2) as step, max(n) as n from dates having max(n) >= 42), generate_series(0, 1) f(fold) where 36 + f.fold * step + 5 < n)",
    "folds2 as (select fold, y.p as train_to, z.p as test_from, u.p as test_to from bounds2 join dates y on y.i = b join dates z on z.i = c join dates u on u.i = d)",
)


def _split(name: str, rows: str) -> str:
    """The best split by month or year of ``rows(g, month, year, y)`` for each g, with the mean that no split leaves."""
    return f"""
    {name}_v as (select g, feature, v, count(*)::double as n, sum(y)::double as s, sum(y * y)::double as q from (unpivot (select g, month::double as month, year::double as year, y from {rows}) on month, year into name feature value v) group by all),
    {name}_r as (select *, sum(n) over (w rows unbounded preceding) as nl, sum(s) over (w rows unbounded preceding) as sl, sum(n) over p as nt, sum(s) over p as st, sum(q) over p as qt, lead(v) over w as after
      from {name}_v window w as (partition by g, feature order by v), p as (partition by g, feature)),
    {name}_f as (select *, (sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt) / (qt - st * st / nt) as share, (v + after) / 2 as cut, sl / nl as left_mean, (st - sl) / (nt - nl) as right_mean, st / nt as mean
      from {name}_r where after is not null qualify row_number() over (partition by g, feature order by share desc, v) = 1),
    {name} as (from {name}_f qualify row_number() over (partition by g order by share desc, feature) = 1)"""


_SAID = "case when (feature = 'month' and month <= cut) or (feature = 'year' and year <= cut) then left_mean else right_mean end"

ORACLE_SQL = {
    "stump_grid_in_time": sql(
        f"select depth as max_depth, round(sqrt(avg((y - p) * (y - p))), 4) as rmse, round(avg(abs(y - p)), 4) as mae from (select y, depth, case depth when 0 then mean else {_SAID} end as p from later, whole, chosen) group by 1",
        _CUT_CLASSES, _ALL_KNOWN, *_FOLDS, "folded as (select fold as g, k.* from known k join folds2 on month_end <= train_to)", _split("by_fold", "folded"), "all_known as (select 0 as g, * from known)", _split("whole", "all_known"),
        f"errors as (select fold, sqrt(avg((y - mean) * (y - mean))) as e0, sqrt(avg((y - {_SAID}) * (y - {_SAID}))) as e1 from known join folds2 on month_end between test_from and test_to join by_fold on g = fold group by 1)",
        "chosen as (select case when avg(e0) <= avg(e1) then 0 else 1 end as depth from errors)",
    ),
    "stump_validation_curve": sql(
        f"select depth::double as value, round(sqrt(avg((y - p) * (y - p)) filter (known)), 4) as train_rmse, round(sqrt(avg((y - p) * (y - p)) filter (not known)), 4) as validation_rmse from (select y, known, depth, case depth when 0 then mean else {_SAID} end as p from (select *, month_end <= date '2000-06-30' as known from everything), whole, (values (0), (1)) d(depth)) group by 1",
        _CUT_CLASSES, _ALL_KNOWN, "all_known as (select 0 as g, * from known)", _split("whole", "all_known"),
    ),
    "stump_importance": sql(
        "select f.feature, case when f.feature = w.feature then 1.0::double else 0.0::double end as importance, f.cut, round(f.left_mean, 6) as left_mean, round(f.right_mean, 6) as right_mean, round(f.share, 6) as share from whole_f f, whole w",
        _CUT_CLASSES, _ALL_KNOWN, "all_known as (select 0 as g, * from known)", _split("whole", "all_known"),
    ),
    "linear_fit": sql(
        "select product, month_end, round(a + b * quantity, 4) as prediction from known, (select regr_intercept(y, quantity) as a, regr_slope(y, quantity) as b from known)",
        "known as (select * from (select product, month_end, quantity, lead(quantity) over (partition by product order by month_end) as y from panel) where y is not null)",
    ),
    "cross_validated_line": sql(
        "select metric, round(avg(value), 4) as mean, round(coalesce(stddev_samp(value), 0.0), 4) as std from (unpivot (select fold, rmse, mae from scores) on rmse, mae into name metric value value) group by 1",
        CLASSES.replace(" quantity > 0", " quantity > 0 and month_end <= date '2000-06-30'").replace("(quantity > 0", "(quantity > 0 and month_end <= date '2000-06-30'"),
        "known as (select * from (select product, month_end, quantity, lag(quantity, 2) over w as lag_2, lead(quantity) over w as y from panel window w as (partition by product order by month_end)) join classed using (product) where total_orders >= 5 and y is not null and lag_2 is not null and month_end <= date '2000-06-30')",
        _DATES.format(source="known"),
        "bounds2 as (select f.fold, 36 + f.fold * step - 1 as b, 36 + f.fold * step as c, 36 + f.fold * step + 5 as d from (select greatest(1, (max(n) - 42) // 2) as step, max(n) as n from dates having max(n) >= 42), generate_series(0, 1) f(fold) where 36 + f.fold * step + 5 < n)",
        "folds2 as (select fold, y.p as train_to, z.p as test_from, u.p as test_to from bounds2 join dates y on y.i = b join dates z on z.i = c join dates u on u.i = d)",
        "lines2 as (select fold, any_value(test_from) as lo, any_value(test_to) as hi, regr_intercept(y, quantity) as a, regr_slope(y, quantity) as b from known join folds2 on month_end <= train_to group by 1)",
        f"scores as (select fold, {_METRICS} from (select fold, y as label, a + b * quantity as p from known join lines2 on month_end between lo and hi) group by 1)",
    ),
    "walk_forward_refits": sql(
        "select step, round(sqrt(avg((y - a - b * quantity) * (y - a - b * quantity))), 4) as rmse, round(avg(abs(y - a - b * quantity)), 4) as mae from known join steps2 on month_end = test_date join lines2 using (refit_to) group by 1",
        _KNOWN, _DATES.format(source="known"),
        "steps2 as (select (t.i - 25)::int as step, t.p as test_date, r.p as refit_to from dates t join dates r on r.i = 23 + (t.i - 25) - (t.i - 25) % 12 where t.i >= 25)",
        "lines2 as (select refit_to, regr_intercept(y, quantity) as a, regr_slope(y, quantity) as b from known, (select distinct refit_to from steps2) where month_end <= refit_to group by 1)",
    ),
    "scoring_run": sql(
        'select product, month_end, round(a + b * x, 4) as prediction, product_category as "SalesPattern", model as "Model", is_champion from tall join ranks using (product_category, model) where month_end = (select max(month_end) from tall)',
        CLASSES,
        "base as (select product, month_end, product_category, quantity as last, avg(quantity) over (w rows 3 preceding) as mean, lead(quantity) over w as y from panel join classed using (product) where product like 'P%' and total_orders >= 6 window w as (partition by product order by month_end))",
        "tall as (from (unpivot base on last, mean into name model value x))",
        "fits as (select product_category, model, regr_intercept(y, x) as a, regr_slope(y, x) as b from tall where y is not null and month_end <= date '2000-06-30' group by 1, 2)",
        "errors as (select product_category, model, any_value(a) as a, any_value(b) as b, sqrt(avg((y - a - b * x) * (y - a - b * x))) as rmse from tall join fits using (product_category, model) where month_end > date '2000-06-30' and y is not null group by 1, 2)",
        "ranks as (select *, row_number() over (partition by product_category order by rmse, model) = 1 as is_champion from errors)",
    ),
}
