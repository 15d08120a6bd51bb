"""Queries over forecasts: accuracy, early stopping, ensembles, intervals, selection, reports, series models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import by_series, rounded
from ..operators import ensemble as N
from ..operators import intervals as I
from ..operators import metrics as M
from ..operators import reports as R
from ..operators import series as T
from ..operators import splits as S
from ..operators.stumps import importances
from . import fixtures as X
from .check_queries import _METRICS
from .fixtures import CLASSES, FORECASTS, MODELS, sql

KEYS = ("product", "month_end")


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = S.time_cut(X.forecasts(spark, sf_dir))
    return rows.where("is_train").drop("is_train", "cut_date"), rows.where("not is_train").drop("is_train", "cut_date")


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.evaluate_each(X.forecasts(spark, sf_dir), MODELS, by=["category"])


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feature, model, importance): how much of two targets trees of one split explain by each forecast."""
    rows = X.forecasts(spark, sf_dir).select(*MODELS, "label", (F.col("label") - F.col("pred_naive")).alias("step"))
    return importances(rows, MODELS, "label", "label").union(importances(rows, MODELS, "step", "step"))


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir).select("category", "model", *rounded(["rmse", "r2", "mae", "mape"]))


def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where training would stop if each series' errors over time were a score curve."""
    w = Window.partitionBy("product").orderBy("month_end")
    rows = X.forecasts(spark, sf_dir)
    curve = by_series(rows, rows.count()).select("product", F.row_number().over(w).alias("iteration"), F.abs(F.col("label") - F.col("pred_ma4")).alias("score"))
    return M.best_stop(curve, patience=4, min_delta=0.5, by=["product"]).withColumn("best_score", F.round("best_score", 6))


def ensemble_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = {"pred_naive": 1.0, "pred_ma4": 2.0, "pred_snaive": 1.0}
    out = X.forecasts(spark, sf_dir).withColumns({"average": N.simple_average(MODELS), "weighted": N.weighted_average(MODELS, weights), "uniform": N.weighted_average(MODELS), "median": N.row_median(MODELS)})
    return out.select(*KEYS, *rounded(["average", "weighted", "uniform", "median"]))


def ensemble_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions that come as tables of their own, joined on the whole key."""
    rows = X.forecasts(spark, sf_dir)
    frames = [rows.select(*KEYS, F.col(m).alias("prediction")) for m in MODELS]
    return N.join_predictions(frames, MODELS).select(*KEYS, "pred_naive", F.round("pred_ma4", 6).alias("pred_ma4"), "pred_snaive")


def ensemble_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.weight_table(_parts(spark, sf_dir)[0], MODELS).select("model", *rounded(["rmse", "weight"]))


def ensemble_best_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _parts(spark, sf_dir)
    return N.best_by_category(test, N.best_model(train, MODELS), MODELS).select(*KEYS, "category", F.round("prediction", 6).alias("prediction"))


def ensemble_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _parts(spark, sf_dir)
    return N.compare_strategies(test, train, MODELS).select("strategy", *rounded(["rmse", "r2", "mae"], 4))


INTERVAL = ("lower_bound", "upper_bound", "interval_width", "relative_uncertainty")


def _interval_rows(spark: SparkSession, sf_dir: str, kind) -> DataFrame:
    train, test = (df.withColumn("prediction", F.col("pred_ma4")) for df in _parts(spark, sf_dir))
    return kind(test, calibration=train)


def intervals_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interval_rows(spark, sf_dir, I.normal_intervals).select(*KEYS, *rounded(["residual", *INTERVAL], 4), "confidence_score")


def intervals_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interval_rows(spark, sf_dir, I.quantile_intervals).select(*KEYS, *rounded(INTERVAL, 4), "confidence_score")


def intervals_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = (df.withColumn("prediction", F.col("pred_ma4")) for df in _parts(spark, sf_dir))
    return I.bootstrap_intervals(test, list(KEYS), calibration=train).select(*KEYS, *rounded(INTERVAL, 4))


def interval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.uncertainty_summary(_interval_rows(spark, sf_dir, I.normal_intervals)).select(*rounded([f"avg_{c}" for c in ("interval_width", "relative_uncertainty", "confidence_score")], 4))


def interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.coverage(_interval_rows(spark, sf_dir, I.quantile_intervals)).select(*rounded(["coverage", "mean_width"], 4), "is_calibrated")


def champion_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.champions(_results(spark, sf_dir)).select("category", "model", F.round("rmse", 6).alias("rmse"), "rank", "role")


def run_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _results(spark, sf_dir)
    best = R.top_runs(results, "rmse", 2).select(F.lit("rmse").alias("metric"), "category", "model")
    return best.union(R.top_runs(results, "r2", 2).select(F.lit("r2"), "category", "model"))


def best_per_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.best_per_metric(M.evaluate_each(X.forecasts(spark, sf_dir), MODELS))


def metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = M.long_metrics(M.evaluate_each(X.forecasts(spark, sf_dir), MODELS), ["model"])
    return R.metric_table(long).select("model", *rounded(["rmse", "r2", "mae", "mape"]))


def category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.category_table(_results(spark, sf_dir), MODELS).select("category", *rounded(MODELS))


def residual_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = X.forecasts(spark, sf_dir).unpivot(["label"], list(MODELS), "model", "prediction")
    return R.residual_histogram(long, 25.0)


def actual_and_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.actual_and_predicted(X.forecasts(spark, sf_dir), ["S1", "S2", "E3"], MODELS)
    return out.select(*KEYS, "series", F.round("value", 6).alias("value"))


def importance_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_features(_importance(spark, sf_dir).where("model = 'label'"), 2).select("feature", F.round("importance", 6).alias("importance"))


def importance_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.compare_importance(_importance(spark, sf_dir), ["label", "step"]).select("feature", *rounded(["label", "step"]))


def importance_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _importance(spark, sf_dir).where("model = 'label'")
    return R.selection_summary(rows, R.select_features(rows, 0.01, 2)).withColumn("reduction_percent", F.round("reduction_percent", 6))


def importance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.importance_summary(_importance(spark, sf_dir)).select("n_features", *rounded(["mean", "std", "max"]))


def series_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.series_rows(X.gaps(spark, sf_dir)).select("unique_id", "ds", F.col("y").cast("double").alias("y"))


def croston(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.croston(X.panel(spark, sf_dir)).select("product", F.round(F.col("croston") + 1e-7, 4).alias("croston"))


def seasonal_smoothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.seasonal_smoothing(X.panel(spark, sf_dir)).select("product", "position", "alpha", F.round(F.col("level") + 1e-7, 4).alias("level"))


def seasonal_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal smoothing fitted before 2001, held against the months that follow."""
    panel = X.stored_panel(spark, sf_dir)
    train = panel.where("month_end < date'2001-01-01'")
    ahead = T.seasonal_forecast(train, T.seasonal_smoothing(train), 12)
    return T.forecast_accuracy(ahead, panel, ["seasonal"]).select("model", *rounded(["rmse", "mae"], 4))


def next_month_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = X.panel(spark, sf_dir).groupBy("product").agg(F.max("month_end").alias("last"))
    ahead = T.future_months(ends, 3)
    return T.next_month(ahead.select("product", "month_end", "h"), ends)


def holt_winters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.holt_winters(X.panel(spark, sf_dir), 6).select(*KEYS, F.round(F.col("holt_winters") + 1e-7, 4).alias("holt_winters"))


QUERIES = {f.__name__: f for f in (
    model_metrics, early_stop, ensemble_columns, ensemble_joined, ensemble_weights, ensemble_best_by_category, ensemble_strategies, intervals_normal, intervals_quantile, intervals_bootstrap,
    interval_summary, interval_coverage, champion_selection, run_ranking, best_per_metric, metric_table, category_performance, residual_histogram, actual_and_predicted,
    importance_top, importance_comparison, importance_selection, importance_summary, series_rows, croston, seasonal_smoothing, seasonal_accuracy, next_month_forecast, holt_winters,
)}

_RESULTS = f"results as (select category, model, {_METRICS.replace(' p)', ' prediction)')} from long group by 1, 2)"
_TOTALS = f"totals as (select model, {_METRICS.replace(' p)', ' prediction)')} from long group by 1)"
_PARTS = "cut as (select quantile_disc(month_end, 0.8) as c from forecasts), train as (select forecasts.* from forecasts, cut where month_end < c), test as (select forecasts.* from forecasts, cut where month_end >= c)"
_RMSE = lambda by, source: f"select {by} model, sqrt(avg((label - prediction) * (label - prediction))) as rmse from (unpivot {source} on pred_naive, pred_ma4, pred_snaive into name model value prediction) group by all"
_WEIGHTS = f"scores as ({_RMSE('', 'train')}), weights as (select model, rmse, (1 / rmse) / sum(1 / rmse) over () as weight from scores)"
_BEST = f"best as (select category, model from ({_RMSE('category,', 'train')}) qualify row_number() over (partition by category order by rmse, model) = 1)"
_PICK = "case model when 'pred_naive' then pred_naive when 'pred_ma4' then pred_ma4 when 'pred_snaive' then pred_snaive else (pred_naive + pred_ma4 + pred_snaive) / 3 end"
_W = lambda m: f"(select weight from weights where model = '{m}')"
_ROUND = lambda *names: ", ".join(f"round({n}, 4) as {n}" for n in names)
_WIDTH = "wide as (select *, hi - lo as interval_width, case when p > 0 then (hi - lo) / p else 1.0 end as relative_uncertainty from spans), scored as (select *, (case when relative_uncertainty < 0.1 then 1.0 when relative_uncertainty < 0.3 then 0.8 when relative_uncertainty < 0.5 then 0.6 when relative_uncertainty < 0.8 then 0.4 else 0.2 end)::double as confidence_score from wide)"
_NORMAL = f"sd as (select stddev_samp(label - pred_ma4) as s from train), spans as (select *, pred_ma4 as p, greatest(pred_ma4 - 1.959963984540054 * s, 0) as lo, pred_ma4 + 1.959963984540054 * s as hi from test, sd), {_WIDTH}"
_QUANT = f"qs as (select quantile_disc(label - pred_ma4, 0.025) as a, quantile_disc(label - pred_ma4, 0.975) as b from train), spans as (select *, pred_ma4 as p, greatest(pred_ma4 + a, 0) as lo, pred_ma4 + b as hi from test, qs), {_WIDTH}"
_IMPORTANCE = f"""
points as (select name as model, feature, v, count(*)::double as n, sum(y)::double as s, sum(y * y)::double as q from (
  select name, feature, v, y - avg(y) over (partition by name, feature) as y from (
    unpivot (select *, label - pred_naive as step from forecasts) on label, step into name name value y) base, lateral (values {", ".join(f"('{m}', base.{m})" for m in MODELS)}) f(feature, v)) group by all),
run as (select *, sum(n) over (w rows unbounded preceding) as nl, sum(s) over (w rows unbounded preceding) as sl, sum(n) over p as nt, sum(s) over p as st, sum(q) over p as qt, lead(v) over w as after
  from points window w as (partition by model, feature order by v), p as (partition by model, feature)),
imp as (select model, feature, max((sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt) / (qt - st * st / nt)) as importance from run where after is not null group by 1, 2)
"""
_GRID = ", ".join(f"({k / 10})" for k in range(1, 10))

_SMOOTH = lambda where: f"""
dense as (from panel where true {where}),
placed as (select product, month_end, quantity, (row_number() over (partition by product order by month_end) - 1) % 12 as position from dense),
ranked as (select *, row_number() over (partition by product, position order by month_end) as n from placed),
run as (
  select product, position, alpha::double as alpha, n, quantity as level, 0.0::double as sse from ranked, (values {_GRID}) v(alpha) where n = 1
  union all select v.product, v.position, r.alpha, v.n, r.level + r.alpha * (v.quantity - r.level), r.sse + (v.quantity - r.level) * (v.quantity - r.level)
  from run r join ranked v on v.product = r.product and v.position = r.position and v.n = r.n + 1),
ends as (from run qualify n = max(n) over (partition by product, position)),
best as (from ends qualify row_number() over (partition by product, position order by round(sse, 6), alpha, level) = 1)
"""  # noqa: E731
_REC = lambda body, *ctes: sql(body, *ctes).replace("with ", "with recursive ", 1)

ORACLE_SQL = {
    "model_metrics": sql("select category, model, " + ", ".join(f"round({m}, 6) as {m}" for m in ("rmse", "r2", "mae", "mape")) + " from results", CLASSES, FORECASTS, _RESULTS),
    "early_stop": sql(
        "select product, any_value(stop)::int as stop_iteration, arg_min(iteration, (score, iteration))::int as best_iteration, round(min(score), 6) as best_score from m where iteration <= stop group by 1",
        CLASSES, FORECASTS,
        "c as (select product, row_number() over (partition by product order by month_end) as iteration, abs(label - pred_ma4) as score from forecasts)",
        "d as (select *, score < coalesce(min(score) over (partition by product order by iteration rows between unbounded preceding and 1 preceding) - 0.5, 'infinity'::double) as better from c)",
        "e as (select *, iteration - last_value(case when better then iteration end ignore nulls) over (partition by product order by iteration rows unbounded preceding) as since from d)",
        "m as (select *, coalesce(min(iteration) filter (since >= 4) over (partition by product), max(iteration) over (partition by product)) as stop from e)",
    ),
    "ensemble_columns": sql("select product, month_end, round((pred_naive + pred_ma4 + pred_snaive) / 3, 6) as average, round(pred_naive * 0.25::double + pred_ma4 * 0.5::double + pred_snaive * 0.25::double, 6) as weighted, round((pred_naive + pred_ma4 + pred_snaive) / 3, 6) as uniform, round(list_sort([pred_naive, pred_ma4, pred_snaive])[2], 6) as median from forecasts", CLASSES, FORECASTS),
    "ensemble_joined": sql("select product, month_end, pred_naive, round(pred_ma4, 6) as pred_ma4, pred_snaive from forecasts", CLASSES, FORECASTS),
    "ensemble_weights": sql("select model, round(rmse, 6) as rmse, round(weight, 6) as weight from weights", CLASSES, FORECASTS, _PARTS, _WEIGHTS),
    "ensemble_best_by_category": sql(f"select product, month_end, category, round({_PICK}, 6) as prediction from test left join best using (category)", CLASSES, FORECASTS, _PARTS, _BEST),
    "ensemble_strategies": sql(
        f"select strategy, {_ROUND('rmse', 'r2', 'mae')} from (select strategy, {_METRICS} from (unpivot s on average, weighted, median, best into name strategy value p) group by 1)",
        CLASSES, FORECASTS, _PARTS, _WEIGHTS, _BEST,
        f"s as (select label, (pred_naive + pred_ma4 + pred_snaive) / 3 as average, pred_naive * {_W('pred_naive')} + pred_ma4 * {_W('pred_ma4')} + pred_snaive * {_W('pred_snaive')} as weighted, list_sort([pred_naive, pred_ma4, pred_snaive])[2] as median, {_PICK} as best from test left join best using (category))",
    ),
    "intervals_normal": sql(f"select product, month_end, round(label - p, 4) as residual, round(lo, 4) as lower_bound, round(hi, 4) as upper_bound, {_ROUND('interval_width', 'relative_uncertainty')}, confidence_score from scored", CLASSES, FORECASTS, _PARTS, _NORMAL),
    "intervals_quantile": sql(f"select product, month_end, round(lo, 4) as lower_bound, round(hi, 4) as upper_bound, {_ROUND('interval_width', 'relative_uncertainty')}, confidence_score from scored", CLASSES, FORECASTS, _PARTS, _QUANT),
    "interval_summary": sql("select " + ", ".join(f"round(avg({c}), 4) as avg_{c}" for c in ("interval_width", "relative_uncertainty", "confidence_score")) + " from scored", CLASSES, FORECASTS, _PARTS, _NORMAL),
    "interval_coverage": sql("select round(c, 4) as coverage, round(w, 4) as mean_width, abs(c - 0.95) < 0.05 as is_calibrated from (select avg(case when label between lo and hi then 1.0 else 0.0 end) as c, avg(interval_width) as w from scored)", CLASSES, FORECASTS, _PARTS, _QUANT),
    "champion_selection": sql("select category, model, round(rmse, 6) as rmse, rank, case rank when 1 then 'champion' else 'challenger' end as role from (select *, (row_number() over (partition by category order by rmse, model))::int as rank from results) where rank <= 2", CLASSES, FORECASTS, _RESULTS),
    "run_ranking": sql("select * from (select 'rmse' as metric, category, model from results order by rmse, category, model limit 2) union all select * from (select 'r2', category, model from results order by r2 desc, category, model limit 2)", CLASSES, FORECASTS, _RESULTS),
    "best_per_metric": sql("select arg_min(model, (rmse, model)) as best_rmse, arg_min(model, (mape, model)) as best_mape, arg_min(model, (-r2, model)) as best_r2 from totals", CLASSES, FORECASTS, _TOTALS),
    "metric_table": sql("select model, " + ", ".join(f"round({m}, 6) as {m}" for m in ("rmse", "r2", "mae", "mape")) + " from totals", CLASSES, FORECASTS, _TOTALS),
    "category_performance": sql("select category, " + ", ".join(f"round(coalesce(max(rmse) filter (model = '{m}'), 0), 6) as {m}" for m in MODELS) + " from results group by 1", CLASSES, FORECASTS, _RESULTS),
    "residual_histogram": sql("select model, floor((label - prediction) / 25.0)::bigint as bin, count(*) as n from long group by 1, 2", CLASSES, FORECASTS),
    "actual_and_predicted": sql("select product, month_end, series, round(value, 6) as value from (unpivot (select product, month_end, label as actual, pred_naive, pred_ma4, pred_snaive from forecasts where product in ('S1', 'S2', 'E3')) on actual, pred_naive, pred_ma4, pred_snaive into name series value value)", CLASSES, FORECASTS),
    "importance_top": sql("select feature, round(importance, 6) as importance from imp where model = 'label' order by imp.importance desc, feature limit 2", CLASSES, FORECASTS, _IMPORTANCE),
    "importance_comparison": sql("select feature, round(max(importance) filter (model = 'label'), 6) as label, round(max(importance) filter (model = 'step'), 6) as step from imp group by 1", CLASSES, FORECASTS, _IMPORTANCE),
    "importance_selection": sql("select count(*) as n_all, count(*) filter (r <= 2 and importance >= 0.01) as n_selected, round(100 * (1 - count(*) filter (r <= 2 and importance >= 0.01) / count(*)), 6) as reduction_percent from (select *, row_number() over (order by importance desc, feature) as r from imp where model = 'label')", CLASSES, FORECASTS, _IMPORTANCE),
    "importance_summary": sql("select count(*) as n_features, round(avg(importance), 6) as mean, round(stddev_pop(importance), 6) as std, round(max(importance), 6) as max from imp", CLASSES, FORECASTS, _IMPORTANCE),
    "holt_winters": _REC(
        "select product, last_day((date_trunc('month', hi) + to_months(h::int))::date) as month_end, round(level + h * trend + season[(t + h - 1) % cycle + 1] + 1e-7, 4) as holt_winters from (from run qualify t = max(t) over (partition by product)) join series using (product), generate_series(1, 6) s(h)",
        "series as (select product, hi, n, ys, cycle, list_sum(ys[1:cycle]) / cycle as level0, case when n >= 2 * cycle then (list_sum(ys[cycle + 1:2 * cycle]) - list_sum(ys[1:cycle])) / (cycle * cycle) else 0.0 end as trend0 from (select product, max(month_end) as hi, count(*) as n, list(quantity order by month_end) as ys, case when count(*) >= 24 then 12 else 1 end as cycle from panel group by 1))",
        "run as (select product, 0::bigint as t, level0::double as level, trend0::double as trend, case when cycle > 1 then list_transform(ys[1:cycle], lambda y: y - level0) else [0.0::double] end as season from series union all select product, t + 1, now, 0.05::double * (now - level) + 0.95::double * trend, case when cycle > 1 then season[1:t % cycle] || [0.2::double * (y - now) + 0.8::double * own] || season[t % cycle + 2:cycle] else season end from (select *, 0.3::double * (y - own) + 0.7::double * (level + trend) as now from (select r.*, s.cycle, s.ys[r.t + 1] as y, r.season[r.t % s.cycle + 1] as own from run r join series s using (product) where r.t < s.n)))",
    ),
    "intervals_bootstrap": sql(
        f"select product, month_end, round(lo, 4) as lower_bound, round(hi, 4) as upper_bound, {_ROUND('interval_width', 'relative_uncertainty')} from scored",
        CLASSES, FORECASTS, _PARTS,
        "pool as (select row_number() over (order by label - pred_ma4) - 1 as at, label - pred_ma4 as r from train)",
        "draws as (select product, month_end, ('0x' || substr(d, (8 * j + 1)::int, 8))::bigint as u, i, j from (select product, month_end, i, md5(concat_ws('|', '1', i, product, month_end)) as d from test, generate_series(1, 25) g(i)), generate_series(0, 3) k(j))",
        "ends as (select product, month_end, floor(us[3] / 4294967296.0::double * (select count(*) from pool))::bigint as a, floor(us[98] / 4294967296.0::double * (select count(*) from pool))::bigint as b from (select product, month_end, list_sort(list(u)) as us from draws group by 1, 2))",
        f"spans as (select test.*, pred_ma4 as p, greatest(pred_ma4 + x.r, 0) as lo, pred_ma4 + y.r as hi from test join ends using (product, month_end) join pool x on x.at = a join pool y on y.at = b), {_WIDTH}",
    ),
    "series_rows": sql("select product as unique_id, month_end as ds, quantity as y from gaps where quantity is not null"),
    "croston": _REC(
        "select product, round(coalesce(size / gap, 0.0) + 1e-7, 4) as croston from run qualify n = max(n) over (partition by product)",
        "numbered as (select *, row_number() over (partition by product order by month_end) as n from panel)",
        "run as (select product, n, case when quantity > 0 then quantity end as size, case when quantity > 0 then 1.0::double end as gap, case when quantity > 0 then 1.0::double else 2.0::double end as since from numbered where n = 1 union all select v.product, v.n, case when v.quantity > 0 then case when r.size is null then v.quantity else r.size + 0.1::double * (v.quantity - r.size) end else r.size end, case when v.quantity > 0 then case when r.gap is null then r.since else r.gap + 0.1::double * (r.since - r.gap) end else r.gap end, case when v.quantity > 0 then 1.0::double else r.since + 1 end from run r join numbered v on v.product = r.product and v.n = r.n + 1)",
    ),
    "seasonal_smoothing": _REC("select product, position::int as position, alpha, round(level + 1e-7, 4) as level from best", _SMOOTH("")),
    "seasonal_accuracy": _REC(
        "select 'seasonal' as model, round(sqrt(avg((q - level) * (q - level))), 4) as rmse, round(avg(abs(q - level)), 4) as mae from (select p.quantity as q, best.level from lasts join generate_series(1, 12) s(h) on true join panel p on p.product = lasts.product and p.month_end = last_day((date_trunc('month', lasts.hi) + to_months(h::int))::date) join best on best.product = lasts.product and best.position = (lasts.n + h - 1) % 12)",
        _SMOOTH("and month_end < date '2001-01-01'"), "lasts as (select product, max(month_end) as hi, count(*) as n from dense group by 1)",
    ),
    "next_month_forecast": sql("select product, last_day((date_trunc('month', max(month_end)) + interval 1 month)::date) as month_end, 1::int as h from panel group by 1"),
}
