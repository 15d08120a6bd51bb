"""Queries of data quality, drift, splits and walk-forward validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators import splits as S
from ..spec import PanelSpec
from . import fixtures as X
from .fixtures import CLASSES, FORECASTS, sql

KEYS = ("product", "month_end")
EVENTS = PanelSpec("event_type", "day", "value")


def quality_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.missing(X.few_nulls(spark, sf_dir)).withColumn("missing_rate", F.round("missing_rate", 6))


def quality_z_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.z_outliers(X.stored_panel(spark, sf_dir)).withColumn("outlier_rate", F.round("outlier_rate", 6))


def quality_z_outliers_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.z_outliers(X.stored_panel(spark, sf_dir), by="product").withColumn("outlier_rate", F.round("outlier_rate", 6))


def quality_iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.iqr_outliers(X.mixed_months(spark, sf_dir)).withColumn("iqr_rate", F.round("iqr_rate", 6))


def quality_time_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.time_gaps(X.mixed_months(spark, sf_dir)).withColumn("gap_rate", F.round("gap_rate", 6))


def quality_event_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series of events: days further apart than one."""
    return Q.time_gaps(X.daily_events(spark, sf_dir), EVENTS, Q.Limits(gap_days=(1, 1))).withColumn("gap_rate", F.round("gap_rate", 6))


def quality_zero_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.zero_pattern(X.panel(spark, sf_dir)).withColumn("zero_rate", F.round("zero_rate", 6))


def quality_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.statistics(X.panel(spark, sf_dir), "quantity").select("n_values", "min", "max", *rounded(["mean", "stddev", "cv"]))


def quality_seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.seasonality(X.stored_panel(spark, sf_dir)).select(*rounded(["within_variance", "total_variance", "strength"], 4), "grade")


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.report(X.stored_panel(spark, sf_dir)).withColumn("value", F.round("value", 6))


def quality_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.overall(Q.report(X.stored_panel(spark, sf_dir)))


def quality_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.recommendations(Q.report(X.stored_panel(spark, sf_dir)))


def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.time_cut(X.stored_panel(spark, sf_dir))
    out = Q.drift(rows.where("is_train"), rows.where("not is_train"), "quantity")
    return out.select(*rounded(["train_mean", "test_mean", "train_std", "test_std", "mean_change", "std_change"]), "status")


def time_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.time_cut(X.stored_panel(spark, sf_dir)).groupBy("cut_date", "is_train").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))


def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = S.holdout(X.stored_panel(spark, sf_dir), share=0.3)
    count = lambda df, role: df.agg(F.lit(role).alias("role"), F.count("*").alias("n"), F.min("month_end").alias("first"), F.max("month_end").alias("last"))
    return count(early, "train").unionByName(count(late, "validation"))


FOLDS = {"n_splits": 4, "min_train": 24, "test": 6, "gap": 1}


def folds_expanding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.folds(X.panel(spark, sf_dir), **FOLDS)


def folds_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.folds(X.panel(spark, sf_dir), sliding=True, **FOLDS)


def fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = X.stored_panel(spark, sf_dir)
    return S.fold_rows(panel, S.folds(panel, **FOLDS)).groupBy("fold", "role").agg(F.count("*").alias("n"), F.countDistinct("product").alias("n_series"))


def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a plain forecast on every fold's test rows, then over folds: no fit, so no loop."""
    rows = X.forecasts(spark, sf_dir)
    test = S.fold_rows(rows, S.folds(rows, **FOLDS), keep=["label", "pred_ma4"], roles=["test"])
    scores = M.long_metrics(M.evaluate(test, prediction="pred_ma4", by=["fold"]), ["fold"])
    return S.fold_metrics(scores).select("metric", *rounded(["mean", "std"]))


def walk_forward_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.walk_forward(X.panel(spark, sf_dir), refit_every=3, horizon=2)


def walk_forward_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = X.stored_panel(spark, sf_dir)
    out = S.walk_forward_means(panel, S.walk_forward(panel))
    return M.evaluate(out, by=["step"]).select("step", *rounded(["rmse", "mae"]))


QUERIES = {f.__name__: f for f in (
    quality_missing, quality_z_outliers, quality_z_outliers_by_series, quality_iqr_outliers, quality_time_gaps, quality_event_gaps, quality_zero_pattern, quality_statistics, quality_seasonality,
    quality_report, quality_overall, quality_recommendations, drift, time_cut, holdout, folds_expanding, folds_sliding, fold_sizes, fold_metrics, walk_forward_steps, walk_forward_scores,
)}

_GAPS = lambda source, low, high, product="product", date="month_end": f"select count(d) as n_steps, count(*) filter (d > {high} or d < {low}) as n_gaps, round(coalesce(count(*) filter (d > {high} or d < {low}) / nullif(count(d), 0), 0.0), 6) as gap_rate, case when count(*) filter (d > {high} or d < {low}) > 0 then 'WARNING' else 'PASS' end as status from (select date_diff('day', lag({date}) over (partition by {product} order by {date}), {date}) as d from {source})"
_Z = lambda over: f"select count(quantity) as n_values, count(*) filter (z > 3) as n_outliers, round(count(*) filter (z > 3) / count(quantity), 6) as outlier_rate, case when count(*) filter (z > 3) / count(quantity) >= 0.05 then 'WARNING' else 'PASS' end as status from (select quantity, abs(quantity - avg(quantity) over ({over})) / nullif(stddev_samp(quantity) over ({over}), 0) as z from panel)"
_REPORT = f"""
zeros as (select count(*) filter (quantity = 0) / count(*) as zero_rate from panel),
q as (select quantile_disc(quantity, 0.25) as a, quantile_disc(quantity, 0.75) as b from panel),
seas as (select greatest(0.0, 1 - (select avg(v) from (select var_samp(quantity) as v from panel group by month(month_end))) / var_samp(quantity)) as s from panel),
report as (
  select 'missing' as "check", 'missing_rate' as metric, 0.0::double as value, 'PASS' as status
  union all select 'outliers', 'outlier_rate', outlier_rate, status from ({_Z('')})
  union all select 'iqr', 'iqr_rate', count(*) filter (quantity < a - 1.5 * (b - a) or quantity > b + 1.5 * (b - a)) / count(*), null from panel, q
  union all select 'gaps', 'gap_rate', gap_rate, status from ({_GAPS('panel', 20, 45)})
  union all select 'zeros', 'zero_rate', zero_rate, null from zeros
  union all select 'statistics', 'cv', stddev_samp(quantity) / avg(quantity), null from panel
  union all select 'seasonality', 'strength', s, null from seas)
"""
_CUT = "cut as (select quantile_disc(month_end, {p}) as c from panel)"
_DATES = "dates as (select month_end as p, row_number() over (order by month_end) - 1 as i, count(*) over () as n from (select distinct month_end from {source}))"
_FOLDS = "fold_bounds as (select fold, {a} as a, 24 + fold * step - 1 as b, 24 + fold * step + 1 as c, 24 + fold * step + 6 as d from (select greatest(1, (max(n) - 30) // 4) as step, max(n) as n from dates having max(n) >= 30), generate_series(0, 3) f(fold) where 24 + fold * step + 6 < n), folds as (select fold::int as fold, x.p as train_from, y.p as train_to, z.p as test_from, u.p as test_to from fold_bounds join dates x on x.i = a join dates y on y.i = b join dates z on z.i = c join dates u on u.i = d)"
_EXPAND, _SLIDE = _FOLDS.format(a="0"), _FOLDS.format(a="fold * step")
_METRICS = "sqrt(avg((label - p) * (label - p))) as rmse, 1 - avg((label - p) * (label - p)) / var_pop(label) as r2, avg(abs(label - p)) as mae, 100 * avg(case when label <> 0 then abs((label - p) / label) end) as mape"

ORACLE_SQL = {
    "quality_missing": sql("select count(*) as n_rows, count(*) filter (quantity is null) as n_missing, round(count(*) filter (quantity is null) / count(*), 6) as missing_rate, case when count(*) filter (quantity is null) / count(*) > 0.05 then 'WARNING' else 'PASS' end as status from few"),
    "quality_z_outliers": sql(_Z("")),
    "quality_z_outliers_by_series": sql(_Z("partition by product")),
    "quality_iqr_outliers": sql("select count(*) as n_values, any_value(a) as q1, any_value(b) as q3, count(*) filter (quantity < a - 1.5 * (b - a) or quantity > b + 1.5 * (b - a)) as n_outliers, round(count(*) filter (quantity < a - 1.5 * (b - a) or quantity > b + 1.5 * (b - a)) / count(*), 6) as iqr_rate from mixed, q", "q as (select quantile_disc(quantity, 0.25) as a, quantile_disc(quantity, 0.75) as b from mixed)"),
    "quality_time_gaps": sql(_GAPS("mixed", 20, 45)),
    "quality_event_gaps": _GAPS("(select distinct event_type, cast(ts as date) as day from events)", 1, 1, "event_type", "day"),
    "quality_zero_pattern": sql("select count(*) as n_rows, count(*) filter (quantity = 0) as n_zeros, count(*) filter (quantity = 0 and b = 0) as n_zero_pairs, round(count(*) filter (quantity = 0) / count(*), 6) as zero_rate, case when count(*) filter (quantity = 0) / count(*) < 0.1 then 'Regular' when count(*) filter (quantity = 0) / count(*) < 0.3 then 'Intermittent' when count(*) filter (quantity = 0) / count(*) < 0.5 then 'Sporadic' else 'Very Sparse' end as demand_type from (select quantity, lag(quantity) over (partition by product order by month_end) as b from panel)"),
    "quality_statistics": sql("select count(quantity) as n_values, min(quantity) as min, max(quantity) as max, round(avg(quantity), 6) as mean, round(stddev_samp(quantity), 6) as stddev, round(stddev_samp(quantity) / avg(quantity), 6) as cv from panel"),
    "quality_seasonality": sql("select round(w, 4) as within_variance, round(t, 4) as total_variance, round(greatest(0.0, 1 - w / t), 4) as strength, case when 1 - w / t > 0.4 then 'Strong' when 1 - w / t > 0.2 then 'Moderate' when 1 - w / t > 0.05 then 'Weak' else 'None' end as grade from (select avg(v) as w from (select var_samp(quantity) as v from panel group by month(month_end))), (select var_samp(quantity) as t from panel)"),
    "quality_report": sql('select "check", metric, round(value, 6) as value, status from report', _REPORT),
    "quality_overall": sql("select case when bool_or(coalesce(status = 'WARNING', false)) then 'WARNING' when bool_or(coalesce(status = 'PASS', false)) then 'PASS' else 'UNKNOWN' end as overall_status from report", _REPORT),
    "quality_recommendations": sql(
        'select "check", recommendation from (select "check", case when "check" = \'missing\' and value > 0.05 then \'Impute missing values before fitting\' when "check" = \'outliers\' and value >= 0.05 then \'Treat outliers or use robust models\' when "check" = \'gaps\' and value > 0 then \'Fill gaps between dates\' when "check" = \'zeros\' and value > 0.3 then \'Use models for intermittent demand\' when "check" = \'seasonality\' and value > 0.2 then \'Add seasonal features\' end as recommendation from report) where recommendation is not null',
        _REPORT,
    ),
    "drift": sql(
        "select round(a, 6) as train_mean, round(b, 6) as test_mean, round(c, 6) as train_std, round(d, 6) as test_std, round(abs(b - a) / abs(a), 6) as mean_change, round(abs(d - c) / abs(c), 6) as std_change, case when abs(b - a) / abs(a) > 0.3 or abs(d - c) / abs(c) > 0.3 then 'WARNING' else 'PASS' end as status from (select avg(quantity) filter (month_end < c) as a, avg(quantity) filter (month_end >= c) as b, stddev_samp(quantity) filter (month_end < c) as c, stddev_samp(quantity) filter (month_end >= c) as d from panel, cut)",
        _CUT.format(p=0.8),
    ),
    "time_cut": sql("select c as cut_date, month_end < c as is_train, count(*) as n, sum(quantity) as quantity from panel, cut group by 1, 2", _CUT.format(p=0.8)),
    "holdout": sql("select case when month_end < c then 'train' else 'validation' end as role, count(*) as n, min(month_end) as first, max(month_end) as last from panel, cut group by 1", _CUT.format(p=0.7)),
    "folds_expanding": sql("from folds", _DATES.format(source="panel"), _EXPAND),
    "folds_sliding": sql("from folds", _DATES.format(source="panel"), _SLIDE),
    "fold_sizes": sql("select fold, case when month_end <= train_to then 'train' else 'test' end as role, count(*) as n, count(distinct product) as n_series from panel join folds on month_end between train_from and train_to or month_end between test_from and test_to group by 1, 2", _DATES.format(source="panel"), _EXPAND),
    "fold_metrics": sql(
        "select metric, round(avg(value), 6) as mean, round(coalesce(stddev_samp(value), 0.0), 6) as std from (unpivot s on rmse, r2, mae, mape into name metric value value) group by 1",
        CLASSES, FORECASTS, _DATES.format(source="forecasts"), _EXPAND,
        f"s as (select fold, {_METRICS} from (select fold, label, pred_ma4 as p from forecasts join folds on month_end between test_from and test_to) group by 1)",
    ),
    "walk_forward_steps": sql("select (t.i - 25)::int as step, t.p as test_date, k.p as train_to, r.p as refit_to from dates t join dates k on k.i = t.i - 2 join dates r on r.i = 23 + (t.i - 25) - (t.i - 25) % 3 where t.i >= 25", _DATES.format(source="panel")),
    "walk_forward_scores": sql(
        "select (t.i - 24)::int as step, round(sqrt(avg((a.quantity - m.p) * (a.quantity - m.p))), 6) as rmse, round(avg(abs(a.quantity - m.p)), 6) as mae from dates t join dates k on k.i = t.i - 1 join means m on m.month_end = k.p join panel a on a.product = m.product and a.month_end = t.p where t.i >= 24 group by 1",
        _DATES.format(source="panel"),
        "means as (select product, month_end, avg(quantity) over (partition by product order by month_end rows 3 preceding) as p from panel)",
    ),
}
