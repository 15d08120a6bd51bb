"""Queries of imputation, trend, smoothing and interaction features."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import ewma as E
from ..operators import impute as I
from ..operators import interact as N
from ..operators import panel as P
from ..operators import trend as T
from ..spec import PanelSpec
from . import fixtures as X
from .fixtures import CLASSES, sql

W = "window w as (partition by product order by month_end)"
KEYS = ("product", "month_end")


def imputed(spark: SparkSession, sf_dir: str, strategy: str, **parameters) -> DataFrame:
    out = I.Imputer(strategy, **parameters).impute(X.few_nulls(spark, sf_dir))
    return out.select(*KEYS, F.round("quantity", 6).alias("quantity"))


def impute_auto_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strategy for each share of missing values."""
    out = None
    for m in (200, 29, 17, 5):
        row = I.auto_strategy(X.few_nulls_dense(spark, sf_dir, m)).select(F.lit(m).alias("modulus"), *rounded(["null_rate", "zero_rate"]), "strategy")
        out = row if out is None else out.unionByName(row)
    return out


def impute_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.auto_impute(X.few_nulls_dense(spark, sf_dir)).select(*KEYS, F.round("quantity", 6).alias("quantity"))


def impute_auto_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All series: most months have no sales, so missing ones count as zero."""
    return I.auto_impute(X.few_nulls(spark, sf_dir)).select(*KEYS, F.round("quantity", 6).alias("quantity"))


def impute_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = X.few_nulls(spark, sf_dir)
    return I.audit(before, I.Imputer("backward_fill").impute(before), "quantity")


def trend_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = T.trend_features(X.panel(spark, sf_dir))
    kept = [c for c in out.columns if c.startswith(("growth", "momentum", "trend_strength"))]
    return out.select(*KEYS, "time_index", "cumulative_demand", "velocity_1m", "trend_direction", *rounded([*kept, "acceleration", "relative_position"]))


def trend_slope_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = T.trend_features(X.panel(spark, sf_dir), periods=(6,), slope="ols")
    return out.where("time_index > 1").select(*KEYS, F.round("trend_strength_6m", 6).alias("trend_strength_6m"))


def detrended(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = T.detrended(X.panel(spark, sf_dir))
    return out.select(*KEYS, *rounded([c for c in out.columns if "trend" in c]))


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.lifecycle(X.panel(spark, sf_dir)).select(*KEYS, "lifecycle_stage", F.round("lifecycle_growth", 6).alias("lifecycle_growth"))


def change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = T.change_points(X.panel(spark, sf_dir))
    return out.select(*KEYS, F.round("change_magnitude", 6).alias("change_magnitude"), "is_change_point", "periods_since_change", "stable_rows")


def nudged(columns) -> list[Column]:
    """Rounded to 4 digits a little off the halves, on which two engines' decimals may fall to either side."""
    return [F.round(F.col(c) + 1e-7, 4).alias(c) for c in columns]


def ewma_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.ewma(X.panel(spark, sf_dir)).select(*KEYS, *nudged([f"ewma_{n}" for n in (10, 30, 50, 70, 90)]))


def ewma_long_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as one long series for each type, smoothed in pieces."""
    events = X.table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    out = E.ewma(events, PanelSpec("event_type", "ts", "value"), (0.1, 0.5), long_series=True)
    return out.select("event_id", *nudged(["ewma_10", "ewma_50"]))


def ewma_two_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.ewma(X.panel(spark, sf_dir), mode="two_term").select(*KEYS, *nudged([f"ewma_{n}" for n in (10, 30, 50, 70, 90)]))


def ewm_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.ewm_volatility(X.panel(spark, sf_dir)).select(*KEYS, *nudged(["ewm_volatility_30", "ewm_volatility_50"]))


def ewma_crossover(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.ewma_crossover(X.panel(spark, sf_dir))
    return out.select(*KEYS, *nudged(["ewma_momentum", "ewma_signal", "ewma_divergence"]), "ewma_momentum_direction")


def ewma_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.ewma_ratios(X.panel(spark, sf_dir))
    return out.select(*KEYS, *nudged(["value_to_ewma_ratio", "ewma_growth_rate"]))


def adaptive_ewma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.adaptive_ewma(X.panel(spark, sf_dir)).select(*KEYS, "adaptive_alpha_value", *nudged(["adaptive_ewma"]))


def _feature_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.class_statistics(P.lags(P.calendar(X.panel(spark, sf_dir)), steps=(1, 2, 3, 12), lead=None))
    out = T.trend_features(N.rolling_spread(out), periods=(3,)).drop("momentum_3m", "acceleration")
    return N.seasonal_angles(out)


PAIRS = ("lag_1_x_month_sin", "lag_2_x_month_cos", "lag_1_x_lag_2", "lag_1_x_lag_12", "rolling_std_3_x_trend_strength_3m", "ma_3_month_x_month_sin", "cov_quantity_x_avg_demand_interval")


def interaction_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.pair_products(_feature_panel(spark, sf_dir)).select(*KEYS, *rounded(["month_sin", "month_cos", *PAIRS], 4))


def interaction_powers_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = N.ratios(N.powers(P.lags(X.panel(spark, sf_dir)), ["lag_1", "quantity"], 3), ["quantity"], ["lag_1", "lag_2"])
    return out.select(*KEYS, "lag_1_pow2", "lag_1_pow3", "quantity_pow2", "quantity_pow3", *rounded(["quantity_over_lag_1", "quantity_over_lag_2"]))


CLASSED = tuple(f"{c}_{k}" for c in ("lag_1", "ma_3_month") for k in ("Smooth", "Erratic", "Intermittent", "Lumpy"))


def interaction_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = N.all_interactions(_feature_panel(spark, sf_dir))
    return out.select(*KEYS, "value_x_time_index", "lag1_x_time", "lag_1_x_lag_2", "lag_2_x_lag_3", "lag1_x_lag12", "lag_3_pow2", *rounded(["season_x_trend", "volatility_x_time", *CLASSED], 4))


STRATEGIES = {
    "impute_zero": ("zero", {}), "impute_mean": ("mean", {}), "impute_forward_fill": ("forward_fill", {}), "impute_backward_fill": ("backward_fill", {}),
    "impute_forward_fill_decay": ("forward_fill_decay", {}), "impute_seasonal": ("seasonal", {}), "impute_linear": ("interpolate", {}), "impute_midpoint": ("interpolate", {"interpolation": "midpoint"}),
}

QUERIES = {name: partial(imputed, strategy=s, **p) for name, (s, p) in STRATEGIES.items()} | {f.__name__: f for f in (
    impute_auto_strategy, impute_auto, impute_auto_sparse, impute_audit, trend_features, trend_slope_ols, detrended, lifecycle, change_points,
    ewma_recursive, ewma_long_events, ewma_two_term, ewm_volatility, ewma_crossover, ewma_ratios, adaptive_ewma, interaction_pairs, interaction_powers_ratios, interaction_all,
)}

_BEFORE = "last_value(quantity ignore nulls) over (w rows unbounded preceding)"
_AFTER = "first_value(quantity ignore nulls) over (w rows between current row and unbounded following)"
_N = "case when quantity is not null then n end"
_AT = f"last_value({_N} ignore nulls) over (w rows unbounded preceding)"
_TO = f"first_value({_N} ignore nulls) over (w rows between current row and unbounded following)"
_NUMBERED = "numbered as (select *, row_number() over (partition by product order by month_end) as n from few)"


def _imputed(filled: str) -> str:
    return sql(f"select product, month_end, round(coalesce(quantity, {filled}, 0.0), 6) as quantity from numbered {W}", _NUMBERED)


_DECAY = f"{_BEFORE} * pow(0.95, n - {_AT})"
_FOLDED = lambda first, step, out, source="panel": sql(
    f"select product, month_end, {out} from run",
    f"numbered as (select *, row_number() over (partition by product order by month_end) as n from {source}), run as (select product, month_end, n, quantity, {first} from numbered where n = 1 union all select v.product, v.month_end, v.n, v.quantity, {step} from run r join numbered v on v.product = r.product and v.n = r.n + 1)",
).replace("with ", "with recursive ", 1)
_ALPHAS = {10: 0.1, 30: 0.3, 50: 0.5, 70: 0.7, 90: 0.9}
_GROWTH = lambda p: f"(quantity - lag(quantity, {p}) over w) / nullif(lag(quantity, {p}) over w, 0)"
_FEATURES = f"""
f as (
  select product, month_end, quantity, product_category, cov_quantity, avg_demand_interval, sin(month(month_end) * 2 * pi() / 12) as month_sin, cos(month(month_end) * 2 * pi() / 12) as month_cos,
    {', '.join(f'lag(quantity, {n}) over w as lag_{n}' for n in (1, 2, 3, 12))}, row_number() over w as t, (quantity - lag(quantity, 3) over w) / 3 as trend_strength_3m,
    stddev_samp(quantity) over (w rows 2 preceding) as rolling_std_3, avg(quantity) over (w rows 2 preceding) as ma_3_month
  from panel join classed using (product) {W})
"""
_POS = "(row_number() over w) / (count(*) over (partition by product))"

ORACLE_SQL = {
    "impute_zero": _imputed("0.0"),
    "impute_mean": _imputed("avg(quantity) over (partition by product)"),
    "impute_forward_fill": _imputed(_BEFORE),
    "impute_backward_fill": _imputed(_AFTER),
    "impute_forward_fill_decay": _imputed(_DECAY),
    "impute_seasonal": _imputed(f"lag(quantity, 12) over w, {_BEFORE}"),
    "impute_linear": _imputed(f"{_BEFORE} + ({_AFTER} - {_BEFORE}) * (n - {_AT}) / nullif({_TO} - {_AT}, 0), {_BEFORE}, {_AFTER}"),
    "impute_midpoint": _imputed(f"({_BEFORE} + {_AFTER}) / 2, {_BEFORE}, {_AFTER}"),
    "impute_auto_strategy": sql(
        "select modulus, round(nulls, 6) as null_rate, round(zeros, 6) as zero_rate, case when nulls < 0.01 then 'zero' when nulls < 0.05 then 'forward_fill' when zeros > 0.3 then 'zero' when nulls < 0.2 then 'forward_fill_decay' else 'seasonal' end as strategy from r",
        "r as (select modulus, count(*) filter (gone) / count(*) as nulls, count(*) filter (not gone and quantity = 0) / count(*) as zeros from (select modulus, quantity, (cast(product[2:] as bigint) * 7 + month(month_end)) % modulus = 0 as gone from panel, (values (200), (29), (17), (5)) v(modulus) where product like 'S%') group by 1)",
    ),
    "impute_auto": _imputed(_DECAY).replace("from few)", "from few_dense)"),
    "impute_auto_sparse": _imputed("0.0"),
    "impute_audit": sql("select count(*) filter (quantity is null) as nulls_before, 0::bigint as nulls_after from few"),
    "trend_features": sql(
        "select product, month_end, t as time_index, cumulative_demand, velocity_1m, (case when s3 > 0 then 1 when s3 < 0 then -1 else 0 end)::int as trend_direction, "
        + ", ".join(f"round(g{p}, 6) as growth_rate_{p}m, round(g{p} - lag(g{p}) over w, 6) as momentum_{p}m, round(s{p}, 6) as trend_strength_{p}m" for p in (3, 6, 12))
        + f", round(g3 - lag(g3) over w, 6) as acceleration, round(pos, 6) as relative_position from g {W}",
        "g as (select product, month_end, (row_number() over w)::int as t, sum(quantity) over w as cumulative_demand, quantity - lag(quantity) over w as velocity_1m, " + f"{_POS} as pos, "
        + ", ".join(f"{_GROWTH(p)} as g{p}, (quantity - lag(quantity, {p}) over w) / {p} as s{p}" for p in (3, 6, 12)) + f" from panel {W})",
    ),
    "trend_slope_ols": sql(f"select product, month_end, round(s, 6) as trend_strength_6m from (select product, month_end, t, regr_slope(quantity, t) over (w rows 6 preceding) as s from (select *, row_number() over (partition by product order by month_end) as t from panel) {W}) where t > 1"),
    "detrended": sql(
        "select product, month_end, " + ", ".join(f"round(t{n}, 6) as trend_{n}m, round(quantity - t{n}, 6) as detrended_{n}m, round(case when t{n} = 0 then 1.0 else quantity / nullif(t{n}, 0) end, 6) as detrended_ratio_{n}m" for n in (3, 6, 12)) + " from t",
        "t as (select *, " + ", ".join(f"avg(quantity) over (w rows between {n // 2} preceding and {n // 2} following) as t{n}" for n in (3, 6, 12)) + f" from panel {W})",
    ),
    "lifecycle": sql(
        "select product, month_end, case when place <= 0.25 then 'Introduction' when mid > 1.2 * early and place <= 0.5 then 'Growth' when place > 0.75 and late < 0.8 * mid then 'Decline' else 'Maturity' end as lifecycle_stage, round((late - early) / nullif(coalesce(early, 1.0), 0), 6) as lifecycle_growth from m",
        f"a as (select *, {_POS} as place from panel {W}), m as (select *, avg(quantity) filter (place <= 0.25) over p as early, avg(quantity) filter (place > 0.25 and place <= 0.75) over p as mid, avg(quantity) filter (place > 0.75) over p as late from a window p as (partition by product))",
    ),
    "change_points": sql(
        f"select product, month_end, round(m, 6) as change_magnitude, hit as is_change_point, (n - last_value(case when hit = 1 then n end ignore nulls) over (w rows unbounded preceding))::int as periods_since_change, (n - sum(hit) over w)::bigint as stable_rows from h {W}",
        f"c as (select product, month_end, row_number() over w as n, abs((quantity - lag(quantity) over w) / nullif(lag(quantity) over w, 0)) as m from panel {W}), h as (select *, (case when m > 0.5 then 1 else 0 end)::int as hit from c)",
    ),
    "ewma_recursive": _FOLDED(", ".join(f"quantity as e{n}" for n in _ALPHAS), ", ".join(f"{a}::double * v.quantity + (1 - {a}::double) * r.e{n}" for n, a in _ALPHAS.items()), ", ".join(f"round(e{n} + 1e-7, 4) as ewma_{n}" for n in _ALPHAS)),
    "ewma_long_events": """
        with recursive numbered as (select event_type, event_id, value, row_number() over (partition by event_type order by ts, value) as n from events),
        run as (
          select event_type, event_id, n, value as e10, value as e50 from numbered where n = 1
          union all select v.event_type, v.event_id, v.n, 0.1::double * v.value + 0.9::double * r.e10, 0.5::double * v.value + 0.5::double * r.e50
          from run r join numbered v on v.event_type = r.event_type and v.n = r.n + 1)
        select event_id, round(e10 + 1e-7, 4) as ewma_10, round(e50 + 1e-7, 4) as ewma_50 from run
    """,
    "ewma_two_term": sql("select product, month_end, " + ", ".join(f"round(coalesce({a}::double * quantity + (1 - {a}::double) * lag(quantity) over w, quantity) + 1e-7, 4) as ewma_{n}" for n, a in _ALPHAS.items()) + f" from panel {W}"),
    "ewm_volatility": _FOLDED(
        "quantity as m30, 0.0::double as v30, quantity as m50, 0.0::double as v50",
        ", ".join(f"{a}::double * v.quantity + (1 - {a}::double) * r.m{n}, {a}::double * pow(v.quantity - ({a}::double * v.quantity + (1 - {a}::double) * r.m{n}), 2) + (1 - {a}::double) * r.v{n}" for n, a in ((30, 0.3), (50, 0.5))),
        "round(sqrt(v30) + 1e-7, 4) as ewm_volatility_30, round(sqrt(v50) + 1e-7, 4) as ewm_volatility_50",
    ),
    "ewma_crossover": _FOLDED(
        "quantity as f, quantity as s, 0.0::double as g",
        "0.7::double * v.quantity + (1 - 0.7::double) * r.f, 0.3::double * v.quantity + (1 - 0.3::double) * r.s, 0.5::double * ((0.7::double * v.quantity + (1 - 0.7::double) * r.f) - (0.3::double * v.quantity + (1 - 0.3::double) * r.s)) + (1 - 0.5::double) * r.g",
        "round(f - s + 1e-7, 4) + 0.0 as ewma_momentum, round(g + 1e-7, 4) + 0.0 as ewma_signal, round(f - s - g + 1e-7, 4) + 0.0 as ewma_divergence, (case when f - s > 0 then 1 when f - s < 0 then -1 else 0 end)::int as ewma_momentum_direction",
        "(from panel)",
    ),
    "ewma_ratios": _FOLDED(
        "quantity as e", "0.3::double * v.quantity + (1 - 0.3::double) * r.e",
        "round(case when e = 0 then 1.0 else quantity / nullif(e, 0) end + 1e-7, 4) + 0.0 as value_to_ewma_ratio, round((e - lag(e) over (partition by product order by n)) / nullif(lag(e) over (partition by product order by n), 0) + 1e-7, 4) + 0.0 as ewma_growth_rate",
        "(from panel)",
    ),
    "adaptive_ewma": _FOLDED(
        "alpha, quantity as e", "v.alpha, v.alpha * v.quantity + (1 - v.alpha) * r.e", "alpha as adaptive_alpha_value, round(e + 1e-7, 4) as adaptive_ewma",
        f"(select product, month_end, quantity, (case when cv < 0.2 then 0.3 when cv < 0.5 then 0.5 when cv < 1.0 then 0.7 else 0.9 end)::double as alpha from (select *, case when m = 0 then 0.5 else sqrt(avg(dev) over (w rows 5 preceding)) / m end as cv from (select *, pow(quantity - m, 2) as dev from (select *, avg(quantity) over (w rows 5 preceding) as m from panel {W})) {W}))",
    ),
    "interaction_pairs": sql(
        "select product, month_end, round(month_sin, 4) + 0.0 as month_sin, round(month_cos, 4) + 0.0 as month_cos, "
        + ", ".join(f"round({a} * {b}, 4) + 0.0 as {a}_x_{b}" for a, b in (p.split("_x_") for p in PAIRS)) + " from f",
        CLASSES, _FEATURES,
    ),
    "interaction_powers_ratios": sql(f"select product, month_end, pow(l1, 2) as lag_1_pow2, pow(l1, 3) as lag_1_pow3, pow(quantity, 2) as quantity_pow2, pow(quantity, 3) as quantity_pow3, case when l1 <> 0 then round(quantity / l1, 6) else 0.0 end as quantity_over_lag_1, case when l2 <> 0 then round(quantity / l2, 6) else 0.0 end as quantity_over_lag_2 from (select *, lag(quantity) over w as l1, lag(quantity, 2) over w as l2 from panel {W})"),
    "interaction_all": sql(
        "select product, month_end, quantity * t as value_x_time_index, lag_1 * t as lag1_x_time, lag_1 * lag_2 as lag_1_x_lag_2, lag_2 * lag_3 as lag_2_x_lag_3, lag_1 * lag_12 as lag1_x_lag12, pow(lag_3, 2) as lag_3_pow2, round(month_sin * trend_strength_3m, 4) as season_x_trend, round(rolling_std_3 * t, 4) as volatility_x_time, "
        + ", ".join(f"case when product_category = '{k}' then round({c}, 4) else 0.0 end as {c}_{k}" for c in ("lag_1", "ma_3_month") for k in ("Smooth", "Erratic", "Intermittent", "Lumpy")) + " from f",
        CLASSES, _FEATURES,
    ),
}
