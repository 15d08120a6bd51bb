"""Per-series statistical forecasts as Spark jobs: a group per series, never a frame on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_large
from ..spec import PanelSpec
from .metrics import evaluate_each

ALPHA_GRID = tuple(k / 10 for k in range(1, 10))


def series_rows(panel: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """(unique_id, ds, y) without nulls."""
    return panel.select(F.col(spec.product).cast("string").alias("unique_id"), spec.d.cast("date").alias("ds"), spec.v.cast("float").alias("y")).na.drop()


def _values(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """(product, last date, ordered values): one series per row."""
    rows = F.array_sort(F.collect_list(F.struct(spec.d.alias("d"), spec.v.cast("double").alias("v"))))
    return panel.where(spec.v.isNotNull()).groupBy(spec.product).agg(F.max(spec.date).alias("last"), F.transform(rows, lambda x: x["v"]).alias("ys"))


def croston(panel: DataFrame, spec: PanelSpec = PanelSpec(), alpha: float = 0.1) -> DataFrame:
    """(product, last, croston): smoothed size of sales over the smoothed interval between them (Croston, 1972).

    The first interval counts from the series' start. A series without sales is forecast 0.
    """
    zero = F.struct(F.lit(None).cast("double").alias("size"), F.lit(None).cast("double").alias("gap"), F.lit(1.0).alias("since"))

    def step(s: Column, y: Column) -> Column:
        size = F.when(s["size"].isNull(), y).otherwise(s["size"] + alpha * (y - s["size"]))
        gap = F.when(s["gap"].isNull(), s["since"]).otherwise(s["gap"] + alpha * (s["since"] - s["gap"]))
        sold = F.struct(size.alias("size"), gap.alias("gap"), F.lit(1.0).alias("since"))
        return F.when(y > 0, sold).otherwise(F.struct(s["size"].alias("size"), s["gap"].alias("gap"), (s["since"] + 1).alias("since")))

    end = F.aggregate("ys", zero, step)
    return _values(panel, spec).select(spec.product, "last", F.coalesce(F.try_divide(end["size"], end["gap"]), F.lit(0.0)).alias("croston"))


def seasonal_smoothing(panel: DataFrame, spec: PanelSpec = PanelSpec(), season: int = 12, alphas: Sequence[float] = ALPHA_GRID) -> DataFrame:
    """(product, position, alpha, level): exponential smoothing of each place of the season, with the alpha of least squared error.

    ``position`` counts rows from the series' start, modulo the season.
    """
    at = (F.row_number().over(spec.w) - 1) % season
    rows = panel.where(spec.v.isNotNull()).select(spec.product, spec.date, spec.v.cast("double").alias("v"), at.alias("position"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(spec.date, "v"))), lambda x: x["v"])
    per = rows.groupBy(spec.product, "position").agg(ordered.alias("ys"))
    start = F.struct(F.element_at("ys", 1).alias("level"), F.lit(0.0).alias("sse"))

    def step(a: float):
        return lambda s, y: F.struct((s["level"] + a * (y - s["level"])).alias("level"), (s["sse"] + (y - s["level"]) * (y - s["level"])).alias("sse"))

    tried = F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.aggregate(F.slice("ys", 2, F.greatest(F.size("ys") - 1, F.lit(0))), start, step(a)).alias("end")) for a in alphas])
    best = F.array_min(F.transform(tried, lambda x: F.struct(F.round(x["end"]["sse"], 6).alias("sse"), x["alpha"].alias("alpha"), x["end"]["level"].alias("level"))))
    return per.select(spec.product, "position", best.alias("b")).select(spec.product, "position", "b.alpha", "b.level")


def seasonal_forecast(panel: DataFrame, levels: DataFrame, horizon: int, spec: PanelSpec = PanelSpec(), season: int = 12) -> DataFrame:
    """(product, month_end, seasonal): the level of each future month's place."""
    ends = panel.where(spec.v.isNotNull()).groupBy(spec.product).agg(F.max(spec.date).alias("last"), F.count("*").alias("n"))
    ahead = future_months(ends, horizon, spec).withColumn("position", ((F.col("n") + F.col("h") - 1) % season).cast("int"))
    return ahead.join(as_large(levels), [spec.product, "position"]).select(spec.product, spec.date, F.col("level").alias("seasonal"))


def future_months(ends: DataFrame, horizon: int, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """``ends(product, last, ...)`` with a row for each of the next ``horizon`` month ends, numbered h."""
    steps = ends.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn(spec.date, F.last_day(F.add_months(F.trunc("last", "month"), F.col("h"))))


def horizon_of(test: DataFrame, spec: PanelSpec = PanelSpec()) -> int:
    """The number of distinct test months."""
    return test.select(F.countDistinct(spec.date)).first()[0]


def next_month(forecasts: DataFrame, ends: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """The forecast rows of the month after each series' last."""
    following = ends.select(spec.product, F.last_day(F.add_months(F.trunc("last", "month"), 1)).alias(spec.date))
    return forecasts.join(as_large(following), [spec.product, spec.date], "left_semi")


def holt_winters(panel: DataFrame, horizon: int, spec: PanelSpec = PanelSpec(), season: int = 12, alpha: float = 0.3, beta: float = 0.05, gamma: float = 0.2) -> DataFrame:
    """(product, month_end, holt_winters) for the next ``horizon`` months by additive Holt-Winters.

    Level, trend and season run along the series, from the means of its first two seasons; series of under two seasons have no
    season.
    """
    n = F.size("ys")
    seasonal = n >= 2 * season
    series = _values(panel, spec).withColumn("cycle", F.when(seasonal, season).otherwise(1))
    c = F.col("cycle")
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    level = total(F.slice("ys", 1, c)) / c
    trend = F.when(n >= 2 * c, (total(F.slice("ys", c + 1, c)) - total(F.slice("ys", 1, c))) / (c * c)).otherwise(0.0)
    series = series.withColumns({"level": level, "trend": trend})
    start = F.struct(F.col("level"), F.col("trend"), F.when(seasonal, F.transform(F.slice("ys", 1, c), lambda y: y - F.col("level"))).otherwise(F.array(F.lit(0.0))).alias("season"), F.lit(0).alias("t"))

    def step(s: Column, y: Column) -> Column:
        place = F.pmod(s["t"], c)
        own = F.get(s["season"], place)
        now = alpha * (y - own) + (1 - alpha) * (s["level"] + s["trend"])
        slope = beta * (now - s["level"]) + (1 - beta) * s["trend"]
        renewed = F.when(c > 1, F.transform(s["season"], lambda x, i: F.when(i == place, gamma * (y - now) + (1 - gamma) * own).otherwise(x))).otherwise(s["season"])
        return F.struct(now.alias("level"), slope.alias("trend"), renewed.alias("season"), (s["t"] + 1).alias("t"))

    ends = series.select(spec.product, "last", c, F.aggregate("ys", start, step).alias("end"))
    ahead = future_months(ends, horizon, spec)
    forecast = F.col("end.level") + F.col("h") * F.col("end.trend") + F.get("end.season", F.pmod(F.col("end.t") + F.col("h") - 1, c))
    return ahead.select(spec.product, spec.date, forecast.alias("holt_winters"))


def forecast_accuracy(forecasts: DataFrame, actual: DataFrame, columns: Sequence[str], spec: PanelSpec = PanelSpec()) -> DataFrame:
    """(model, rmse, r2, mae, mape) of each forecast column over the months that have both."""
    rows = forecasts.join(as_large(actual.select(spec.product, spec.date, spec.v.alias("label"))), [spec.product, spec.date])
    return evaluate_each(rows.na.drop(subset=list(columns)), columns)
