"""Products, powers, ratios and class columns of existing features, each operator in one projection."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import CATEGORIES
from ..spec import PanelSpec


def seasonal_angles(panel: DataFrame, month: str = "month") -> DataFrame:
    turn = F.col(month).cast("double") * (2 * math.pi / 12)
    return panel.withColumns({"month_sin": F.sin(turn), "month_cos": F.cos(turn)})


def default_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    """The usual pairs, of those whose columns exist."""
    lags = [c for c in columns if c.startswith("lag_")][:3]
    pairs = [(c, s) for c in lags for s in ("month_sin", "month_cos")]
    pairs += [("lag_1", "lag_2"), ("lag_1", "lag_12"), ("rolling_std_3", "trend_strength_3m"), ("ma_3_month", "month_sin"), ("ewma_50", "growth_rate_3m"), ("cov_quantity", "avg_demand_interval")]
    return [p for p in pairs if set(p) <= set(columns)]


def pair_products(panel: DataFrame, pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    pairs = default_pairs(panel.columns) if pairs is None else [p for p in pairs if set(p) <= set(panel.columns)]
    return panel.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs})


def powers(panel: DataFrame, columns: Sequence[str], degree: int = 2) -> DataFrame:
    return panel.withColumns({f"{c}_pow{d}": F.pow(F.col(c).cast("double"), F.lit(float(d))) for c in columns for d in range(2, degree + 1)})


def ratios(panel: DataFrame, numerators: Sequence[str], denominators: Sequence[str]) -> DataFrame:
    """``n_over_d``; 0.0 where the denominator is 0 or null."""
    over = lambda n, d: F.when(F.col(d) != 0, F.try_divide(F.col(n), F.col(d))).otherwise(0.0)
    return panel.withColumns({f"{n}_over_{d}": over(n, d) for n in numerators for d in denominators if n != d})


def class_columns(panel: DataFrame, columns: Sequence[str], category: str = "product_category", labels: Sequence[str] = CATEGORIES) -> DataFrame:
    """``c_label``: the value on rows of the class, 0.0 on others. The classes are given, so no distinct job runs."""
    return panel.withColumns({f"{c}_{k}": F.when(F.col(category) == k, F.col(c)).otherwise(0.0) for c in columns for k in labels})


def time_products(panel: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Products with the time index, of the columns that exist."""
    out = panel if "time_index" in panel.columns else panel.withColumn("time_index", F.row_number().over(spec.w))
    t = F.col("time_index")
    wanted: dict[str, tuple[set[str], Column]] = {
        "value_x_time_index": ({spec.value}, spec.v * t),
        "season_x_trend": ({"month_sin", "trend_strength_3m"}, F.col("month_sin") * F.col("trend_strength_3m")),
        "lag1_x_time": ({"lag_1"}, F.col("lag_1") * t),
        "volatility_x_time": ({"rolling_std_3"}, F.col("rolling_std_3") * t),
    }
    return out.withColumns({n: c for n, (needs, c) in wanted.items() if needs <= set(out.columns)})


def lag_products(panel: DataFrame, most: int = 5) -> DataFrame:
    names = set(panel.columns)
    pairs = {f"lag_{i}_x_lag_{i + 1}": (f"lag_{i}", f"lag_{i + 1}") for i in range(1, most)} | {"lag1_x_lag12": ("lag_1", "lag_12")}
    return panel.withColumns({n: F.col(a) * F.col(b) for n, (a, b) in pairs.items() if {a, b} <= names})


def rolling_spread(panel: DataFrame, spec: PanelSpec = PanelSpec(), rows: int = 3) -> DataFrame:
    """rolling_std_n and ma_n_month, which some pairs ask for."""
    return panel.withColumns({f"rolling_std_{rows}": F.stddev_samp(spec.v).over(spec.last_rows(rows)), f"ma_{rows}_month": F.avg(spec.v).over(spec.last_rows(rows))})


def all_interactions(panel: DataFrame, spec: PanelSpec = PanelSpec(), degree: int = 2) -> DataFrame:
    out = lag_products(time_products(pair_products(panel), spec))
    out = powers(out, [c for c in ("lag_1", "lag_2", "lag_3", spec.value) if c in out.columns], degree)
    classed = [c for c in ("lag_1", "rolling_std_3", "ma_3_month") if c in out.columns]
    return class_columns(out, classed) if "product_category" in out.columns else out
