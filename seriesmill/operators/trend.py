"""Trend, life-cycle and change-point features of series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import change, sign_of
from ..spec import PanelSpec


def trend_features(panel: DataFrame, spec: PanelSpec = PanelSpec(), periods: Sequence[int] = (3, 6, 12), slope: str = "difference") -> DataFrame:
    """Growth, momentum, trend strength, position and direction. ``slope="ols"`` fits a line to the last rows instead of taking the difference."""
    w, v = spec.w, spec.v
    first = {"time_index": F.row_number().over(w)}
    for p in periods:
        first[f"growth_rate_{p}m"] = change(v, F.lag(spec.value, p).over(w))
    out = panel.withColumns(first)
    more = {}
    for p in periods:
        growth = F.col(f"growth_rate_{p}m")
        more[f"momentum_{p}m"] = growth - F.lag(growth).over(w)
        fit = F.regr_slope(v, F.col("time_index")).over(w.rowsBetween(-p, 0))
        more[f"trend_strength_{p}m"] = (v - F.lag(spec.value, p).over(w)) / p if slope == "difference" else fit
    more["cumulative_demand"] = F.sum(v).over(spec.so_far)
    more["relative_position"] = F.col("time_index") / F.count("*").over(spec.whole)
    more["velocity_1m"] = v - F.lag(spec.value).over(w)
    out = out.withColumns(more)
    least = min(periods)
    return out.withColumns({"acceleration": F.col(f"momentum_{least}m"), "trend_direction": sign_of(F.col(f"trend_strength_{least}m"))})


def detrended(panel: DataFrame, spec: PanelSpec = PanelSpec(), windows: Sequence[int] = (3, 6, 12)) -> DataFrame:
    """Centred moving averages, what is left without them, and the ratio to them (1.0 where the average is 0)."""
    out = panel.withColumns({f"trend_{n}m": F.avg(spec.v).over(spec.w.rowsBetween(-(n // 2), n // 2)) for n in windows})
    more = {}
    for n in windows:
        trend = F.col(f"trend_{n}m")
        more[f"detrended_{n}m"] = spec.v - trend
        more[f"detrended_ratio_{n}m"] = F.when(trend == 0, 1.0).otherwise(F.try_divide(spec.v, trend))
    return out.withColumns(more)


def lifecycle(panel: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """lifecycle_stage by the row's place in its series and the means of the series' first quarter, middle and last quarter; lifecycle_growth."""
    out = panel.withColumn("_at", F.row_number().over(spec.w) / F.count("*").over(spec.whole))
    at = F.col("_at")
    mean = lambda part: F.avg(F.when(part, spec.v)).over(spec.whole)
    out = out.withColumns({"_early": mean(at <= 0.25), "_mid": mean((at > 0.25) & (at <= 0.75)), "_late": mean(at > 0.75)})
    early, mid, late = (F.col(f"_{x}") for x in ("early", "mid", "late"))
    stage = (
        F.when(at <= 0.25, "Introduction").when((mid > 1.2 * early) & (at <= 0.5), "Growth").when((at > 0.75) & (late < 0.8 * mid), "Decline").otherwise("Maturity")
    )
    growth = F.try_divide(late - early, F.coalesce(early, F.lit(1.0)))
    return out.withColumns({"lifecycle_stage": stage, "lifecycle_growth": growth}).drop("_at", "_early", "_mid", "_late")


def change_points(panel: DataFrame, spec: PanelSpec = PanelSpec(), threshold: float = 0.5) -> DataFrame:
    """change_magnitude, is_change_point, periods_since_change (rows since the last one) and stable_rows (rows so far that are none)."""
    magnitude = F.abs(change(spec.v, F.lag(spec.value).over(spec.w)))
    out = panel.withColumns({"change_magnitude": magnitude, "_row": F.row_number().over(spec.w)})
    out = out.withColumn("is_change_point", F.when(F.col("change_magnitude") > threshold, 1).otherwise(0))
    hit = F.col("is_change_point") == 1
    return out.withColumns({
        "periods_since_change": F.col("_row") - F.last(F.when(hit, F.col("_row")), True).over(spec.so_far),
        "stable_rows": F.col("_row") - F.sum("is_change_point").over(spec.so_far),
    }).drop("_row")
