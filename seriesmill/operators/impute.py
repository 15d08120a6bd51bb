"""Imputation of missing values within series. Known values never change."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import PanelSpec


@dataclass(frozen=True)
class Imputer:
    """Fills nulls by a strategy; what the strategy leaves open gets ``fill_value``."""

    strategy: str = "forward_fill"
    decay_rate: float = 0.95
    seasonal_lag: int = 12
    fill_value: float = 0.0
    interpolation: str = "linear"

    def filled(self, spec: PanelSpec) -> Column:
        how: dict[str, Callable[[PanelSpec], Column]] = {
            "zero": lambda s: F.lit(None).cast("double"),
            "mean": lambda s: F.avg(s.v).over(s.whole),
            "forward_fill": self.before,
            "backward_fill": self.after,
            "forward_fill_decay": self.decayed,
            "seasonal": lambda s: F.coalesce(F.lag(s.value, self.seasonal_lag).over(s.w), self.before(s)),
            "interpolate": self.between,
        }
        if self.strategy not in how:
            raise ValueError(f"no strategy {self.strategy!r}; there are {', '.join(how)}")
        return F.coalesce(spec.v, how[self.strategy](spec), F.lit(self.fill_value))

    @staticmethod
    def before(spec: PanelSpec) -> Column:
        return F.last(spec.value, True).over(spec.so_far)

    @staticmethod
    def after(spec: PanelSpec) -> Column:
        return F.first(spec.value, True).over(spec.from_here)

    def decayed(self, spec: PanelSpec) -> Column:
        known = F.when(spec.v.isNotNull(), F.col("_row"))
        return self.before(spec) * F.pow(F.lit(self.decay_rate), F.col("_row") - F.last(known, True).over(spec.so_far))

    def between(self, spec: PanelSpec) -> Column:
        known = F.when(spec.v.isNotNull(), F.col("_row"))
        left, right = self.before(spec), self.after(spec)
        if self.interpolation == "midpoint":
            inner = (left + right) / 2
        else:
            at, end = F.last(known, True).over(spec.so_far), F.first(known, True).over(spec.from_here)
            inner = left + (right - left) * F.try_divide(F.col("_row") - at, end - at)
        return F.coalesce(inner, left, right)

    def impute(self, panel: DataFrame, spec: PanelSpec = PanelSpec(), output: str | None = None) -> DataFrame:
        rows = panel.withColumn("_row", F.row_number().over(spec.w)) if self.strategy in ("forward_fill_decay", "interpolate") else panel
        return rows.withColumn(output or spec.value, self.filled(spec)).drop("_row")


def chosen_strategy(nulls: Column, zeros: Column) -> Column:
    """The strategy for a share of nulls and of zeros among all rows."""
    return (
        F.when(nulls < 0.01, "zero").when(nulls < 0.05, "forward_fill").when(zeros > 0.3, "zero").when(nulls < 0.2, "forward_fill_decay").otherwise("seasonal")
    )


def auto_strategy(panel: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """One row: null_rate, zero_rate and the strategy they call for."""
    n = F.count("*")
    rates = panel.agg((F.count_if(spec.v.isNull()) / n).alias("null_rate"), (F.count_if(spec.v == 0) / n).alias("zero_rate"))
    return rates.withColumn("strategy", chosen_strategy(F.col("null_rate"), F.col("zero_rate")))


def auto_impute(panel: DataFrame, spec: PanelSpec = PanelSpec(), output: str | None = None, **parameters) -> DataFrame:
    """``panel`` imputed by the strategy that its rates call for; the choice is part of the plan, so nothing runs yet."""
    rows = panel.withColumn("_row", F.row_number().over(spec.w)).crossJoin(F.broadcast(auto_strategy(panel, spec).select("strategy")))
    names = ("zero", "forward_fill", "forward_fill_decay", "seasonal")
    filled = F.coalesce(*[F.when(F.col("strategy") == s, Imputer(s, **parameters).filled(spec)) for s in names])
    return rows.withColumn(output or spec.value, filled).drop("_row", "strategy")


def audit(before: DataFrame, after: DataFrame, value: str) -> DataFrame:
    """One row: nulls before and after."""
    count = lambda df, name: df.agg(F.count_if(F.col(value).isNull()).alias(name))
    return count(before, "nulls_before").crossJoin(count(after, "nulls_after"))
