"""Scoring: the latest month or all history, by every class's champion and challenger."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame

from ..sources.tables import stored
from ..spec import PanelSpec
from .metrics import evaluate
from .models import score
from .panel import add_features, latest_month, long_enough, monthly_rollup
from .reports import tag_champions


def run(daily: DataFrame, models: dict[tuple[str, str], PipelineModel], metrics: DataFrame, product: str, date: str, quantity: str, full_history: bool = False, as_of: Column | None = None) -> DataFrame:
    """(product, month_end, label, prediction, SalesPattern, Model, is_champion) from daily sales."""
    panel = long_enough(add_features(stored(monthly_rollup(daily, product, date, quantity), "months"), as_of=as_of), 6)
    return tag_champions(score(models, panel if full_history else latest_month(panel)), metrics)


def validation_metrics(models: dict[tuple[str, str], PipelineModel], validation: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """(category, model, rmse, r2, mae, mape) of every model on its class's rows."""
    rows = score(models, validation, (spec.product, spec.date))
    return evaluate(rows, by=["SalesPattern", "Model"]).withColumnsRenamed({"SalesPattern": "category", "Model": "model"})
