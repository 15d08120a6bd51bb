"""Demand-series analytics on Spark: panels, features, validation, models, intervals and reports."""

from .spec import PanelSpec

__all__ = ["PanelSpec"]
