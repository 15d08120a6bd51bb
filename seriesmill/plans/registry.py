"""All queries of the library by name, and their SQL twins."""

from __future__ import annotations

from . import check_queries, feature_queries, forecast_queries, model_queries, panel_queries

PARTS = (panel_queries, feature_queries, check_queries, forecast_queries, model_queries)
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLE_SQL = {name: statement for part in PARTS for name, statement in part.ORACLE_SQL.items()}
