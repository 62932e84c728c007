"""Queries over the test tables."""

from panelcast.catalog import calendar_queries, model_queries, series_queries, source_queries, store_queries
from panelcast.catalog.registry import ENTRIES

__all__ = ["ENTRIES", "calendar_queries", "model_queries", "series_queries", "source_queries", "store_queries"]
