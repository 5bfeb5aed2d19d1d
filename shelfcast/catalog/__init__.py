"""Every operator as a runnable query on the given tables, with reference SQL."""

from __future__ import annotations


def _load():
    from shelfcast.catalog import feature_queries, forecast_queries, hierarchy_queries, model_queries, registry

    return registry


def all_queries() -> dict:
    return dict(_load().QUERIES)


def all_sql() -> dict:
    return dict(_load().SQL)
