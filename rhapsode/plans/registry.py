"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "") -> Callable:
    """Registers f(t), where t gives fixture views and tables by name. views: the fixture views that the SQL names."""
    from .fixtures import Tables, with_views

    def put(f: Callable[[Tables], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_views(sql, views.split())
        return f

    return put
