"""Collects named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tunecrate.plans.views import View

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``build(view) -> DataFrame`` under a name."""

    def register(build: Callable[[View], DataFrame]) -> Callable[[View], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(View(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
