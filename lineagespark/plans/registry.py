"""Collects the registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lineagespark.plans.inputs import Inputs, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, uses: str = ""):
    """Register ``fn(inputs) -> DataFrame`` under an operator id, with its checking SQL."""

    def register(fn):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql:
            ORACLES[key] = with_views(sql, uses.split())
        return fn

    return register


def load_all() -> None:
    from lineagespark.plans import (  # noqa: F401
        scalars, filters, source_sinks, joins, distances, aggregates, ranking, graphs, statistics, sets,
    )
