"""Registry of queries and of their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbflow.plans.bindings import Inputs, with_inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(inputs) -> DataFrame` under a name, with the SQL that must agree."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Inputs(spark, folder))
        if sql is not None:
            ORACLE[name] = with_inputs(sql)
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round columns whose last bits depend on the order of floating-point steps."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def load() -> None:
    """Import every query module once."""
    from ebbflow.plans import (  # noqa: F401
        area_queries,
        calendar_queries,
        column_queries,
        geo_queries,
        mobility_queries,
        population_queries,
        quality_queries,
        source_queries,
        surveillance_queries,
    )
