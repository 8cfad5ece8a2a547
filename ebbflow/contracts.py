"""Argument and column checks that run before any plan is built."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import Column, DataFrame, functions as F


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; got {df.columns}")


def require_choice(value, allowed: Collection, name: str) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {list(allowed)}, got {value!r}")


def require_subset(values: Iterable, allowed: Collection, name: str) -> None:
    unknown = sorted(set(values) - set(allowed))
    if unknown:
        raise ValueError(f"{name}: unknown {unknown}; expected a subset of {list(allowed)}")


def fail_if_empty(df: DataFrame, source: DataFrame, message: str) -> DataFrame:
    """`df`, failing when it is computed if `source` has no rows."""
    return _fail_unless(df, source, F.count("*") > 0, message)


def fail_if_any(df: DataFrame, offending: DataFrame, message: str) -> DataFrame:
    """`df`, failing when it is computed if there is an offending row."""
    return _fail_unless(df, offending, F.count("*") == 0, message)


def _fail_unless(df: DataFrame, source: DataFrame, test: Column, message: str) -> DataFrame:
    """A row-free branch that carries the test is added by union.

    An error in a scalar subquery would not do: adaptive execution drops the projection
    above an empty stage, and the error with it.
    """
    ok = F.when(test, True).otherwise(F.raise_error(F.lit(message)))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.unionByName(source.agg(ok.alias("_ok")).filter(~F.col("_ok")).select(*nothing))
