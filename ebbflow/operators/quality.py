"""Data-quality reports: long tables of (check, metric, expected, status)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ebbflow.functions.columns import ratio


@dataclass(frozen=True)
class Rule:
    """An aggregate over the table and the test its value must pass."""

    check: str
    metric: Column
    expected: str
    passes: "callable"


def no_nulls(columns: Sequence[str]) -> list[Rule]:
    return [
        Rule(f"nulls in {c}", F.count_if(F.col(c).isNull()), "0", lambda v: v == 0)
        for c in columns
    ]


def not_negative(column: str) -> Rule:
    return Rule(f"negative {column}", F.count_if(F.col(column) < 0), "0", lambda v: v == 0)


def within(column: str, low, high) -> list[Rule]:
    return [
        Rule(f"min {column}", F.min(column), f">= {low}", lambda v: v >= low),
        Rule(f"max {column}", F.max(column), f"<= {high}", lambda v: v <= high),
    ]


def cardinality(column: str, n: int) -> Rule:
    return Rule(f"distinct {column}", F.count_distinct(column), str(n), lambda v: v == n)


def value_gaps(df: DataFrame, expected: dict[str, Sequence]) -> DataFrame:
    """For each column, expected values that it lacks and values that it has beyond them, by name.

    One read for all columns; tasks keep each value once before the shuffle.
    """
    wanted = [(c, str(v)) for c, values in expected.items() for v in values]
    want = df.sparkSession.createDataFrame(wanted, "column string, value string")
    each = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in expected]
    )
    have = df.select(F.inline(each)).distinct()
    both = have.withColumn("_have", F.lit(True)).join(
        want.distinct().withColumn("_want", F.lit(True)), ["column", "value"], "full"
    )
    side = F.when(F.col("_have").isNull(), "missing").when(F.col("_want").isNull(), "extra")
    return both.select("column", "value", side.alias("gap")).filter("gap IS NOT NULL")


def allowed(column: str, values: Sequence) -> Rule:
    """Every value, null included, must be one of a fixed list."""
    known = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    return Rule(f"{column} allowed", F.count_if(~known), "0", lambda v: v == 0)


def report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules in one aggregation over the table, then one row per rule."""
    names = [f"_m{i}" for i in range(len(rules))]
    metrics = df.agg(*[r.metric.cast("double").alias(n) for r, n in zip(rules, names)])
    rows = F.array(
        *[
            F.struct(
                F.lit(r.check).alias("check"),
                F.col(n).alias("metric"),
                F.lit(r.expected).alias("expected"),
                F.when(r.passes(F.col(n)), "PASS").otherwise("FAIL").alias("status"),
            )
            for r, n in zip(rules, names)
        ]
    )
    return metrics.select(F.inline(rows))


def value_list(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a small-vocabulary column, one row each, with their rows."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))


def code_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Matched and one-sided codes of two tables and their shares, from one full join."""
    l = left.select(key).distinct().withColumn("_l", F.lit(1))
    r = right.select(key).distinct().withColumn("_r", F.lit(1))
    both = F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull())
    return (
        l.join(r, key, "full")
        .agg(
            F.count("_l").alias("n_left"),
            F.count("_r").alias("n_right"),
            both.alias("n_matched"),
        )
        .select(
            "*",
            (F.col("n_left") - F.col("n_matched")).alias("only_left"),
            (F.col("n_right") - F.col("n_matched")).alias("only_right"),
            (ratio(F.col("n_matched"), F.greatest("n_left", F.lit(1))) * 100).alias("pct_of_left"),
            (ratio(F.col("n_matched"), F.greatest("n_right", F.lit(1))) * 100).alias("pct_of_right"),
        )
    )


def one_sided(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Codes found on one side only, tagged with the side."""
    l, r = left.select(key).distinct(), right.select(key).distinct()
    return (
        l.join(r, key, "left_anti")
        .withColumn("side", F.lit("left"))
        .unionByName(r.join(l, key, "left_anti").withColumn("side", F.lit("right")))
    )


def before_after(
    df: DataFrame, condition: Column, value: str, name: str = "filter_stats"
) -> tuple[DataFrame, Observation]:
    """The filtered table plus an observation of rows and sums on both sides of the filter.

    The numbers are collected while the table is being used: no extra pass.
    """
    seen = Observation(name)
    watched = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(condition).alias("rows_after"),
        F.sum(value).alias("sum_before"),
        F.sum(F.when(condition, F.col(value))).alias("sum_after"),
    )
    return watched.filter(condition), seen


def before_after_table(df: DataFrame, condition: Column, value: str) -> DataFrame:
    """The same numbers as a one-row table."""
    return df.agg(
        F.count("*").alias("rows_before"),
        F.count_if(condition).alias("rows_after"),
        F.sum(value).alias("sum_before"),
        F.sum(F.when(condition, F.col(value))).alias("sum_after"),
    )
