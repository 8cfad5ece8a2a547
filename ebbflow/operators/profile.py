"""Month profiles that merge: what the checks of a table need, without reading it again.

A profile has a row for each month and column (of listed columns: for each of their values) with
counts, sum and extremes. All of these are additive, so the profiles of two parts of a month
merge into that of the month, and 72 months are checked from a few thousand rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ebbflow.contracts import require_columns
from ebbflow.functions.columns import month_key
from ebbflow.sources.published import MonthTable

KEYS = ["yyyymm", "column", "value"]
SCHEMA = (
    "yyyymm string, column string, value string, n_rows bigint, n_nulls bigint, n_nans bigint, "
    "n_negative bigint, least double, most double, total double"
)


def month_profile(df: DataFrame, columns: Sequence[str], listed: Sequence[str] = ()) -> DataFrame:
    """The profile of each month of a dated table, from one read of these columns.

    `listed` columns, those with a small vocabulary, have a row for each value (null for missing
    ones), the others one row. Extremes, sums and negatives are of numbers: text has none, and a
    NaN is counted by itself and left out of them. The month is `yyyymm` or that of `date`; rows
    without either make a month of null. Sums are combined before the shuffle, so a task sends a
    row for each month and value that it met, however many rows these have.
    """
    require_columns(df, [*columns, *listed], "profile")
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def cell(name: str) -> Column:
        own = F.col(f"`{name}`")
        number = own.cast("double") if isinstance(kinds[name], T.NumericType) else F.lit(None).cast("double")
        value = own.cast("string") if name in listed else F.lit(None).cast("string")
        return F.struct(
            F.lit(name).alias("column"), value.alias("value"), own.isNull().alias("_null"), number.alias("_number")
        )

    month = F.col("yyyymm").cast("string") if "yyyymm" in df.columns else month_key(F.col("date"))
    cells = df.select(
        month.alias("yyyymm"), F.inline(F.array(*[cell(c) for c in dict.fromkeys([*columns, *listed])]))
    )
    nan = F.coalesce(F.isnan("_number"), F.lit(False))
    number = F.when(~nan, F.col("_number"))
    return cells.groupBy(*KEYS).agg(
        F.count("*").alias("n_rows"),
        F.count_if("_null").alias("n_nulls"),
        F.count_if(nan).alias("n_nans"),
        F.count_if(number < 0).alias("n_negative"),
        F.min(number).alias("least"),
        F.max(number).alias("most"),
        F.sum(number).alias("total"),
    )


def merged(profiles: DataFrame) -> DataFrame:
    """One profile from those of parts that share no row."""
    return profiles.groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_nulls", "n_nans", "n_negative")],
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.sum("total").alias("total"),
    )


def by_column(profiles: DataFrame, *keys: str) -> DataFrame:
    """One row for each column (and for `keys`, such as yyyymm) with its number of values, which is
    0 for a column that was not listed."""
    return profiles.groupBy(*keys, "column").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_nulls", "n_nans", "n_negative")],
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.sum("total").alias("total"),
        F.count_distinct("value").alias("n_values"),
    )


@dataclass(frozen=True)
class Bound:
    """A check of one column's profile: a metric of `by_column` and the test it must pass."""

    column: str
    metric: str
    expected: str
    passes: Callable[[Column], Column]


def no_nulls(column: str) -> Bound:
    return Bound(column, "n_nulls", "0", lambda v: v == 0)


def not_negative(column: str) -> Bound:
    return Bound(column, "n_negative", "0", lambda v: v == 0)


def at_least(column: str, low: float) -> Bound:
    return Bound(column, "least", f">= {low}", lambda v: v >= low)


def at_most(column: str, high: float) -> Bound:
    return Bound(column, "most", f"<= {high}", lambda v: v <= high)


def cardinality(column: str, n: int) -> Bound:
    return Bound(column, "n_values", str(n), lambda v: v == n)


def report(profiles: DataFrame, bounds: Sequence[Bound], *keys: str) -> DataFrame:
    """keys, column, metric, measured, expected, status: a row for each bound (and month, if `keys`
    says so). A metric that is null, as of a column without numbers, fails."""
    each = []
    for b in bounds:
        value = F.col(b.metric).cast("double")
        status = F.when(b.passes(value), "PASS").otherwise("FAIL")
        row = F.struct(
            F.lit(b.column).alias("_of"),
            F.lit(b.metric).alias("metric"),
            value.alias("measured"),
            F.lit(b.expected).alias("expected"),
            status.alias("status"),
        )
        each.append(row)
    rows = by_column(profiles, *keys).select(*keys, "column", F.inline(F.array(*each)))
    return rows.filter(F.col("_of") == F.col("column")).drop("_of")


def value_gaps(profiles: DataFrame, expected: dict[str, Sequence]) -> DataFrame:
    """yyyymm, column, value, gap: expected values that a month lacks and values beyond them.

    Months are those of the profile; a null value is no gap, `no_nulls` tells it.
    """
    spark = profiles.sparkSession
    wanted = [(c, str(v)) for c, values in expected.items() for v in values]
    want = spark.createDataFrame(wanted, "column string, value string").distinct()
    have = profiles.filter(F.col("column").isin(list(expected)) & F.col("value").isNotNull())
    have = have.select(*KEYS).distinct().withColumn("_have", F.lit(True))
    every = profiles.select("yyyymm").distinct()
    spread = every.withColumn("_of", F.explode(F.array(*[F.lit(c) for c in expected])))
    due = spread.join(want, F.col("_of") == F.col("column")).drop("_of").withColumn("_want", F.lit(True))
    same = [F.col(f"h.{k}").eqNullSafe(F.col(f"w.{k}")) for k in KEYS]
    both = have.alias("h").join(due.alias("w"), same, "full")
    side = F.when(F.col("_have").isNull(), "missing").when(F.col("_want").isNull(), "extra")
    picked = [F.when(F.col("_have").isNull(), F.col(f"w.{k}")).otherwise(F.col(f"h.{k}")).alias(k) for k in KEYS]
    return both.select(*picked, side.alias("gap")).filter("gap IS NOT NULL")


def month_totals(profiles: DataFrame, column: str) -> DataFrame:
    """yyyymm, total and n_rows of one column, as `series.monthly_totals` has it from the table."""
    mine = by_column(profiles, "yyyymm").filter(F.col("column") == column)
    return mine.select("yyyymm", "total", "n_rows")


@dataclass(frozen=True)
class ProfileTable:
    """The profiles of all months, each published with one manifest and replaced by month."""

    spark: SparkSession
    root: str
    columns: tuple[str, ...]
    listed: tuple[str, ...] = ()

    def add(self, df: DataFrame) -> list[str]:
        """Put the months of these rows in, each in the place of what it had; gives the months.
        Reads the given rows once and no other. A row of no month is an error."""
        table = MonthTable(self.spark, self.root)
        versions = table.versions()
        made = month_profile(df, self.columns, self.listed)
        known = F.coalesce(F.col("yyyymm"), F.raise_error(F.lit("a row has no month")).cast("string"))
        made = made.withColumn("yyyymm", known)
        run = table.stage(made, ["column", "value"])
        entries = table.measure(run, made, "n_rows")
        if entries:
            table.publish_months(entries, versions[-1] if versions else 0)
        return sorted(e.yyyymm for e in entries)

    def read(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """The published profiles, or those of the months from `first` to `last`."""
        table = MonthTable(self.spark, self.root)
        empty = self.spark.createDataFrame([], SCHEMA).schema
        return table.read(first, last, schema=empty).select(*empty.names)
