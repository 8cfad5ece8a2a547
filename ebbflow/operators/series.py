"""Monthly series and their checks. A series has one row per month, so it is small."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ebbflow.functions.columns import month_key, ratio, year_of_key


def monthly_totals(df: DataFrame, value: str) -> DataFrame:
    """Total and rows per month of a dated table."""
    return df.groupBy(month_key(F.col("date")).alias("yyyymm")).agg(
        F.sum(value).alias("total"), F.count("*").alias("n_rows")
    )


def outliers_by_upper_median(months: DataFrame, low: float = 0.5, high: float = 1.8) -> DataFrame:
    """Months below `low` or above `high` times the upper median (element n div 2)."""
    totals = F.array_sort(F.collect_list("total").over(Window.partitionBy()))
    middle = F.element_at(totals, (F.floor(F.size(totals) / 2) + 1).cast("int"))
    with_median = months.withColumn("median", middle)
    rel = ratio(F.col("total"), F.col("median"))
    return (
        with_median.withColumn("times_median", rel)
        .filter((F.col("total") < F.col("median") * low) | (F.col("total") > F.col("median") * high))
        .select("yyyymm", "total", "times_median")
    )


def with_median(months: DataFrame) -> DataFrame:
    """Each month beside the true (interpolated) median; the series is read once.

    The window is over the whole series: one row per month.
    """
    median = F.percentile("total", F.lit(0.5)).over(Window.partitionBy())
    return months.withColumn("median", median)


def below_median(months: DataFrame, factor: float = 0.5) -> DataFrame:
    """Months below `factor` times the true (interpolated) median."""
    return with_median(months).filter(F.col("total") < F.col("median") * factor).drop("median")


def yearly(months: DataFrame) -> DataFrame:
    return months.groupBy(year_of_key(F.col("yyyymm")).alias("year")).agg(
        F.avg("total").alias("avg_total"),
        F.min("total").alias("min_total"),
        F.max("total").alias("max_total"),
    )


def extremes(months: DataFrame) -> DataFrame:
    """Lowest and highest month (earliest on ties) and the first and last values."""
    low = F.struct("total", "yyyymm")
    high = F.struct("total", -F.col("yyyymm").cast("int"))
    return months.agg(
        F.min_by("yyyymm", low).alias("min_month"),
        F.min("total").alias("min_total"),
        F.max_by("yyyymm", high).alias("max_month"),
        F.max("total").alias("max_total"),
        F.min_by("total", "yyyymm").alias("first_total"),
        F.max_by("total", "yyyymm").alias("last_total"),
    )


def month_change(months: DataFrame, limit: float = 15) -> DataFrame:
    """Change against the month before in percent, where its size exceeds the limit.

    The window is over the whole series: one row per month.
    """
    before = F.lag("total").over(Window.orderBy("yyyymm"))
    pct = ratio(F.col("total") - F.col("_before"), F.col("_before")) * 100
    return (
        months.withColumn("_before", before)
        .withColumn("pct", pct)
        .filter(F.abs("pct") > limit)
        .select("yyyymm", "total", "pct")
    )


def fill_skipped(ledger: DataFrame, months: DataFrame) -> DataFrame:
    """Ledger rows with status OK, plus SKIPPED months measured again from the data."""
    ok = ledger.filter(F.col("status") == "OK").select("yyyymm", "output_rows", "total_sum")
    again = (
        ledger.filter(F.col("status") == "SKIPPED")
        .select("yyyymm")
        .join(months, "yyyymm")
        .select("yyyymm", F.col("n_rows").alias("output_rows"), F.col("total").alias("total_sum"))
    )
    return ok.unionByName(again)
