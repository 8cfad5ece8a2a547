"""Writers: monthly parquet partitions and small CSV summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ebbflow.functions.columns import month_key


def write_months(df: DataFrame, path: str, order: Sequence[str], extra: Sequence[str] = ()) -> None:
    """Write a dated table by month, replacing only the months it contains.

    A column `yyyymm` says the month, such as that of the feed a row came in; without it the
    month is the date's.

    Rows are rebalanced on the month: a month gets few files, and adaptive execution
    splits a month that is much larger than the others. Order inside a file follows
    `order`, which gives tight row-group ranges for later scans.
    """
    parts = ["yyyymm", *extra]
    dated = df if "yyyymm" in df.columns else df.withColumn("yyyymm", month_key(F.col("date")))
    (
        dated
        .hint("rebalance", *parts)
        .sortWithinPartitions(*parts, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*parts)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
