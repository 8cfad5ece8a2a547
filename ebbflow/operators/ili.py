"""Influenza surveillance: wide seasons to long weeks, statistics and age bridging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbflow import vocab
from ebbflow.contracts import fail_if_empty, require_choice
from ebbflow.functions.columns import none_if_nan

SLOT_COLUMNS = [f"w{i}" for i in range(vocab.ILI_SLOTS)]
LAST_SLOT_OF_FIRST_YEAR = 52 - vocab.SEASON_FIRST_ISO_WEEK


def iso_year_of(start_year: Column, slot: Column) -> Column:
    return F.when(slot <= LAST_SLOT_OF_FIRST_YEAR, start_year).otherwise(start_year + 1)


def iso_week_of(slot: Column) -> Column:
    return F.when(
        slot <= LAST_SLOT_OF_FIRST_YEAR, slot + vocab.SEASON_FIRST_ISO_WEEK
    ).otherwise(slot - LAST_SLOT_OF_FIRST_YEAR)


def season_week_to_iso(start_year: int, slot: int) -> tuple[int, int]:
    """(ISO year, ISO week) of a season slot; every season has 52 weeks."""
    if not 0 <= slot < vocab.SEASON_WEEKS:
        raise ValueError(f"week {slot} is outside 0..{vocab.SEASON_WEEKS - 1}")
    if slot <= LAST_SLOT_OF_FIRST_YEAR:
        return start_year, vocab.SEASON_FIRST_ISO_WEEK + slot
    return start_year + 1, slot - LAST_SLOT_OF_FIRST_YEAR


def to_long(wide: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Wide rows (season, w0..w53 as text) to one row per slot.

    Slots past week 51 are not valid: their ISO fields are 0 and the rate is null.
    Empty or NaN rates are null. A season name that is not 'YYYY-...' fails the job.
    """
    slots = F.posexplode(F.array(*[F.col(c) for c in SLOT_COLUMNS])).alias("week_in_season", "_raw")
    long = wide.filter(F.trim("season") != "").select(
        *keys, F.replace(F.trim("season"), F.lit(vocab.SEASON_SUFFIX), F.lit("")).alias("season"), slots
    )
    slot = F.col("week_in_season")
    start = F.split("season", "-")[0].cast("int")
    valid = slot < vocab.SEASON_WEEKS
    raw = F.trim("_raw")
    rate = none_if_nan(F.when(raw != "", raw).cast("double"))
    zero = F.lit(0)
    return long.select(
        *keys,
        "season",
        start.alias("season_start_year"),
        slot.cast("int").alias("week_in_season"),
        F.when(valid, iso_week_of(slot)).otherwise(zero).cast("int").alias("iso_week"),
        F.when(valid, iso_year_of(start, slot)).otherwise(zero).cast("int").alias("calendar_year"),
        valid.alias("is_valid_week"),
        F.when(valid, rate).alias("ili_rate"),
    )


def for_age(long: DataFrame, age_group: str) -> DataFrame:
    require_choice(age_group, vocab.ILI_AGE_GROUPS, "age_group")
    return long.filter(F.col("age_group") == age_group)


def series(
    long: DataFrame,
    season: str,
    valid_only: bool = True,
    start_week: int | None = None,
    end_week: int | None = None,
) -> DataFrame:
    """One season in week order. An unknown season fails when the result is computed."""
    of_season = long.filter(F.col("season") == season)
    out = of_season
    if valid_only:
        out = out.filter("is_valid_week")
    if start_week is not None:
        out = out.filter(F.col("week_in_season") >= start_week)
    if end_week is not None:
        out = out.filter(F.col("week_in_season") <= end_week)
    checked = fail_if_empty(out, of_season, f"unknown season: {season}")
    return checked.orderBy("week_in_season")


def season_stats(long: DataFrame, *keys: str) -> DataFrame:
    return (
        long.filter("is_valid_week")
        .groupBy(*keys, "season")
        .agg(
            F.avg("ili_rate").alias("mean"),
            F.max("ili_rate").alias("max"),
            F.min("ili_rate").alias("min"),
            F.count_if(F.col("ili_rate").isNull()).alias("n_missing"),
        )
    )


def missing_weeks(long: DataFrame, *keys: str) -> DataFrame:
    """Valid weeks without a rate, listed per season (at most 52)."""
    return (
        long.filter(F.col("is_valid_week") & F.col("ili_rate").isNull())
        .groupBy(*keys, "season")
        .agg(F.array_sort(F.collect_list("week_in_season")).alias("weeks"))
    )


def bridge(spark: SparkSession, weighted: bool = True) -> DataFrame:
    """(age_group, age_idx, weight) from the 7 surveillance groups to the 15 ages."""
    if weighted:
        rows = [(g, i, w) for g, m in vocab.ILI_BRIDGE_WEIGHTED.items() for i, w in m.items()]
    else:
        rows = [(g, i, 1.0) for g, m in vocab.ILI_BRIDGE_UNWEIGHTED.items() for i in m]
    return spark.createDataFrame(rows, "age_group string, age_idx int, weight double")


def to_15_ages(long: DataFrame, bridge_table: DataFrame) -> DataFrame:
    """Weekly rate of each of the 15 ages: weighted sum over the groups that cover it.

    Null where a covering group has no row or no rate that week: a gap is not a zero.
    """
    covering = bridge_table.groupBy("age_idx").agg(F.count("*").alias("_groups"))
    return (
        long.filter("is_valid_week")
        .join(bridge_table, "age_group")
        .groupBy("season", "week_in_season", "age_idx")
        .agg(
            F.sum(F.col("weight") * F.col("ili_rate")).alias("_rate"),
            F.count("ili_rate").alias("_known"),
        )
        .join(F.broadcast(covering), "age_idx")  # 15 rows
        .select(
            "season",
            "week_in_season",
            "age_idx",
            F.when(F.col("_known") >= F.col("_groups"), F.col("_rate")).alias("rate"),
        )
    )


def bridge_coverage(bridge_table: DataFrame) -> DataFrame:
    return bridge_table.groupBy("age_idx").agg(F.sum("weight").alias("coverage"))
