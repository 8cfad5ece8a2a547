"""Joining the sources: age splits, corrections, static ages and week alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ebbflow import vocab
from ebbflow.functions.columns import ratio
from ebbflow.joins import small


def split_decades(pi: DataFrame, census5: DataFrame) -> DataFrame:
    """Flow of a ten-year age divided between its five-year halves by origin population.

    The share of a half is its population over that of the decade in the origin area;
    an area without people of that decade splits evenly. Ages 70 and over stay whole.
    """
    halves = census5.filter(F.col("age_5_start") < 70).groupBy("admdong_cd").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("age_5_start") == a, F.col("pop_5"))), F.lit(0)).alias(f"_{a}")
            for a in range(10, 70, 5)
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(a - a % 10).alias("age_7"),
                F.lit(a).alias("age_5_start"),
                F.coalesce(
                    ratio(F.col(f"_{a}"), F.col(f"_{a - a % 10}") + F.col(f"_{a - a % 10 + 5}")),
                    F.lit(0.5),
                ).alias("share"),
            )
            for a in range(10, 70, 5)
        ]
    )
    shares = halves.select(F.col("admdong_cd").alias("o_admdong_cd"), F.inline(rows))
    young = pi.filter(F.col("age_7") < 70).join(small(shares), ["o_admdong_cd", "age_7"])
    old = pi.filter(F.col("age_7") >= 70).select(
        "*", F.col("age_7").alias("age_5_start"), F.lit(1.0).alias("share")
    )
    both = young.unionByName(old)
    return both.select(
        "o_admdong_cd", "d_admdong_cd", "age_5_start", "hour",
        (F.col("pi") * F.col("share")).alias("pi"),
    )


def correct_detection(pi: DataFrame, rate: float = 0.9, ages: tuple[int, int] = (20, 69)) -> DataFrame:
    """Flow divided by a fixed detection rate for the ages in the closed range."""
    factor = F.when(F.col("age_7").between(*ages), F.lit(1 / rate)).otherwise(F.lit(1.0))
    return pi.withColumn("pi", F.col("pi") * factor)


def correct_by_median(pi: DataFrame, summary: DataFrame) -> DataFrame:
    """Flow divided by the median detection rate of its age, where there is one."""
    medians = summary.filter(F.col("age_10").isin(vocab.MOBILITY_AGES)).select(
        F.col("age_10").alias("age_7"), "median"
    )
    # One row per mobility age: seven at most.
    return (
        pi.join(F.broadcast(medians), "age_7", "left")
        .withColumn("pi", F.coalesce(ratio(F.col("pi"), F.col("median")), F.col("pi")))
        .drop("median")
    )


def static_flows(areas: DataFrame, age_starts: tuple[int, ...] = (0, 5, 70)) -> DataFrame:
    """Identity rows (stay in the own area, weight 1) for the ages that do not travel."""
    ages = F.explode(F.array(*[F.lit(a) for a in age_starts])).alias("age_5_start")
    return areas.select("admdong_cd").distinct().select(
        F.col("admdong_cd").alias("o_admdong_cd"),
        F.col("admdong_cd").alias("d_admdong_cd"),
        ages,
        F.lit(1.0).alias("weight"),
    )


def align_weeks(
    ili_long: DataFrame, claims_weekly: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """Surveillance rate and claims of the same ISO week; `extra` columns of the former are kept.

    The two season numberings differ in 53-week years, so only ISO keys are joined.
    """
    rates = ili_long.filter("is_valid_week").select(
        F.col("calendar_year").alias("iso_year"), "iso_week", "season", "ili_rate", *extra
    )
    episodes = claims_weekly.groupBy("iso_year", "iso_week").agg(F.sum("episodes").alias("episodes"))
    return rates.join(episodes, ["iso_year", "iso_week"])
