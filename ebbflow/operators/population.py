"""Hourly population: refinement, night population, detection and day patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ebbflow.contracts import require_choice, require_columns
from ebbflow.functions import calendar
from ebbflow.functions.columns import age5_of, age10_of, month_key, ratio
from ebbflow.joins import small
from ebbflow.operators import stats
from ebbflow.session import settled

NIGHT_HOURS = [3, 4, 5]


def refine(raw: DataFrame, areas: DataFrame, age: str = "age_10") -> DataFrame:
    """Population per (date, hour, area, age) of the listed areas; names joined last."""
    require_choice(age, ("age_10", "age_5"), "age")
    require_columns(
        raw, ["ETL_YMD", "TIMEZN_CD", "ADMDONG_CD", "SEX_AGE_CD", "POP"], "population feed"
    )
    return with_names(sums(raw, areas, age), areas, age)


def sums(raw: DataFrame, areas: DataFrame, age: str = "age_10") -> DataFrame:
    """The additive part of `refine`."""
    age_of = age10_of if age == "age_10" else age5_of
    return (
        raw.select(
            F.col("ETL_YMD").cast("int").alias("date"),
            F.col("TIMEZN_CD").cast("int").alias("hour"),
            F.col("ADMDONG_CD").alias("admdong_cd"),
            age_of(F.col("SEX_AGE_CD")).alias(age),
            F.col("POP").alias("pop"),
        )
        .join(small(areas, ["admdong_cd"]), "admdong_cd", "left_semi")
        .groupBy("date", "hour", "admdong_cd", age)
        .agg(F.sum("pop").alias("pop"))
    )


def with_names(summed: DataFrame, areas: DataFrame, age: str = "age_10") -> DataFrame:
    names = small(areas, ["admdong_cd", "admdong_nm"])
    return summed.join(names, "admdong_cd", "left").select(
        "date", "hour", "admdong_cd", "admdong_nm", age, "pop"
    )


def month_ledger(raw: DataFrame, refined: DataFrame, areas: DataFrame) -> DataFrame:
    """Per month: rows read, kept and written, areas, and population before and after."""
    codes = small(areas, ["admdong_cd"]).withColumn("_in", F.lit(True))
    kept = F.col("_in").isNotNull()
    before = (
        raw.withColumn("admdong_cd", F.col("ADMDONG_CD"))
        .join(codes, "admdong_cd", "left")
        .groupBy(month_key(F.col("ETL_YMD")).alias("yyyymm"))
        .agg(
            F.count("*").alias("input_rows"),
            F.count_if(kept).alias("filtered_rows"),
            F.coalesce(F.sum(F.when(kept, F.col("POP"))), F.lit(0.0)).alias("pop_sum_before"),
        )
    )
    after = refined.groupBy(month_key(F.col("date")).alias("yyyymm")).agg(
        F.count("*").alias("output_rows"),
        F.count_distinct("admdong_cd").alias("unique_admdongs"),
        F.sum("pop").alias("pop_sum_after"),
    )
    gap = F.abs(F.col("pop_sum_before") - F.coalesce("pop_sum_after", F.lit(0.0)))
    return before.join(after, "yyyymm", "left").withColumn("pop_diff", gap)


def mean_population_by_age(pop: DataFrame) -> DataFrame:
    """Mean concurrent population per age: total over 24 hours times the days present."""
    days = pop.agg(F.count_distinct("date")).scalar()
    return pop.groupBy("age_10").agg(F.sum("pop").alias("_p")).select(
        "age_10", ratio(F.col("_p"), days * 24).alias("avg_pop_total")
    )


def hourly_totals(df: DataFrame, value: str, *keys: str, alias: str) -> DataFrame:
    return df.groupBy(*keys, "hour").agg(F.sum(value).alias(alias))


def night_mean(pop: DataFrame) -> DataFrame:
    """Mean over the night rows present per (area, age)."""
    return (
        pop.filter(F.col("hour").isin(NIGHT_HOURS))
        .groupBy("admdong_cd", "age_10")
        .agg(F.avg("pop").alias("night_avg"))
    )


def detection(pop: DataFrame, census10: DataFrame, min_census: int = 0) -> DataFrame:
    """Night population over registered population, where the latter exceeds `min_census`."""
    registered = census10.select("admdong_cd", "age_10", F.col("pop").alias("census_pop"))
    return (
        night_mean(pop)
        .join(registered.filter(F.col("census_pop") > min_census), ["admdong_cd", "age_10"])
        .withColumn("detection_rate", ratio(F.col("night_avg"), F.col("census_pop")))
    )


def detection_summary(rates: DataFrame, keys: Sequence[str] = ("age_10",)) -> DataFrame:
    return stats.summary(
        rates,
        keys,
        "detection_rate",
        {"median": 0.5, "q10": 0.1, "q25": 0.25, "q75": 0.75, "q90": 0.9},
        [
            F.avg("detection_rate").alias("mean"),
            F.stddev("detection_rate").alias("std"),
            F.count("*").alias("n_areas"),
        ],
    )


def outlier_areas(
    rates: DataFrame,
    high: float = 1.3,
    low: float = 0.5,
    ages: Sequence[int] = (20, 30),
    k: int = 20,
) -> DataFrame:
    """The k areas furthest above `high` and below `low`, for the given ages."""
    rate = F.col("detection_rate")
    adults = rates.filter(F.col("age_10").isin(list(ages)))
    ties = ["admdong_cd", "age_10"]
    above = adults.filter(rate > high).orderBy(rate.desc(), *ties).limit(k)
    below = adults.filter(rate < low).orderBy(rate, *ties).limit(k)
    return above.withColumn("side", F.lit("high")).unionByName(
        below.withColumn("side", F.lit("low"))
    )


def day_night(pop: DataFrame, day: int = 13, night: int = 4, noise: float = 10) -> DataFrame:
    """Mean at a day hour over mean at a night hour, per area and age, in one aggregation."""
    at = lambda h: F.avg(F.when(F.col("hour") == h, F.col("pop")))
    return _day_night(pop, at, day, night, noise)


def _day_night(cells: DataFrame, at, day: int = 13, night: int = 4, noise: float = 10) -> DataFrame:
    return (
        cells.filter(F.col("hour").isin(day, night))
        .groupBy("admdong_cd", "age_10")
        .agg(at(day).alias("day_avg"), at(night).alias("night_avg"))
        .filter(F.col("night_avg") > noise)
        .withColumn("day_night_ratio", ratio(F.col("day_avg"), F.col("night_avg")))
    )


def weekday_weekend_gap(
    pop: DataFrame, hour: int = 9, noise: float = 10, holidays="mobility"
) -> DataFrame:
    """Weekday and weekend means at one hour per area and age, and their difference."""
    part = calendar.week_part(F.col("date"), holidays)
    mean = lambda p: F.avg(F.when(F.col("_part") == p, F.col("pop"))).alias(p)
    return (
        pop.filter(F.col("hour") == hour)
        .withColumn("_part", part)
        .groupBy("admdong_cd", "age_10")
        .agg(mean("weekday"), mean("weekend"))
        .filter(F.col("weekend") > noise)
        .withColumn("diff", F.col("weekday") - F.col("weekend"))
        .withColumn("rel_diff", ratio(F.col("diff"), F.col("weekend")))
    )


def hourly_area_mean(pop: DataFrame) -> DataFrame:
    """Mean over days of the daily total per (hour, area); only days present count."""
    daily = pop.groupBy("date", "hour", "admdong_cd").agg(F.sum("pop").alias("pop_day"))
    return daily.groupBy("hour", "admdong_cd").agg(F.avg("pop_day").alias("pop_avg"))


def colour_bounds(df: DataFrame, value: str) -> DataFrame:
    """5th and 99th percentile of the positive values of an (hour, area) table."""
    return stats.summary(
        df.filter(F.col(value) > 0), [], value, {"vmin": 0.05, "vmax": 0.99}
    )


def indicators(pop: DataFrame, od: DataFrame) -> DataFrame:
    """Per age: mean population, moves per head, hourly variation and day/night median.

    Each feed is read once. Of population the sums by area, age and hour and the dates present
    come from one aggregation and are stored: a row for each area, age and hour, whatever the days.
    """
    cells = ["admdong_cd", "age_10", "hour"]
    parts = settled(
        pop.groupingSets([[F.col(c) for c in cells], [F.col("date")]], *cells, "date").agg(
            F.grouping("date").alias("_cell"), F.sum("pop").alias("_sum"), F.count("pop").alias("_n")
        )
    )
    n_days = parts.filter("_cell = 0").agg(F.count("date")).scalar()
    sums = parts.filter("_cell = 1")
    cv = lambda value: ratio(F.stddev(value), F.avg(value))
    hours = sums.groupBy("age_10", "hour").agg(F.sum("_sum").alias("_x"))
    people = hours.groupBy("age_10").agg(
        ratio(F.sum("_x"), n_days * 24).alias("avg_pop_total"), cv("_x").alias("pop_hourly_cv")
    )
    moves = hourly_totals(od, "total", "age_10", alias="_x").groupBy("age_10").agg(
        F.sum("_x").alias("total_moves"), cv("_x").alias("move_hourly_cv")
    )
    of = lambda c, h: F.sum(F.when(F.col("hour") == h, F.col(c)))
    ratios = _day_night(sums, lambda h: ratio(of("_sum", h), of("_n", h)))
    dn = stats.summary(ratios, ["age_10"], "day_night_ratio", {"_dn": 0.5})
    joined = people.join(moves, "age_10").join(dn, "age_10")
    return joined.select(
        "age_10",
        F.round("avg_pop_total", 0).alias("avg_pop"),
        F.round(ratio(F.col("total_moves"), F.col("avg_pop_total")), 2).alias("moves_per_capita"),
        F.round("pop_hourly_cv", 3).alias("pop_hourly_cv"),
        F.round("move_hourly_cv", 3).alias("move_hourly_cv"),
        F.round("_dn", 3).alias("day_night_ratio_median"),
    )
