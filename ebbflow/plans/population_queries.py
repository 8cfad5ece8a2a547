"""Hourly population, census, detection rates and day patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow.functions.columns import lookup, ratio
from ebbflow.operators import census, geo, population, stats
from ebbflow.plans.bindings import Inputs
from ebbflow.plans.catalog import query, rounded


@query("a03_hourly_population", "SELECT * FROM lp")
def hourly_population(i: Inputs) -> DataFrame:
    return i.lp


@query(
    "a04_hourly_population_five",
    """SELECT ETL_YMD AS date, TIMEZN_CD::INTEGER AS hour, c.admdong_cd, c.admdong_nm, substr(SEX_AGE_CD, 2, 2)::INTEGER AS age_5, sum(POP) AS pop
       FROM lp_raw JOIN capital c ON lp_raw.ADMDONG_CD = c.admdong_cd GROUP BY ALL""",
)
def hourly_population_five(i: Inputs) -> DataFrame:
    return population.refine(i.lp_raw, i.capital, "age_5")


LABELS = "CASE WHEN age_idx = 14 THEN '70+' ELSE (age_idx * 5)::VARCHAR || '-' || (age_idx * 5 + 4)::VARCHAR END AS age_group"


@query("a05_census_15", f"SELECT admdong_cd, admdong_nm, sgg_nm, sido_nm, {LABELS}, age_idx, pop FROM census15 WHERE sido_nm IN ('AFRICA', 'AMERICA', 'ASIA')")
def census_15(i: Inputs) -> DataFrame:
    return census.to_15_groups(i.census5, ["AFRICA", "AMERICA", "ASIA"])


@query("a06_census_10", "SELECT * FROM census10")
def census_10(i: Inputs) -> DataFrame:
    return i.census10


MATRIX = "SELECT admdong_cd, " + ", ".join(f"max(pop) FILTER (age_idx = {k}) AS a{k}" for k in range(15)) + " FROM census15 GROUP BY ALL"


@query("a07_population_matrix", MATRIX)
def population_matrix(i: Inputs) -> DataFrame:
    return census.pivot_matrix(census.to_15_groups(i.census5))


@query("a26_mean_population", "SELECT * FROM avg_pop")
def mean_population(i: Inputs) -> DataFrame:
    return population.mean_population_by_age(i.lp)


@query("a36_night_mean", "SELECT * FROM night")
def night_mean(i: Inputs) -> DataFrame:
    return population.night_mean(i.lp)


@query("a37_detection", "SELECT * FROM detection")
def detection(i: Inputs) -> DataFrame:
    return population.detection(i.lp, i.census10, 50)


RATE_STATS = """round(median(detection_rate), 6) AS median, round(quantile_cont(detection_rate, 0.1), 6) AS q10,
    round(quantile_cont(detection_rate, 0.25), 6) AS q25, round(quantile_cont(detection_rate, 0.75), 6) AS q75,
    round(quantile_cont(detection_rate, 0.9), 6) AS q90, round(avg(detection_rate), 6) AS mean,
    round(stddev(detection_rate), 6) AS std, count(*) AS n_areas"""
RATE_COLUMNS = ["median", "q10", "q25", "q75", "q90", "mean", "std"]


@query("a38_detection_summary", f"SELECT age_10, {RATE_STATS} FROM detection GROUP BY ALL")
def detection_summary(i: Inputs) -> DataFrame:
    return rounded(population.detection_summary(population.detection(i.lp, i.census10, 50)), *RATE_COLUMNS)


@query(
    "a39_relative_to_reference",
    """SELECT age_10, round(m / (SELECT median(detection_rate) FROM detection WHERE age_10 = 20), 6) AS rel_to_20s
       FROM (SELECT age_10, median(detection_rate) AS m FROM detection GROUP BY ALL)""",
)
def relative_to_reference(i: Inputs) -> DataFrame:
    summary = population.detection_summary(population.detection(i.lp, i.census10, 50))
    reference = summary.filter(F.col("age_10") == 20).select("median").scalar()
    out = summary.select("age_10", ratio(F.col("median"), reference).alias("rel_to_20s"))
    return rounded(out, "rel_to_20s")


@query(
    "a40_detection_by_region",
    """SELECT CASE substr(admdong_cd, 1, 2) WHEN '00' THEN 'A' WHEN '01' THEN 'B' ELSE 'other' END AS sido, age_10,
         round(median(detection_rate), 6) AS median, count(*) AS n_areas FROM detection GROUP BY ALL""",
)
def detection_by_region(i: Inputs) -> DataFrame:
    rates = population.detection(i.lp, i.census10, 50)
    sido = lookup(F.substring("admdong_cd", 1, 2), {"00": "A", "01": "B"}, "other")
    out = population.detection_summary(rates.withColumn("sido", sido), ["sido", "age_10"])
    return rounded(out.select("sido", "age_10", "median", "n_areas"), "median")


PROFILE = {"p5": 0.05, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}


@query(
    "a41_detection_profile",
    "SELECT " + ", ".join(f"round(quantile_cont(detection_rate, {q}), 6) AS {n}" for n, q in PROFILE.items())
    + ", round(avg(detection_rate), 6) AS mean FROM detection WHERE age_10 = 70",
)
def detection_profile(i: Inputs) -> DataFrame:
    rates = population.detection(i.lp, i.census10, 50).filter(F.col("age_10") == 70)
    out = stats.summary(rates, [], "detection_rate", PROFILE, [F.avg("detection_rate").alias("mean")])
    return rounded(out, *PROFILE, "mean")


@query("a42_day_night", "SELECT * FROM day_night")
def day_night(i: Inputs) -> DataFrame:
    return population.day_night(i.lp)


@query(
    "a43_day_night_summary",
    """SELECT age_10, round(median(day_night_ratio), 6) AS median, round(quantile_cont(day_night_ratio, 0.25), 6) AS q25,
         round(quantile_cont(day_night_ratio, 0.75), 6) AS q75, round(stddev(day_night_ratio), 6) AS std FROM day_night GROUP BY ALL""",
)
def day_night_summary(i: Inputs) -> DataFrame:
    out = stats.summary(
        population.day_night(i.lp), ["age_10"], "day_night_ratio",
        {"median": 0.5, "q25": 0.25, "q75": 0.75}, [F.stddev("day_night_ratio").alias("std")],
    )
    return rounded(out, "median", "q25", "q75", "std")


@query("a44_weekday_gap", "SELECT admdong_cd, age_10, weekday, weekend, round(diff, 6) AS diff, round(rel_diff, 6) AS rel_diff FROM gap")
def weekday_gap(i: Inputs) -> DataFrame:
    return rounded(population.weekday_weekend_gap(i.lp), "diff", "rel_diff")


@query(
    "a45_weekday_gap_summary",
    """SELECT age_10, round(median(rel_diff), 6) AS median_rel_diff, round(quantile_cont(rel_diff, 0.1), 6) AS q10,
         round(quantile_cont(rel_diff, 0.9), 6) AS q90, round(sum(diff), 4) AS sum_diff FROM gap GROUP BY ALL""",
)
def weekday_gap_summary(i: Inputs) -> DataFrame:
    out = stats.summary(
        population.weekday_weekend_gap(i.lp), ["age_10"], "rel_diff",
        {"median_rel_diff": 0.5, "q10": 0.1, "q90": 0.9}, [F.sum("diff").alias("_s")],
    )
    out = out.withColumn("sum_diff", F.round("_s", 4)).drop("_s")
    return rounded(out, "median_rel_diff", "q10", "q90")


def _cv(table: str, value: str) -> str:
    return f"""(SELECT age_10, stddev(x) / avg(x) AS cv FROM (SELECT age_10, hour, sum({value}) AS x FROM {table} GROUP BY ALL) GROUP BY ALL)"""


@query(
    "a46_indicators",
    f"""SELECT age_10, round(avg_pop_total, 0) AS avg_pop, round(total_moves / avg_pop_total, 2) AS moves_per_capita,
          round(p.cv, 3) AS pop_hourly_cv, round(m.cv, 3) AS move_hourly_cv, round(dn, 3) AS day_night_ratio_median
        FROM avg_pop JOIN (SELECT age_10, sum(total) AS total_moves FROM od GROUP BY ALL) USING (age_10)
        JOIN {_cv('lp', 'pop')} p USING (age_10) JOIN {_cv('od', 'total')} m USING (age_10)
        JOIN (SELECT age_10, median(day_night_ratio) AS dn FROM day_night GROUP BY ALL) USING (age_10)""",
)
def indicators(i: Inputs) -> DataFrame:
    return population.indicators(i.lp, i.od)


@query("a47_hourly_area_mean", "SELECT * FROM hourly")
def hourly_area_mean(i: Inputs) -> DataFrame:
    return population.hourly_area_mean(i.lp)


@query(
    "a48_colour_bounds",
    "SELECT round(quantile_cont(pop_avg, 0.05), 6) AS vmin, round(quantile_cont(pop_avg, 0.99), 6) AS vmax FROM hourly WHERE pop_avg > 0",
)
def colour_bounds(i: Inputs) -> DataFrame:
    return rounded(population.colour_bounds(population.hourly_area_mean(i.lp), "pop_avg"), "vmin", "vmax")


DENSITY = {"q0": 0.0, "q5": 0.05, "q50": 0.5, "q95": 0.95, "q99": 0.99, "q100": 1.0}


@query(
    "a49_density_quantiles",
    "SELECT " + ", ".join(f"round(quantile_cont(pop_avg / area_km2, {q}), 6) AS {n}" for n, q in DENSITY.items())
    + " FROM hourly JOIN area_geo USING (admdong_cd)",
)
def density_quantiles(i: Inputs) -> DataFrame:
    dense = geo.density(population.hourly_area_mean(i.lp), geo.measure(i.area_polygons, "admdong_cd"))
    return rounded(stats.summary(dense, [], "density", DENSITY), *DENSITY)


@query("a57_region_age", "SELECT sido_nm, age_idx, sum(pop)::BIGINT AS pop FROM census15 GROUP BY ALL")
def region_age(i: Inputs) -> DataFrame:
    return census.to_15_groups(i.census5).groupBy("sido_nm", "age_idx").agg(F.sum("pop").alias("pop"))


# The names in the table region, blanks as in the bindings.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE_EAST"]


@query(
    "a57_region_age_pivot",
    "SELECT age_idx, " + ", ".join(f'sum(pop) FILTER (sido_nm = \'{r}\')::BIGINT AS {r.lower()}' for r in REGIONS)
    + " FROM census15 GROUP BY ALL",
)
def region_age_pivot(i: Inputs) -> DataFrame:
    wide = census.to_15_groups(i.census5).groupBy("age_idx").pivot("sido_nm", REGIONS).agg(F.sum("pop"))
    return wide.toDF("age_idx", *[r.lower() for r in REGIONS])


@query(
    "a66_distinct_counts",
    """SELECT count(DISTINCT admdong_cd) AS n_areas, count(DISTINCT hour) AS n_hours, count(DISTINCT date) AS n_dates,
         count(DISTINCT age_10) AS n_ages, min(pop) AS min_pop, max(pop) AS max_pop FROM lp""",
)
def distinct_counts(i: Inputs) -> DataFrame:
    return i.lp.agg(
        F.count_distinct("admdong_cd").alias("n_areas"),
        F.count_distinct("hour").alias("n_hours"),
        F.count_distinct("date").alias("n_dates"),
        F.count_distinct("age_10").alias("n_ages"),
        F.min("pop").alias("min_pop"),
        F.max("pop").alias("max_pop"),
    )


@query(
    "w01_hourly_population_normalised",
    "SELECT age_10, hour, sum(pop) AS pop_sum, sum(pop) / avg(sum(pop)) OVER (PARTITION BY age_10) AS normalised FROM lp GROUP BY age_10, hour",
)
def hourly_population_normalised(i: Inputs) -> DataFrame:
    hourly = population.hourly_totals(i.lp, "pop", "age_10", alias="pop_sum")
    return stats.relative_to_group_mean(hourly, ["age_10"], "pop_sum", "normalised")


@query(
    "t05_top_increase",
    """SELECT age_10, admdong_cd, round(diff, 6) AS diff, rank FROM (SELECT *, row_number() OVER (PARTITION BY age_10 ORDER BY diff DESC, admdong_cd)::INTEGER AS rank
       FROM gap WHERE age_10 IN (0, 10)) WHERE rank <= 10""",
)
def top_increase(i: Inputs) -> DataFrame:
    gap = population.weekday_weekend_gap(i.lp).filter(F.col("age_10").isin(0, 10))
    top = stats.top_per_group(gap, ["age_10"], [F.desc("diff"), F.col("admdong_cd")], 10)
    return rounded(top.select("age_10", "admdong_cd", "diff", "rank"), "diff")


@query(
    "t06_outlier_areas",
    """(SELECT 'high' AS side, admdong_cd, age_10, census_pop, night_avg, detection_rate FROM detection WHERE age_10 IN (20, 30)
         AND detection_rate > 0.4 ORDER BY detection_rate DESC, admdong_cd, age_10 LIMIT 20)
       UNION ALL (SELECT 'low', admdong_cd, age_10, census_pop, night_avg, detection_rate FROM detection WHERE age_10 IN (20, 30)
         AND detection_rate < 0.2 ORDER BY detection_rate, admdong_cd, age_10 LIMIT 20)""",
)
def outlier_areas(i: Inputs) -> DataFrame:
    return population.outlier_areas(population.detection(i.lp, i.census10, 50), 0.4, 0.2)
