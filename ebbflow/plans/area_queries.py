"""Joins between the sources (J) and code-set reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow.functions.columns import lookup
from ebbflow.joins import small
from ebbflow.operators import census, employment, geo, population, mobility, quality, series
from ebbflow.plans.bindings import Inputs
from ebbflow.plans.catalog import query, rounded
from ebbflow.plans.source_queries import MOVEMENT_ORDER
from ebbflow.session import settled, shared_dir
from ebbflow.sources import readers, sinks


@query(
    "j01_both_cells",
    "SELECT o_admdong_cd, d_admdong_cd, purpose, count(*) AS n, sum(TOTAL) AS total FROM trips GROUP BY ALL",
)
def both_cells(i: Inputs) -> DataFrame:
    return (
        i.trips
        .groupBy("o_admdong_cd", "d_admdong_cd", "purpose")
        .agg(F.count("*").alias("n"), F.sum("total").alias("total"))
    )


@query(
    "j02_names_after_aggregation",
    """SELECT p.admdong_cd, c.admdong_nm, p.pop FROM (SELECT ADMDONG_CD AS admdong_cd, sum(POP) AS pop FROM lp_raw GROUP BY ALL) p
       LEFT JOIN capital c ON p.admdong_cd = c.admdong_cd""",
)
def names_after_aggregation(i: Inputs) -> DataFrame:
    sums = i.lp_raw.groupBy(F.col("ADMDONG_CD").alias("admdong_cd")).agg(F.sum("POP").alias("pop"))
    return sums.join(small(i.capital, ["admdong_cd", "admdong_nm"]), "admdong_cd", "left")


@query("j03_scaffold", "SELECT * FROM census15")
def scaffold(i: Inputs) -> DataFrame:
    return census.scaffold_15(i.census5)


@query("j04_night_with_census", "SELECT n.admdong_cd, age_10, night_avg, c.pop FROM night n JOIN census10 c USING (admdong_cd, age_10)")
def night_with_census(i: Inputs) -> DataFrame:
    registered = i.census10.select("admdong_cd", "age_10", "pop")
    return population.night_mean(i.lp).join(registered, ["admdong_cd", "age_10"])


@query(
    "j05_totals_with_population",
    """SELECT m.age_10, total_moves, avg_pop_total FROM (SELECT age_10, sum(total) AS total_moves FROM od GROUP BY ALL) m
       JOIN avg_pop USING (age_10)""",
)
def totals_with_population(i: Inputs) -> DataFrame:
    moves = i.od.groupBy("age_10").agg(F.sum("total").alias("total_moves"))
    return moves.join(population.mean_population_by_age(i.lp), "age_10")


@query(
    "j06_inflow_outflow",
    """SELECT admdong_cd, coalesce(inflow, 0) AS inflow, coalesce(outflow, 0) AS outflow FROM
       (SELECT d_admdong_cd AS admdong_cd, sum(total) AS inflow FROM od WHERE o_admdong_cd <> d_admdong_cd GROUP BY ALL)
       FULL JOIN (SELECT o_admdong_cd AS admdong_cd, sum(total) AS outflow FROM od WHERE o_admdong_cd <> d_admdong_cd GROUP BY ALL)
       USING (admdong_cd)""",
)
def inflow_outflow(i: Inputs) -> DataFrame:
    return mobility.inflow_outflow_join(i.od)


@query(
    "j07_with_centroids",
    """SELECT o_admdong_cd, d_admdong_cd, count(*) AS n, round(min(ratio), 6) AS min_ratio, round(max(ratio), 6) AS max_ratio FROM straight GROUP BY ALL""",
)
def with_centroids(i: Inputs) -> DataFrame:
    trips = geo.with_straight_distance(i.od, geo.measure(i.area_polygons, "admdong_cd"))
    out = trips.groupBy("o_admdong_cd", "d_admdong_cd").agg(
        F.count("*").alias("n"), F.min("ratio").alias("min_ratio"), F.max("ratio").alias("max_ratio")
    )
    return rounded(out, "min_ratio", "max_ratio")


@query("j08_file_sizes", "SELECT yyyymm, n_rows, total, true AS has_file FROM months")
def file_sizes(i: Inputs) -> DataFrame:
    """Monthly series met by the sizes of the files the month was written to."""
    path, od = shared_dir(i.spark), settled(i.od)
    sinks.write_months(od, path, MOVEMENT_ORDER)
    return _with_files(od, path)


@query(
    "j08_months_without_file",
    "SELECT yyyymm, n_rows, total, yyyymm::INTEGER % 4 <> 0 AS has_file FROM months",
)
def months_without_file(i: Inputs) -> DataFrame:
    """The same where every fourth month was not written."""
    path, od = shared_dir(i.spark), settled(i.od)
    sinks.write_months(od.filter(F.floor(F.col("date") / 100) % 4 != 0), path, ["date", "hour"])
    return _with_files(od, path)


def _with_files(od: DataFrame, path: str) -> DataFrame:
    """`od` is a stored table: it is read for the files and again for the series."""
    sizes = (
        readers.files(od.sparkSession, path, "*.parquet")
        .groupBy("yyyymm")
        .agg(F.sum("bytes").alias("bytes"))
    )
    months = series.monthly_totals(od, "total").join(sizes, "yyyymm", "left")
    return months.select(
        "yyyymm", "n_rows", "total", F.coalesce(F.col("bytes") > 0, F.lit(False)).alias("has_file")
    )


@query(
    "j09_all_areas_at_hour",
    """SELECT a.admdong_cd, h.pop_avg FROM areas a LEFT JOIN hourly h ON a.admdong_cd = h.admdong_cd AND h.hour = 12""",
)
def all_areas_at_hour(i: Inputs) -> DataFrame:
    at_noon = population.hourly_area_mean(i.lp.filter(F.col("hour") == 12)).drop("hour")
    return i.area_polygons.select("admdong_cd").join(at_noon, "admdong_cd", "left")


@query(
    "j10_density",
    "SELECT hour, admdong_cd, pop_avg, area_km2, pop_avg / area_km2 AS density FROM hourly JOIN area_geo USING (admdong_cd)",
)
def density(i: Inputs) -> DataFrame:
    measured = geo.measure(i.area_polygons, "admdong_cd")
    return geo.density(population.hourly_area_mean(i.lp), measured)


MATCH = """
    SELECT count(l) AS n_left, count(r) AS n_right, count(*) FILTER (l IS NOT NULL AND r IS NOT NULL) AS n_matched
    FROM (SELECT DISTINCT l_suppkey * 3 AS l FROM lineitem) FULL JOIN (SELECT DISTINCT p_partkey AS r FROM part) ON l = r"""


@query(
    "j11_code_reconciliation",
    f"""SELECT *, n_left - n_matched AS only_left, n_right - n_matched AS only_right,
          n_matched / greatest(n_left, 1) * 100 AS pct_of_left, n_matched / greatest(n_right, 1) * 100 AS pct_of_right
        FROM ({MATCH})""",
)
def code_reconciliation(i: Inputs) -> DataFrame:
    left = i.table("lineitem").select((F.col("l_suppkey") * 3).alias("code"))
    right = i.table("part").select(F.col("p_partkey").alias("code"))
    return quality.code_sets(left, right, "code")


@query(
    "j11_one_sided_codes",
    """SELECT l AS code, 'left' AS side FROM (SELECT DISTINCT l_suppkey * 3 AS l FROM lineitem) WHERE l NOT IN (SELECT p_partkey FROM part)
       UNION ALL SELECT p_partkey, 'right' FROM part WHERE p_partkey NOT IN (SELECT l_suppkey * 3 FROM lineitem)""",
)
def one_sided_codes(i: Inputs) -> DataFrame:
    left = i.table("lineitem").select((F.col("l_suppkey") * 3).alias("code"))
    right = i.table("part").select(F.col("p_partkey").alias("code"))
    return quality.one_sided(left, right, "code")


RHO_SIDO = {"AFRICA": "서울", "AMERICA": "인천", "ASIA": "경기"}


@query(
    "j12_area_rates",
    """SELECT a.admdong_cd, a.sido_nm, g.age_idx, CASE WHEN g.age_idx < 3 THEN 0.0
         ELSE coalesce(e.employment_rate, 0.25) END::DOUBLE AS rho
       FROM (SELECT admdong_cd, CASE sido_nm WHEN 'AFRICA' THEN '서울' WHEN 'AMERICA' THEN '인천' WHEN 'ASIA' THEN '경기' ELSE 'unknown' END AS sido_nm FROM areas) a
       CROSS JOIN (SELECT unnest(range(15))::INTEGER AS age_idx) g
       LEFT JOIN employment e ON e.sido_nm = a.sido_nm AND e.age_idx = g.age_idx""",
)
def area_rates(i: Inputs) -> DataFrame:
    return employment.area_rates(
        i.areas.select("admdong_cd", F.col("sido_nm").alias("_region")), i.rates,
        sido=lookup(F.col("_region"), RHO_SIDO, "unknown"), fill_unknown=0.25,
    )


@query(
    "j13_outside_region",
    """SELECT count(*) FILTER (O_CELL_ID NOT IN (SELECT cell_id FROM cells)) AS n_origin_outside,
         count(*) FILTER (D_CELL_ID NOT IN (SELECT cell_id FROM cells)) AS n_destination_outside FROM od_raw""",
)
def outside_region(i: Inputs) -> DataFrame:
    return mobility.outside_report(i.od_raw, i.cells)


@query(
    "j14_unmapped",
    """SELECT count(*) AS n_rows, count(*) FILTER (o AND d) AS n_mapped, count(*) FILTER (NOT (o AND d)) AS n_unmapped FROM (
         SELECT o_admdong_cd >= '00005000' AND o_admdong_cd < '02' AS o, d_admdong_cd >= '00005000' AND d_admdong_cd < '02' AS d FROM od)""",
)
def unmapped(i: Inputs) -> DataFrame:
    code = F.col("admdong_cd")
    index = mobility.area_index(i.capital.filter((code >= "00005000") & (code < "02")))
    return mobility.unmapped_report(mobility.flag_mapped(i.od, index))
