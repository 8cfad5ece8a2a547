"""Geometry: areas, centroids, point assignment and unit checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow.operators import geo
from ebbflow.plans.bindings import LOT_M, Inputs
from ebbflow.plans.catalog import query, rounded
from ebbflow.session import shared_dir
from ebbflow.sources import agreement, readers, sinks


def _straight(i: Inputs) -> DataFrame:
    return geo.with_straight_distance(i.od, geo.measure(i.area_polygons, "admdong_cd"))


BANDS_SQL = """
    SELECT dist_bin, round(quantile_cont(ratio, 0.25), 6) AS ratio_p25, round(median(ratio), 6) AS ratio_p50,
      round(quantile_cont(ratio, 0.75), 6) AS ratio_p75, round(median(avg_dist), 6) AS avg_dist_p50,
      round(median(straight_dist_m), 6) AS straight_p50, count(*) AS count FROM bands GROUP BY ALL"""


@query("a50_band_consistency", BANDS_SQL)
def band_consistency(i: Inputs) -> DataFrame:
    out = geo.band_consistency(_straight(i))
    return rounded(out, "ratio_p25", "ratio_p50", "ratio_p75", "avg_dist_p50", "straight_p50")


CV = "(SELECT stddev(m) / avg(m) FROM (SELECT median(ratio) AS m FROM bands GROUP BY dist_bin))"


@query("a50_band_verdict", f"SELECT round({CV}, 6) AS ratio_cv, {CV} < 0.3 AS consistent")
def band_verdict(i: Inputs) -> DataFrame:
    return rounded(geo.band_verdict(geo.band_consistency(_straight(i))), "ratio_cv")


SPEEDS = " UNION ALL ".join(
    f"SELECT '{h}' AS hypothesis, {expr} AS speed FROM straight WHERE avg_time > 0 AND straight_dist_m > 500"
    for h, expr in (
        ("dist_m_time_min", "avg_dist / 1000 / (avg_time / 60)"),
        ("dist_m_time_10min", "avg_dist / 1000 / (avg_time * 10 / 60)"),
        ("dist_100m_time_min", "avg_dist * 100 / 1000 / (avg_time / 60)"),
        ("dist_100m_time_10min", "avg_dist * 100 / 1000 / (avg_time * 10 / 60)"),
    )
)


@query(
    "a51_speed_table",
    f"""SELECT hypothesis, round(quantile_cont(speed, 0.25), 6) AS p25, round(median(speed), 6) AS p50,
          round(quantile_cont(speed, 0.75), 6) AS p75, median(speed) BETWEEN 10 AND 50 AS plausible
        FROM ({SPEEDS}) WHERE speed > 0 AND speed < 1000 GROUP BY ALL""",
)
def speed_table(i: Inputs) -> DataFrame:
    return rounded(geo.speed_table(_straight(i)), "p25", "p50", "p75")


@query(
    "a52_unit_verdicts",
    f"""SELECT round(same_p50, 6) AS same_p50, round(ratio_p50, 6) AS ratio_p50, round(ratio_cv, 6) AS ratio_cv,
          CASE WHEN same_p50 BETWEEN 100 AND 2000 THEN 'm' WHEN same_p50 BETWEEN 1 AND 20 THEN '100m' ELSE 'other' END AS same_verdict,
          CASE WHEN ratio_p50 BETWEEN 0.8 AND 2.5 THEN 'm' WHEN ratio_p50 BETWEEN 0.005 AND 0.025 THEN '100m' ELSE 'other' END AS ratio_verdict,
          CASE WHEN ratio_cv < 0.3 THEN 'consistent' ELSE 'not consistent' END AS band_verdict
        FROM (SELECT (SELECT median(avg_dist) FROM od WHERE o_admdong_cd = d_admdong_cd AND avg_dist > 0) AS same_p50,
          (SELECT median(ratio) FROM straight) AS ratio_p50, {CV} AS ratio_cv)""",
)
def unit_verdicts(i: Inputs) -> DataFrame:
    facts = geo.unit_medians(i.od, geo.measure(i.area_polygons, "admdong_cd"))
    return rounded(geo.unit_verdicts(facts), "same_p50", "ratio_p50", "ratio_cv")


@query(
    "a63_bounding_box",
    """SELECT *, CASE WHEN x_min BETWEEN 700000 AND 1200000 AND y_min BETWEEN 1500000 AND 2100000 THEN 'EPSG:5179'
         WHEN x_min BETWEEN 100000 AND 300000 AND y_min BETWEEN 400000 AND 700000 THEN 'EPSG:5186' ELSE 'unknown' END AS crs_guess
       FROM (SELECT min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max, count(*) AS n_rows FROM points)""",
)
def bounding_box(i: Inputs) -> DataFrame:
    return geo.bounding_box(i.points, "x", "y")


@query("a64_region_report", "SELECT region, geom_type, count(*) AS n_polygons, true AS crs_agrees FROM zones GROUP BY ALL")
def region_report(i: Inputs) -> DataFrame:
    return geo.region_report(i.zones)


@query(
    "a64_mixed_systems",
    """SELECT part, region, geom_type, count(*) AS n_polygons, any_value(n) = 1 AS crs_agrees FROM (
         SELECT *, count(DISTINCT crs) OVER (PARTITION BY part) AS n FROM (
           SELECT 'all' AS part, region, geom_type, CASE WHEN region = '2' THEN 'EPSG:5186' ELSE 'EPSG:5179' END AS crs FROM zones
           UNION ALL SELECT 'without 2', region, geom_type, 'EPSG:5179' FROM zones WHERE region <> '2'))
       GROUP BY part, region, geom_type""",
)
def mixed_systems(i: Inputs) -> DataFrame:
    """One region in another reference system; without it the others agree."""
    mixed = i.zones.withColumn("crs", F.when(F.col("region") == "2", "EPSG:5186").otherwise(F.col("crs")))
    reports = [("all", mixed), ("without 2", mixed.filter(F.col("region") != "2"))]
    first, second = [geo.region_report(df).withColumn("part", F.lit(name)) for name, df in reports]
    return first.unionByName(second)


def _months_of_two_kinds(i: Inputs) -> DataFrame:
    """Column lists of a movement table; every third month has the purpose, the others not."""
    path, third = shared_dir(i.spark), F.floor(F.col("date") / 100) % 3 == 0
    sinks.write_months(i.od_purpose.filter(third), path, ["date", "hour"])
    sinks.write_months(i.od.filter(~third), path, ["date", "hour"])
    return agreement.schema_table(i.spark, readers.month_schemas(i.spark, path))


COLUMNS = """(VALUES ('date', 0), ('hour', 1), ('o_admdong_cd', 2), ('d_admdong_cd', 3), ('age_10', 4),
    ('purpose', 5), ('total', 6), ('avg_dist', 7), ('avg_time', 8))"""
KINDS = f"""
    SELECT name, CASE WHEN yyyymm::INTEGER % 3 <> 0 AND p > 5 THEN p - 1 ELSE p END AS place
    FROM {COLUMNS} c(name, p), months WHERE name <> 'purpose' OR yyyymm::INTEGER % 3 = 0"""


@query(
    "a64_column_agreement",
    f"""SELECT name AS "column", count(*) AS n_files, 1::BIGINT AS n_types, count(DISTINCT place) AS n_places,
          CASE WHEN count(*) < (SELECT count(*) FROM months) THEN 'missing' WHEN count(DISTINCT place) > 1 THEN 'order'
            ELSE 'same' END AS verdict FROM ({KINDS}) GROUP BY name""",
)
def column_agreement(i: Inputs) -> DataFrame:
    return agreement.column_agreement(_months_of_two_kinds(i))


@query(
    "a64_file_agreement",
    """SELECT yyyymm AS file, CASE WHEN yyyymm::INTEGER % 3 = 0 THEN 9 ELSE 8 END::BIGINT AS n_columns,
         yyyymm::INTEGER % 3 <> 0 AS agrees FROM months""",
)
def file_agreement(i: Inputs) -> DataFrame:
    return agreement.file_agreement(_months_of_two_kinds(i)).select("file", "n_columns", "agrees")


@query(
    "a65_area_centroid",
    f"""SELECT zone, CASE WHEN notched THEN 0.75 ELSE 1.0 END::DOUBLE AS area_km2,
          round(x0 + CASE WHEN notched THEN {LOT_M} * 5 / 12.0::DOUBLE ELSE {LOT_M} / 2 END, 3) AS ctr_x,
          round(y0 + CASE WHEN notched THEN {LOT_M} * 5 / 12.0::DOUBLE ELSE {LOT_M} / 2 END, 3) AS ctr_y FROM zones""",
)
def area_centroid(i: Inputs) -> DataFrame:
    return rounded(geo.measure(i.zones, "zone"), "ctr_x", "ctr_y", digits=3)


@query(
    "x05_points_in_zones",
    f"""SELECT cell_id, x, y, zone FROM points JOIN zones ON x >= x0 AND x < x0 + {LOT_M} AND y >= y0 AND y < y0 + {LOT_M}
        WHERE NOT (notched AND x >= x0 + {LOT_M} / 2 AND y >= y0 + {LOT_M} / 2)""",
)
def points_in_zones(i: Inputs) -> DataFrame:
    return geo.assign_points(i.points, i.zones, "zone", LOT_M * 2)
