"""Projections, filters and scalar functions (P), set operations and samples (U, T07)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow import vocab
from ebbflow.functions import calendar, columns as c
from ebbflow.joins import small
from ebbflow.operators import census, claims, codebook, geo
from ebbflow.plans.bindings import Inputs
from ebbflow.plans.catalog import query, rounded


@query("p01_region_filter", "SELECT admdong_cd, age_5_start, pop_5 FROM census5 WHERE sido_nm IN ('AFRICA', 'AMERICA', 'ASIA')")
def region_filter(i: Inputs) -> DataFrame:
    kept = i.census5.filter(F.col("sido_nm").isin("AFRICA", "AMERICA", "ASIA"))
    return kept.select("admdong_cd", "age_5_start", "pop_5")


@query(
    "p02_both_ends_filter",
    """SELECT ETL_YMD, count(*) AS n, sum(TOTAL) AS total FROM od_raw
       WHERE O_CELL_ID IN (SELECT cell_id FROM cells) AND D_CELL_ID IN (SELECT cell_id FROM cells) GROUP BY ALL""",
)
def both_ends_filter(i: Inputs) -> DataFrame:
    cells = small(i.cells, ["cell_id"])
    kept = i.od_raw.join(cells.toDF("O_CELL_ID"), "O_CELL_ID", "left_semi").join(
        cells.toDF("D_CELL_ID"), "D_CELL_ID", "left_semi"
    )
    return kept.groupBy("ETL_YMD").agg(F.count("*").alias("n"), F.sum("TOTAL").alias("total"))


@query(
    "p03_claims_filter",
    """SELECT date, sido_code, age_group, sum(episodes)::BIGINT AS episodes FROM claims
       WHERE sido_code IN (11, 28, 41) AND age_group IN ('0-5', '65+') AND sex = 'M'
         AND date BETWEEN DATE '1996-09-01' AND DATE '1998-08-31' GROUP BY ALL""",
)
def claims_filter(i: Inputs) -> DataFrame:
    kept = claims.select(
        {"outpatient_inpatient": i.claims}, "outpatient_inpatient", vocab.CLAIMS_CAPITAL_CODES,
        ["0-5", "65+"], "M", ("1996-09-01", "1998-08-31"),
    )
    return kept.groupBy("date", "sido_code", "age_group").agg(F.sum("episodes").alias("episodes"))


@query("p04_hour_of_code", "SELECT substr(TIME_CD, 1, 2)::INTEGER AS hour, count(*) AS n FROM od_raw GROUP BY ALL")
def hour_of_code(i: Inputs) -> DataFrame:
    return i.od_raw.groupBy(c.hour_of(F.col("TIME_CD")).alias("hour")).agg(F.count("*").alias("n"))


@query(
    "p05_age_decade",
    "SELECT substr(SEX_AGE_CD, 2, 2)::INTEGER // 10 * 10 AS age_10, sum(POP) AS pop FROM lp_raw GROUP BY ALL",
)
def age_decade(i: Inputs) -> DataFrame:
    return i.lp_raw.groupBy(c.age10_of(F.col("SEX_AGE_CD")).alias("age_10")).agg(F.sum("POP").alias("pop"))


@query("p06_age_five", "SELECT substr(SEX_AGE_CD, 2, 2)::INTEGER AS age_5, sum(POP) AS pop FROM lp_raw GROUP BY ALL")
def age_five(i: Inputs) -> DataFrame:
    return i.lp_raw.groupBy(c.age5_of(F.col("SEX_AGE_CD")).alias("age_5")).agg(F.sum("POP").alias("pop"))


@query(
    "p07_top_coding",
    """SELECT least(age_5_start, 70)::INTEGER AS top_70, least(age_5_start, 70)::INTEGER // 5 AS age_idx,
         least(age_5_start, 80)::INTEGER // 10 * 10 AS age_10, sum(pop_5)::BIGINT AS pop FROM census5 GROUP BY ALL""",
)
def top_coding(i: Inputs) -> DataFrame:
    age = F.col("age_5_start")
    return i.census5.groupBy(
        c.top_code(age, 70).alias("top_70"), c.age_idx15(age).alias("age_idx"), c.age10_from_age5(age).alias("age_10")
    ).agg(F.sum("pop_5").alias("pop"))


@query(
    "p08_strict_map",
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'M' ELSE 'F' END AS sex, o_orderkey % 6 AS grp, count(*) AS n
       FROM orders GROUP BY ALL""",
)
def strict_map(i: Inputs) -> DataFrame:
    age = c.strict_map(F.col("연령군"), vocab.CLAIMS_AGE_LABELS, "age group")
    rank = F.array_position(F.array(*[F.lit(a) for a in vocab.CLAIMS_AGE_GROUPS]), age) - 1
    sex = c.strict_map(F.col("성별"), vocab.CLAIMS_SEXES, "sex")
    return i.claims_raw.groupBy(sex.alias("sex"), rank.alias("grp")).agg(F.count("*").alias("n"))


@query(
    "p09_map_with_default",
    """SELECT CASE substr(c_custkey::VARCHAR, 1, 2) WHEN '11' THEN '서울' WHEN '28' THEN '인천' WHEN '41' THEN '경기'
         ELSE 'unknown' END AS sido, count(*) AS n FROM customer GROUP BY ALL""",
)
def map_with_default(i: Inputs) -> DataFrame:
    code = F.col("c_custkey").cast("string")
    return i.table("customer").groupBy(c.sido_by_prefix(code).alias("sido")).agg(F.count("*").alias("n"))


@query("p10_drop_subtotals", "SELECT count(DISTINCT admdong_cd) AS n_rows FROM census5")
def drop_subtotals(i: Inputs) -> DataFrame:
    return census.without_subtotals(i.census_text).agg(F.count("*").alias("n_rows"))


@query(
    "p11_split_code",
    """SELECT DISTINCT sido_nm || ' ' || sgg_nm || ' ' || admdong_nm AS addr, admdong_cd || '00' AS code FROM census5""",
)
def split_code(i: Inputs) -> DataFrame:
    text = F.col(vocab.CENSUS_AREA_COLUMN)
    rows = census.split_area(census.without_subtotals(i.census_text))
    return rows.select(
        F.regexp_extract(text, vocab.CENSUS_AREA_PATTERN, 1).alias("addr"), F.col("admdong_cd_10").alias("code")
    )


@query("p12_split_address", "SELECT DISTINCT sido_nm, sgg_nm, admdong_nm FROM census5")
def split_address(i: Inputs) -> DataFrame:
    return census.split_area(census.without_subtotals(i.census_text)).select("sido_nm", "sgg_nm", "admdong_nm")


@query(
    "p13_plain_numbers",
    "SELECT admdong_cd || '00' AS code, "
    + ", ".join(f"sum(pop_5) FILTER (age_5_start = {a})::BIGINT AS pop_{a}" for a in range(0, 101, 5))
    + " FROM census5 GROUP BY ALL",
)
def plain_numbers(i: Inputs) -> DataFrame:
    rows = census.split_area(census.without_subtotals(i.census_text))
    numbers = [
        F.nullif(c.plain_number(F.col(f"`{name}`")), F.lit(0)).alias(f"pop_{age}")
        for name, age in census.age_columns(rows.columns).items()
    ]
    return rows.select(F.col("admdong_cd_10").alias("code"), *numbers)


@query("p14_wide_to_long", "SELECT admdong_cd, age_5_start, pop_5 FROM census5 WHERE pop_5 > 0")
def wide_to_long(i: Inputs) -> DataFrame:
    long = census.parse(i.census_text).filter(F.col("pop_5") > 0)
    return long.select("admdong_cd", "age_5_start", "pop_5")


@query("p15_truncate_codes", "SELECT DISTINCT admdong_cd, length(admdong_cd || '00') AS full_length FROM census5")
def truncate_codes(i: Inputs) -> DataFrame:
    rows = census.split_area(census.without_subtotals(i.census_text))
    return rows.select(
        F.substring("admdong_cd_10", 1, 8).alias("admdong_cd"),
        F.length("admdong_cd_10").cast("long").alias("full_length"),
    )


@query(
    "p16_ymd_to_date",
    "SELECT date, make_date(date // 10000, date // 100 % 100, date % 100) AS day, n_orders FROM cal_dates",
)
def ymd_to_date(i: Inputs) -> DataFrame:
    return i.cal_dates.select("date", calendar.to_date(F.col("date")).alias("day"), "n_orders")


@query(
    "p17_iso_week",
    """SELECT date_trunc('week', date)::DATE AS week_start_date, isoyear(date)::INTEGER AS iso_year,
         weekofyear(date)::INTEGER AS iso_week, count(*) AS n FROM claims GROUP BY ALL""",
)
def iso_week(i: Inputs) -> DataFrame:
    daily = i.claims.groupBy("date").agg(F.count("*").alias("_n"))
    return (
        calendar.with_iso_week(daily)
        .groupBy("week_start_date", "iso_year", "iso_week")
        .agg(F.sum("_n").alias("n"))
    )


@query(
    "p18_within_cross",
    """SELECT CASE WHEN o_admdong_cd = d_admdong_cd THEN 'within' ELSE 'cross' END AS kind, count(*) AS n,
         sum(total) AS total FROM od GROUP BY ALL""",
)
def within_cross(i: Inputs) -> DataFrame:
    kind = c.kind_of(F.col("o_admdong_cd"), F.col("d_admdong_cd"))
    return i.od.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.sum("total").alias("total"))


@query("p19_distance_bands", "SELECT dist_bin, count(*) AS n, sum(total) AS total FROM bands GROUP BY ALL")
def distance_bands(i: Inputs) -> DataFrame:
    trips = geo.with_straight_distance(i.od, geo.measure(i.area_polygons, "admdong_cd"))
    return trips.groupBy(c.distance_band(F.col("straight_dist_m")).alias("dist_bin")).agg(
        F.count("*").alias("n"), F.sum("total").alias("total")
    )


@query(
    "p20_guarded_ratio",
    """SELECT date, sum(AVG_DIST) / nullif(sum(AVG_TIME), 0) AS metres_per_minute FROM trips
       GROUP BY date""",
)
def guarded_ratio(i: Inputs) -> DataFrame:
    trips = i.trips
    return trips.groupBy("date").agg(
        c.ratio(F.sum("avg_dist"), F.sum("avg_time")).alias("metres_per_minute")
    )


@query(
    "p21_speeds",
    """SELECT age_10, round(avg(d / 1000 / (t / 60)), 6) AS dist_m_time_min, round(avg(d / 1000 / (t * 10 / 60)), 6) AS dist_m_time_10min,
         round(avg(d * 100 / 1000 / (t / 60)), 6) AS dist_100m_time_min, round(avg(d * 100 / 1000 / (t * 10 / 60)), 6) AS dist_100m_time_10min
       FROM (SELECT age_10, AVG_DIST AS d, nullif(AVG_TIME, 0) AS t FROM trips) GROUP BY ALL""",
)
def speeds(i: Inputs) -> DataFrame:
    trips = i.trips
    d, t = F.col("avg_dist"), F.col("avg_time")
    return trips.groupBy("age_10").agg(
        *[F.round(F.avg(c.speed_kmh(d, t, h)), 6).alias(h) for h in vocab.SPEED_HYPOTHESES]
    )


@query(
    "p22_straight_distance",
    """SELECT o_admdong_cd, d_admdong_cd, round(any_value(straight_dist_m), 6) AS straight_dist_m, count(*) AS n
       FROM straight GROUP BY ALL""",
)
def straight_distance(i: Inputs) -> DataFrame:
    trips = geo.with_straight_distance(i.od, geo.measure(i.area_polygons, "admdong_cd"))
    out = trips.groupBy("o_admdong_cd", "d_admdong_cd").agg(
        F.max("straight_dist_m").alias("straight_dist_m"), F.count("*").alias("n")
    )
    return rounded(out, "straight_dist_m")


@query(
    "p23_null_filters",
    """SELECT age_10, count(avg_time) AS n_known, count(*) FILTER (avg_time > 0) AS n_positive,
         count(*) FILTER (avg_dist > 0 AND avg_dist < 20000) AS n_in_range, sum(coalesce(nullif(avg_time, 0), 0)) AS filled
       FROM (SELECT age_10, AVG_TIME AS avg_time, AVG_DIST AS avg_dist FROM trips) GROUP BY ALL""",
)
def null_filters(i: Inputs) -> DataFrame:
    trips = i.trips
    t, d = F.col("avg_time"), F.col("avg_dist")
    return trips.groupBy("age_10").agg(
        F.count(c.none_if_nan(t)).alias("n_known"),
        F.count_if(t > 0).alias("n_positive"),
        F.count_if((d > 0) & (d < 20000)).alias("n_in_range"),
        F.sum(F.coalesce(F.nullif(t, F.lit(0.0)), F.lit(0.0))).alias("filled"),
    )


@query("p24_code_lengths", "SELECT length(cell_id) AS code_length, count(*) AS n_codes FROM cells GROUP BY ALL")
def code_lengths(i: Inputs) -> DataFrame:
    cells = i.cells.select(F.col("cell_id").alias("admdong_cd"))
    return codebook.code_lengths(cells).withColumn("code_length", F.col("code_length").cast("long"))


@query(
    "p25_year_prefix",
    "SELECT substr(yyyymm, 1, 4) AS year, count(*) AS n_months, sum(total) AS total FROM months GROUP BY ALL",
)
def year_prefix(i: Inputs) -> DataFrame:
    from ebbflow.operators import series

    months = series.monthly_totals(i.od, "total")
    return months.groupBy(c.year_of_key(F.col("yyyymm")).alias("year")).agg(
        F.count("*").alias("n_months"), F.sum("total").alias("total")
    )


@query("p26_rounding", "SELECT age_10, round(sum(pop) / count(*), 2) AS mean_pop, round(sum(pop) / 1000, 0) AS thousands FROM lp GROUP BY ALL")
def rounding(i: Inputs) -> DataFrame:
    return i.lp.groupBy("age_10").agg(
        F.round(F.avg("pop"), 2).alias("mean_pop"), F.round(F.sum("pop") / 1000, 0).alias("thousands")
    )


@query("t07_head_sample", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def head_sample(i: Inputs) -> DataFrame:
    return i.table("customer").select("c_custkey", "c_name").orderBy("c_custkey").limit(10)


@query("u01_concat", "SELECT admdong_cd, pop_5 AS pop FROM census5 UNION ALL SELECT admdong_cd, pop FROM census10")
def concat(i: Inputs) -> DataFrame:
    five = i.census5.select("admdong_cd", F.col("pop_5").alias("pop"))
    return five.unionByName(i.census10.select("admdong_cd", "pop"))


@query("u02_distinct", "SELECT DISTINCT date, age_10 FROM od")
def distinct(i: Inputs) -> DataFrame:
    return i.od.select("date", "age_10").distinct()


@query(
    "u03_code_sets",
    """SELECT * FROM (SELECT 'both' AS side, l_partkey AS code FROM lineitem INTERSECT SELECT 'both', l_suppkey FROM lineitem)
       UNION ALL (SELECT 'left', p_partkey FROM part EXCEPT SELECT 'left', l_suppkey FROM lineitem)""",
)
def code_sets(i: Inputs) -> DataFrame:
    line, part = i.table("lineitem"), i.table("part")
    supp = line.select(F.col("l_suppkey").alias("code"))
    both = line.select(F.col("l_partkey").alias("code")).intersect(supp)
    left = part.select(F.col("p_partkey").alias("code")).subtract(supp)
    tag = lambda df, side: df.select(F.lit(side).alias("side"), "code")
    return tag(both, "both").unionByName(tag(left, "left"))


@query(
    "u04_first_per_key",
    """SELECT zone, region, geom_type FROM (SELECT (s_suppkey // 3)::VARCHAR AS zone, region, geom_type, row_number() OVER (PARTITION BY s_suppkey // 3
         ORDER BY region, s_suppkey DESC) AS rn FROM zones) WHERE rn = 1""",
)
def first_per_key(i: Inputs) -> DataFrame:
    key = F.col("zone").cast("long")
    rows = i.zones.select(F.floor(key / 3).cast("string").alias("group"), "region", "geom_type", (-key).alias("_o"))
    one = geo.first_per_key(rows, "group", ["region", "_o"])
    return one.select(F.col("group").alias("zone"), "region", "geom_type")
