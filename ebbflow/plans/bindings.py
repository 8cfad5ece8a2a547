"""The reference inputs re-created on the driver's tables.

Each input exists twice: as a DataFrame (`Inputs`) and as a SQL common table expression
(`SQL`), so that a query and its oracle start from the same rows. Measures are whole
numbers in double columns: their sums are exact in any order, hence comparable.
"""

from __future__ import annotations

import re
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbflow import joins, vocab
from ebbflow.functions import calendar
from ebbflow.operators import census, claims, codebook, employment, ili, population, mobility

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
CAPITAL = ["00", "01", "02"]
CLAIM_CODES = list(vocab.CLAIMS_SIDO_NAMES)
CLAIM_LABELS = list(vocab.CLAIMS_AGE_LABELS)
REGIONS = list(vocab.EMPLOYMENT_SIDO)
AGE_NAMES = list(vocab.EMPLOYMENT_AGE_IDX)
CENSUS_HEADERS = {
    a: f"2023년01월_계_{a}세 이상" if a == 100 else f"2023년01월_계_{a}~{a + 4}세"
    for a in range(0, 101, 5)
}
BLOCK_M = 8000  # side of an area's square
LOT_M = 1000  # side of a zone's square


def _pick(values: list, index) -> "F.Column":
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


@lru_cache(maxsize=64)
def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One handle per table and session, so that a table is counted once (see `joins`)."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


class Inputs:
    """Lazy views over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return _table(self.spark, self.folder, name)

    # -- area code book and cells ------------------------------------------------------
    @cached_property
    def areas(self) -> DataFrame:
        region, nation = self.table("region"), self.table("nation")
        sido = F.lpad(F.col("r_regionkey").cast("string"), 2, "0")
        sgg = F.concat(sido, F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
        book = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("nationkey"),
            sido.alias("sido_cd"),
            F.replace("r_name", F.lit(" "), F.lit("_")).alias("sido_nm"),
            sgg.alias("sgg_cd"),
            F.concat(F.lit("D_"), F.col("n_name")).alias("sgg_nm"),
            F.concat(sgg, F.lit("000")).alias("admdong_cd"),
            F.col("n_name").alias("admdong_nm"),
        )
        return joins.at_most(book, nation)

    @cached_property
    def capital(self) -> DataFrame:
        return joins.at_most(codebook.region(self.areas, CAPITAL), self.areas)

    @cached_property
    def cells(self) -> DataFrame:
        """Grid cells of the capital region with their area."""
        key = (F.col("p_size") % 25).alias("nationkey")
        named = joins.small(self.areas).filter(F.col("sido_cd").isin(CAPITAL))
        part = self.table("part")
        cells = (
            part.select(F.col("p_partkey").cast("string").alias("cell_id"), key)
            .join(named, "nationkey")
            .select("cell_id", "admdong_cd", "admdong_nm")
        )
        return joins.at_most(cells, part)

    # -- movement ----------------------------------------------------------------------
    @cached_property
    def od_raw(self) -> DataFrame:
        c = F.col
        hour = F.lpad((c("l_orderkey") % 24).cast("string"), 2, "0")
        age = ((F.floor(c("l_orderkey") / 24) + c("l_linenumber")) % 9 * 10).cast("string")
        return self.table("lineitem").select(
            calendar.to_ymd(c("l_shipdate")).alias("ETL_YMD"),
            F.concat(hour, F.lit("00")).alias("TIME_CD"),
            c("l_partkey").cast("string").alias("O_CELL_ID"),
            c("l_suppkey").cast("string").alias("D_CELL_ID"),
            F.when(c("l_orderkey") % 2 == 0, "M").otherwise("F").alias("SEX_CD"),
            F.lpad(age, 2, "0").alias("AGE_CD"),
            c("l_linenumber").cast("byte").alias("PURPOSE"),
            c("l_quantity").alias("TOTAL"),
            F.floor("l_extendedprice").cast("double").alias("AVG_DIST"),
            F.floor(c("l_tax") * 100 + 0.5).cast("double").alias("AVG_TIME"),
        )

    @cached_property
    def trips(self) -> DataFrame:
        return mobility.place_trips(self.od_raw, self.cells)

    @cached_property
    def pi(self) -> DataFrame:
        """Mean weekday flow."""
        return mobility.daily_flow(self.od, dated=self.trips)

    @cached_property
    def od(self) -> DataFrame:
        return mobility.refine(self.od_raw, self.cells)

    @cached_property
    def od_purpose(self) -> DataFrame:
        return mobility.refine(self.od_raw, self.cells, keep_purpose=True)

    # -- hourly population ---------------------------------------------------------------
    @cached_property
    def lp_raw(self) -> DataFrame:
        c = F.col
        digits = F.lpad((c("user_id") % 16 * 5).cast("string"), 2, "0")
        events = self.table("events").select(
            (c("user_id") % 25).cast("int").alias("nationkey"),
            calendar.to_ymd(c("ts")).alias("ETL_YMD"),
            F.lpad(F.hour("ts").cast("string"), 2, "0").alias("TIMEZN_CD"),
            F.concat(F.when(c("user_id") % 2 == 0, "M").otherwise("F"), digits).alias("SEX_AGE_CD"),
            F.floor(c("value") * 100).cast("double").alias("POP"),
        )
        areas = joins.small(self.areas, ["nationkey", "admdong_cd"])
        return events.join(areas, "nationkey").select(
            "ETL_YMD", "TIMEZN_CD", F.col("admdong_cd").alias("ADMDONG_CD"), "SEX_AGE_CD", "POP"
        )

    @cached_property
    def lp(self) -> DataFrame:
        return population.refine(self.lp_raw, self.capital)

    # -- census --------------------------------------------------------------------------
    @cached_property
    def census5(self) -> DataFrame:
        c = F.col
        people = self.table("customer").select(
            c("c_nationkey").alias("nationkey"),
            (c("c_custkey") % 21 * 5).cast("int").alias("age_5_start"),
            F.floor(F.abs("c_acctbal")).alias("pop"),
        )
        sums = people.groupBy("nationkey", "age_5_start").agg(F.sum("pop").alias("pop_5"))
        return sums.join(joins.small(self.areas), "nationkey").select(
            *census.AREA_KEYS, "age_5_start", "pop_5"
        )

    @cached_property
    def census_text(self) -> DataFrame:
        """The census as published: wide text, with a subtotal row per district."""
        cells = [
            F.coalesce(F.format_number(F.max(F.when(F.col("age_5_start") == a, F.col("pop_5"))), 0), F.lit("0")).alias(h)
            for a, h in CENSUS_HEADERS.items()
        ]
        wide = self.census5.groupBy(*census.AREA_KEYS).agg(*cells)
        code = F.concat(F.lit("("), F.col("admdong_cd"), F.lit("00)"))
        heads = list(CENSUS_HEADERS.values())
        dong = F.concat_ws(" ", "sido_nm", "sgg_nm", "admdong_nm")
        subtotal = F.concat_ws(" ", "sido_nm", "sgg_nm", code)
        name = vocab.CENSUS_AREA_COLUMN
        rows = F.explode(F.array(F.concat(dong, code), subtotal)).alias(name)
        return wide.select(rows, *[f"`{h}`" for h in heads])

    @cached_property
    def census10(self) -> DataFrame:
        return census.to_decades(self.census5)

    # -- claims, surveillance --------------------------------------------------------------
    @cached_property
    def claims_raw(self) -> DataFrame:
        c = F.col
        return self.table("orders").select(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("요양개시일자"),
            _pick(CLAIM_CODES, c("o_custkey") % 18).alias("주소(시도)"),
            F.when(c("o_orderstatus") == "F", "남자").otherwise("여자").alias("성별"),
            _pick(CLAIM_LABELS, c("o_orderkey") % 6).alias("연령군"),
            F.lit(1).alias("진료에피소드 건수"),
        )

    @cached_property
    def claims(self) -> DataFrame:
        return claims.normalise(self.claims_raw)

    @cached_property
    def ili_wide(self) -> DataFrame:
        """Season rows per surveillance group: 54 text slots, every 17th slot empty."""
        c = F.col
        per_day = (
            self.table("orders")
            .groupBy(F.to_date("o_orderdate").alias("date"), _pick(vocab.ILI_AGE_GROUPS, c("o_custkey") % 7).alias("age_group"))
            .agg(F.count("*").alias("n"), F.count_if(c("o_orderstatus") == "F").alias("hits"))
        )
        weekly = calendar.with_iso_week(per_day)
        first = c("iso_week") >= vocab.SEASON_FIRST_ISO_WEEK
        start = F.when(first, c("iso_year")).otherwise(c("iso_year") - 1)
        slot = F.when(first, c("iso_week") - 36).otherwise(c("iso_week") + 16)
        sums = weekly.groupBy("age_group", start.alias("start"), slot.alias("slot")).agg(
            F.sum("n").alias("n"), F.sum("hits").alias("hits")
        )
        rate = F.floor(c("hits") * 1000 / c("n")).cast("int").cast("string")
        sums = sums.withColumn("rate", F.when(c("slot") % 17 == 0, "").otherwise(rate))
        slots = [F.max(F.when(c("slot") == i, c("rate"))).alias(n) for i, n in enumerate(ili.SLOT_COLUMNS)]
        season = F.concat(c("start"), F.lit("-"), c("start") + 1, F.lit(vocab.SEASON_SUFFIX))
        return sums.groupBy("age_group", season.alias("season")).agg(*slots)

    @cached_property
    def ili(self) -> DataFrame:
        return ili.to_long(self.ili_wide, ("age_group",))

    # -- contacts, employment ---------------------------------------------------------------
    @cached_property
    def contacts(self) -> DataFrame:
        c = F.col
        return (
            self.table("lineitem")
            .groupBy(
                _pick(vocab.SETTINGS, c("l_linenumber") % 4).alias("setting"),
                (c("l_partkey") % 15).cast("int").alias("participant_idx"),
                (c("l_suppkey") % 15).cast("int").alias("contact_idx"),
            )
            .agg(F.avg("l_quantity").alias("value"))
        )

    @cached_property
    def employment_raw(self) -> DataFrame:
        c = F.col
        sex = F.explode(F.array(F.lit("계"), F.when(c("c_custkey") % 2 == 0, "남자").otherwise("여자")))
        people = self.table("customer").select(
            _pick(REGIONS + ["동부"], c("c_nationkey") % 20).alias("region_raw"),
            sex.alias("sex"),
            _pick(AGE_NAMES, c("c_custkey") % 12).alias("_age"),
            (c("c_acctbal") > 0).alias("works"),
        )
        ages = F.explode(F.array("_age", F.lit(vocab.EMPLOYMENT_TOTAL_AGE))).alias("age_label")
        return (
            people.select("region_raw", "sex", ages, "works")
            .groupBy("region_raw", "sex", "age_label")
            .agg(
                F.count("*").alias("population_15plus"),
                F.count_if("works").alias("worked_total"),
            )
        )

    @cached_property
    def rates(self) -> DataFrame:
        return employment.rates(self.employment_raw)

    # -- geometry -----------------------------------------------------------------------------
    def _polygons(self, df: DataFrame, key: str, x0, y0, side: int, notched) -> DataFrame:
        """A square, or an L where the upper right quarter is missing."""
        half, full = side / 2, float(side)
        p = lambda dx, dy: F.struct((x0 + dx).cast("double").alias("x"), (y0 + dy).cast("double").alias("y"))
        square = F.array(p(0, 0), p(full, 0), p(full, full), p(0, full))
        ell = F.array(p(0, 0), p(full, 0), p(full, half), p(half, half), p(half, full), p(0, full))
        return df.select("*", F.when(notched, ell).otherwise(square).alias("vertices")).drop(
            *[c for c in df.columns if c not in (key, "region", "geom_type", "crs")]
        )

    @cached_property
    def area_polygons(self) -> DataFrame:
        k = F.col("nationkey")
        rings = self._polygons(
            self.areas, "admdong_cd", k % 5 * BLOCK_M, F.floor(k / 5) * BLOCK_M, BLOCK_M, k % 2 == 1
        )
        return joins.at_most(rings, self.areas)

    @cached_property
    def zones(self) -> DataFrame:
        k = F.col("s_suppkey")
        rows = self.table("supplier").select(
            k,
            k.cast("string").alias("zone"),
            (F.col("s_nationkey") % 3).cast("string").alias("region"),
            F.when(k % 10 == 0, "MultiPolygon").otherwise("Polygon").alias("geom_type"),
            F.lit("EPSG:5179").alias("crs"),
        )
        return self._polygons(rows, "zone", k % 100 * LOT_M, F.floor(k / 100) * LOT_M, LOT_M, k % 2 == 1)

    @cached_property
    def points(self) -> DataFrame:
        k = F.col("p_partkey")
        row = F.floor(F.floor(k / 20) / 100)
        return self.table("part").select(
            k.cast("string").alias("cell_id"),
            (k * 7919 % 100000 + 0.5).cast("double").alias("x"),
            (row * LOT_M + k * 104729 % 1000 + 0.5).cast("double").alias("y"),
        )

    # -- calendar -----------------------------------------------------------------------------
    @cached_property
    def cal_dates(self) -> DataFrame:
        """Order dates moved 23 years on (2018-2024) with their orders."""
        return (
            self.table("orders")
            .groupBy("o_orderdate")
            .agg(F.count("*").alias("n"))
            .groupBy(calendar.to_ymd(F.add_months("o_orderdate", 276)).alias("date"))
            .agg(F.sum("n").alias("n_orders"))
        )

    @cached_property
    def cal_span(self) -> DataFrame:
        d = F.add_months("o_orderdate", 276)
        return self.table("orders").agg(F.min(d).alias("s"), F.max(d).alias("e"))


def _ints(values) -> str:
    return ", ".join(str(v) for v in values)


def _case(column: str, mapping: dict) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {column} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in mapping.items()) + " END"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def week_part_sql(d: str, holidays=vocab.MOBILITY_HOLIDAYS) -> str:
    day = f"make_date({d} // 10000, {d} // 100 % 100, {d} % 100)"
    return f"CASE WHEN {d} IN ({_ints(holidays)}) OR isodow({day}) >= 6 THEN 'weekend' ELSE 'weekday' END"


def daytype_sql(d: str) -> str:
    day = f"make_date({d} // 10000, {d} // 100 % 100, {d} % 100)"
    term = f"({d} % 10000 BETWEEN 301 AND 720 OR {d} % 10000 BETWEEN 820 AND 1220)"
    return (
        f"CASE WHEN {d} IN ({_ints(vocab.SCHOOL_HOLIDAYS)}) THEN 'holiday' "
        f"WHEN isodow({day}) >= 6 THEN 'weekend' WHEN {term} THEN 'weekday_school' "
        f"ELSE 'vacation_weekday' END"
    )


AREA = "admdong_cd, admdong_nm, sgg_nm, sido_nm"
YMD = "(year({0}) * 10000 + month({0}) * 100 + day({0}))::INTEGER"

SQL = {
    "areas": """
        SELECT n_nationkey AS nationkey, lpad(r_regionkey::VARCHAR, 2, '0') AS sido_cd, replace(r_name, ' ', '_') AS sido_nm,
          lpad(r_regionkey::VARCHAR, 2, '0') || lpad(n_nationkey::VARCHAR, 3, '0') AS sgg_cd,
          'D_' || n_name AS sgg_nm,
          lpad(r_regionkey::VARCHAR, 2, '0') || lpad(n_nationkey::VARCHAR, 3, '0') || '000' AS admdong_cd,
          n_name AS admdong_nm
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "capital": "SELECT * FROM areas WHERE sido_cd IN ('00', '01', '02')",
    "cells": """
        SELECT p_partkey::VARCHAR AS cell_id, admdong_cd, admdong_nm
        FROM part JOIN capital ON p_size % 25 = nationkey""",
    "od_raw": f"""
        SELECT {YMD.format('l_shipdate')} AS ETL_YMD,
          lpad((l_orderkey % 24)::VARCHAR, 2, '0') || '00' AS TIME_CD,
          l_partkey::VARCHAR AS O_CELL_ID, l_suppkey::VARCHAR AS D_CELL_ID,
          CASE WHEN l_orderkey % 2 = 0 THEN 'M' ELSE 'F' END AS SEX_CD,
          lpad(((l_orderkey // 24 + l_linenumber) % 9 * 10)::VARCHAR, 2, '0') AS AGE_CD,
          l_linenumber AS PURPOSE, l_quantity AS TOTAL, floor(l_extendedprice) AS AVG_DIST,
          floor(l_tax * 100 + 0.5) AS AVG_TIME
        FROM lineitem""",
    "trips": """
        SELECT ETL_YMD AS date, substr(TIME_CD, 1, 2)::INTEGER AS hour, o.admdong_cd AS o_admdong_cd,
          o.admdong_nm AS o_admdong_nm, d.admdong_cd AS d_admdong_cd, d.admdong_nm AS d_admdong_nm,
          AGE_CD::INTEGER AS age_10, PURPOSE::INTEGER AS purpose, TOTAL, AVG_DIST, AVG_TIME
        FROM od_raw JOIN cells o ON O_CELL_ID = o.cell_id JOIN cells d ON D_CELL_ID = d.cell_id""",
    "od": """
        SELECT date, hour, o_admdong_cd, o_admdong_nm, d_admdong_cd, d_admdong_nm, age_10,
          sum(TOTAL) AS total, sum(AVG_DIST * TOTAL) / nullif(sum(TOTAL), 0) AS avg_dist,
          sum(AVG_TIME * TOTAL) / nullif(sum(TOTAL), 0) AS avg_time
        FROM trips GROUP BY ALL""",
    "od_purpose": """
        SELECT date, hour, o_admdong_cd, o_admdong_nm, d_admdong_cd, d_admdong_nm, age_10, purpose,
          sum(TOTAL) AS total, sum(AVG_DIST * TOTAL) / nullif(sum(TOTAL), 0) AS avg_dist,
          sum(AVG_TIME * TOTAL) / nullif(sum(TOTAL), 0) AS avg_time
        FROM trips GROUP BY ALL""",
    "od_days": f"SELECT *, {week_part_sql('date')} AS day_type FROM od",
    "wd_days": "SELECT count(DISTINCT date) AS n_days FROM od_days WHERE day_type = 'weekday'",
    "pi": """
        SELECT o_admdong_cd, d_admdong_cd, least(age_10, 70) AS age_7, hour,
          sum(total) / (SELECT n_days FROM wd_days) AS pi
        FROM od_days WHERE day_type = 'weekday' AND age_10 BETWEEN 10 AND 80 GROUP BY ALL""",
    "lp_raw": f"""
        SELECT {YMD.format('ts')} AS ETL_YMD, lpad(hour(ts)::VARCHAR, 2, '0') AS TIMEZN_CD,
          admdong_cd AS ADMDONG_CD,
          CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END || lpad((user_id % 16 * 5)::VARCHAR, 2, '0') AS SEX_AGE_CD,
          floor(value * 100) AS POP
        FROM events JOIN areas ON user_id % 25 = nationkey""",
    "lp": """
        SELECT ETL_YMD AS date, TIMEZN_CD::INTEGER AS hour, c.admdong_cd, c.admdong_nm,
          substr(SEX_AGE_CD, 2, 2)::INTEGER // 10 * 10 AS age_10, sum(POP) AS pop
        FROM lp_raw JOIN capital c ON lp_raw.ADMDONG_CD = c.admdong_cd GROUP BY ALL""",
    "lp_days": f"SELECT *, {week_part_sql('date')} AS day_type FROM lp",
    "census5": f"""
        SELECT {AREA}, (c_custkey % 21 * 5)::INTEGER AS age_5_start, sum(floor(abs(c_acctbal)))::BIGINT AS pop_5
        FROM customer JOIN areas ON c_nationkey = nationkey GROUP BY ALL""",
    "census10": f"""
        SELECT {AREA}, least(age_5_start, 80) // 10 * 10 AS age_10, sum(pop_5)::BIGINT AS pop
        FROM census5 GROUP BY ALL""",
    "census15": f"""
        SELECT a.*, g.age_idx, coalesce(s.pop, 0)::BIGINT AS pop
        FROM (SELECT DISTINCT {AREA} FROM census5) a
        CROSS JOIN (SELECT unnest(range(15))::INTEGER AS age_idx) g
        LEFT JOIN (SELECT admdong_cd, least(age_5_start, 70) // 5 AS age_idx, sum(pop_5) AS pop
                   FROM census5 GROUP BY ALL) s USING (admdong_cd, age_idx)""",
    "claims": f"""
        SELECT o_orderdate::DATE AS date, {_list(CLAIM_CODES)}[o_custkey % 18 + 1]::BIGINT AS sido_code,
          CASE WHEN o_orderstatus = 'F' THEN 'M' ELSE 'F' END AS sex,
          {_list(vocab.CLAIMS_AGE_GROUPS)}[o_orderkey % 6 + 1] AS age_group, 1::BIGINT AS episodes
        FROM orders""",
    "weekly": """
        SELECT date_trunc('week', date)::DATE AS week_start_date, isoyear(date)::INTEGER AS iso_year,
          weekofyear(date)::INTEGER AS iso_week, age_group, sum(episodes)::BIGINT AS episodes
        FROM claims GROUP BY ALL""",
    "ili_sums": f"""
        SELECT {_list(vocab.ILI_AGE_GROUPS)}[o_custkey % 7 + 1] AS age_group,
          CASE WHEN weekofyear(o_orderdate) >= 36 THEN isoyear(o_orderdate) ELSE isoyear(o_orderdate) - 1 END AS start,
          CASE WHEN weekofyear(o_orderdate) >= 36 THEN weekofyear(o_orderdate) - 36 ELSE weekofyear(o_orderdate) + 16 END AS slot,
          count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS hits
        FROM orders GROUP BY ALL""",
    "ili_slots": """
        SELECT age_group, start, slot,
          CASE WHEN slot % 17 = 0 THEN '' ELSE floor(hits * 1000 / n)::INTEGER::VARCHAR END AS raw
        FROM ili_sums""",
    "ili": """
        SELECT s.age_group, s.start || '-' || (s.start + 1) AS season, s.start::INTEGER AS season_start_year,
          w.slot::INTEGER AS week_in_season,
          (CASE WHEN w.slot >= 52 THEN 0 WHEN w.slot < 17 THEN 36 + w.slot ELSE w.slot - 16 END)::INTEGER AS iso_week,
          (CASE WHEN w.slot >= 52 THEN 0 WHEN w.slot < 17 THEN s.start ELSE s.start + 1 END)::INTEGER AS calendar_year,
          w.slot < 52 AS is_valid_week,
          CASE WHEN w.slot < 52 AND r.raw <> '' THEN r.raw::DOUBLE END AS ili_rate
        FROM (SELECT DISTINCT age_group, start FROM ili_sums) s
        CROSS JOIN (SELECT unnest(range(54)) AS slot) w
        LEFT JOIN ili_slots r ON r.age_group = s.age_group AND r.start = s.start AND r.slot = w.slot""",
    "contacts": f"""
        SELECT {_list(vocab.SETTINGS)}[l_linenumber % 4 + 1] AS setting, (l_partkey % 15)::INTEGER AS participant_idx,
          (l_suppkey % 15)::INTEGER AS contact_idx, avg(l_quantity) AS value
        FROM lineitem GROUP BY ALL""",
    "lambdas": " UNION ALL ".join(
        f"SELECT '{d}' AS daytype, '{s}' AS setting, {v}::DOUBLE AS w"
        for d, m in vocab.SETTING_WEIGHTS.items() for s, v in m.items()
    ),
    "employment_raw": f"""
        SELECT region_raw, sex, unnest([age, '합계']) AS age_label, works FROM (
          SELECT {_list(REGIONS + ['동부'])}[c_nationkey % 20 + 1] AS region_raw,
            unnest(['계', CASE WHEN c_custkey % 2 = 0 THEN '남자' ELSE '여자' END]) AS sex,
            {_list(AGE_NAMES)}[c_custkey % 12 + 1] AS age, c_acctbal > 0 AS works FROM customer)""",
    "employment": f"""
        SELECT {_case('region_raw', vocab.EMPLOYMENT_SIDO)} AS sido_nm, region_raw, age_label,
          ({_case('age_label', vocab.EMPLOYMENT_AGE_IDX)})::INTEGER AS age_idx,
          count(*) AS population_15plus, count(*) FILTER (works) AS employed,
          count(*) FILTER (works) / count(*) AS employment_rate
        FROM employment_raw WHERE sex = '계' AND age_label <> '합계' AND region_raw <> '동부' GROUP BY ALL""",
    "area_geo": f"""
        SELECT admdong_cd, nationkey % 2 = 1 AS notched,
          CASE WHEN nationkey % 2 = 1 THEN 48.0 ELSE 64.0 END::DOUBLE AS area_km2,
          nationkey % 5 * {BLOCK_M} + CASE WHEN nationkey % 2 = 1 THEN {BLOCK_M} * 5 / 12.0 ELSE {BLOCK_M} / 2.0 END AS ctr_x,
          nationkey // 5 * {BLOCK_M} + CASE WHEN nationkey % 2 = 1 THEN {BLOCK_M} * 5 / 12.0 ELSE {BLOCK_M} / 2.0 END AS ctr_y
        FROM areas""",
    "straight": """
        SELECT od.*, sqrt((o.ctr_x - d.ctr_x) ** 2 + (o.ctr_y - d.ctr_y) ** 2) AS straight_dist_m,
          avg_dist / sqrt((o.ctr_x - d.ctr_x) ** 2 + (o.ctr_y - d.ctr_y) ** 2) AS ratio
        FROM od JOIN area_geo o ON o_admdong_cd = o.admdong_cd JOIN area_geo d ON d_admdong_cd = d.admdong_cd
        WHERE o_admdong_cd <> d_admdong_cd AND avg_dist > 0
          AND sqrt((o.ctr_x - d.ctr_x) ** 2 + (o.ctr_y - d.ctr_y) ** 2) > 100""",
    "bands": """
        SELECT *, CASE WHEN straight_dist_m < 2000 THEN '1) 0-2km' WHEN straight_dist_m < 5000 THEN '2) 2-5km'
          WHEN straight_dist_m < 10000 THEN '3) 5-10km' WHEN straight_dist_m < 20000 THEN '4) 10-20km'
          ELSE '5) 20km+' END AS dist_bin FROM straight""",
    "zones": f"""
        SELECT s_suppkey, s_suppkey::VARCHAR AS zone, (s_nationkey % 3)::VARCHAR AS region,
          CASE WHEN s_suppkey % 10 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS geom_type,
          s_suppkey % 100 * {LOT_M} AS x0, s_suppkey // 100 * {LOT_M} AS y0, s_suppkey % 2 = 1 AS notched
        FROM supplier""",
    "points": f"""
        SELECT p_partkey::VARCHAR AS cell_id, (p_partkey * 7919 % 100000 + 0.5)::DOUBLE AS x,
          (p_partkey // 20 // 100 * {LOT_M} + p_partkey * 104729 % 1000 + 0.5)::DOUBLE AS y FROM part""",
    "cal_dates": f"""
        SELECT {YMD.format("(o_orderdate + INTERVAL 276 MONTH)")} AS date, count(*) AS n_orders
        FROM orders GROUP BY ALL""",
    "cal": f"""
        SELECT {YMD.format('d')} AS date, (isodow(d) - 1)::INTEGER AS weekday, {daytype_sql('(' + YMD.format('d') + ')')} AS daytype
        FROM (SELECT unnest(generate_series(min(o_orderdate + INTERVAL 276 MONTH), max(o_orderdate + INTERVAL 276 MONTH),
              INTERVAL 1 DAY))::DATE AS d FROM orders)""",
    "night": """
        SELECT admdong_cd, age_10, avg(pop) AS night_avg FROM lp WHERE hour IN (3, 4, 5) GROUP BY ALL""",
    "detection": """
        SELECT n.*, c.pop AS census_pop, night_avg / c.pop AS detection_rate
        FROM night n JOIN census10 c USING (admdong_cd, age_10) WHERE c.pop > 50""",
    "day_night": """
        SELECT * , day_avg / night_avg AS day_night_ratio FROM (
          SELECT admdong_cd, age_10, avg(pop) FILTER (hour = 13) AS day_avg, avg(pop) FILTER (hour = 4) AS night_avg
          FROM lp WHERE hour IN (4, 13) GROUP BY ALL) WHERE night_avg > 10""",
    "gap": """
        SELECT *, weekday - weekend AS diff, (weekday - weekend) / weekend AS rel_diff FROM (
          SELECT admdong_cd, age_10, avg(pop) FILTER (day_type = 'weekday') AS weekday,
            avg(pop) FILTER (day_type = 'weekend') AS weekend
          FROM lp_days WHERE hour = 9 GROUP BY ALL) WHERE weekend > 10""",
    "hourly": """
        SELECT hour, admdong_cd, avg(pop_day) AS pop_avg FROM (
          SELECT date, hour, admdong_cd, sum(pop) AS pop_day FROM lp GROUP BY ALL) GROUP BY ALL""",
    "avg_pop": """
        SELECT age_10, sum(pop) / (SELECT count(DISTINCT date) * 24 FROM lp) AS avg_pop_total FROM lp GROUP BY ALL""",
    "months": """
        SELECT (date // 100)::VARCHAR AS yyyymm, sum(total) AS total, count(*) AS n_rows FROM od GROUP BY ALL""",
    "ledger": """
        SELECT yyyymm, CASE WHEN yyyymm::INTEGER % 3 = 0 THEN 'SKIPPED' ELSE 'OK' END AS status,
          n_rows AS output_rows, total AS total_sum FROM months""",
    "net": """
        SELECT admdong_cd, sum(i) AS inflow, sum(o) AS outflow, sum(i) - sum(o) AS net FROM (
          SELECT d_admdong_cd AS admdong_cd, total AS i, 0 AS o FROM od WHERE o_admdong_cd <> d_admdong_cd
          UNION ALL SELECT o_admdong_cd, 0, total FROM od WHERE o_admdong_cd <> d_admdong_cd) GROUP BY ALL""",
    "pairs": "SELECT o_admdong_cd, d_admdong_cd, sum(total) AS total FROM od GROUP BY ALL",
    "area_idx": "SELECT admdong_cd, (row_number() OVER (ORDER BY admdong_cd) - 1)::INTEGER AS area_idx FROM capital",
    "bridge": " UNION ALL ".join(
        f"SELECT '{g}' AS age_group, {i} AS age_idx, {w}::DOUBLE AS weight"
        for g, m in vocab.ILI_BRIDGE_WEIGHTED.items() for i, w in m.items()
    ),
}


def with_inputs(body: str) -> str:
    """Prefix a SELECT with the table expressions it uses, in order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        fresh = (words & SQL.keys()) - needed
        needed |= fresh
        todo += [SQL[n] for n in fresh]
    ctes = ", ".join(f"{n} AS ({SQL[n]})" for n in SQL if n in needed)
    return f"WITH {ctes} {body}" if ctes else body
