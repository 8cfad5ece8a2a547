"""Data-quality reports (V)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow import vocab
from ebbflow.contracts import require_columns
from ebbflow.operators import census, claims, profile, quality, series
from ebbflow.plans.bindings import Inputs
from ebbflow.plans.catalog import query, rounded
from ebbflow.plans.source_queries import SPINE, _spine
from ebbflow.session import shared_dir
from ebbflow.sources import ingest

OD_COLUMNS = ["date", "hour", "o_admdong_cd", "d_admdong_cd", "age_10", "total", "avg_dist", "avg_time"]


def _row(check: str, metric: str, expected: str, test: str, source: str) -> str:
    return f"""SELECT '{check}' AS "check", ({metric})::DOUBLE AS metric, '{expected}' AS expected,
        CASE WHEN {metric} {test} THEN 'PASS' ELSE 'FAIL' END AS status FROM {source}"""


@query(
    "v01_contract",
    " UNION ALL ".join(
        [
            _row("sex allowed", "count(*) FILTER (sex NOT IN ('M', 'F'))", "0", "= 0", "claims"),
            _row("age_group allowed", f"count(*) FILTER (age_group NOT IN {tuple(vocab.CLAIMS_AGE_GROUPS)})", "0", "= 0", "claims"),
            _row("sido_code allowed", "count(*) FILTER (sido_code NOT IN (11, 28, 41))", "0", "= 0", "claims"),
        ]
    ),
)
def contract(i: Inputs) -> DataFrame:
    """Columns are checked before the plan is built, values while it runs."""
    require_columns(i.claims, claims.COLUMNS, "claims")
    rules = [
        quality.allowed("sex", list(vocab.CLAIMS_SEXES.values())),
        quality.allowed("age_group", vocab.CLAIMS_AGE_GROUPS),
        quality.allowed("sido_code", vocab.CLAIMS_CAPITAL_CODES),
    ]
    return quality.report(i.claims, rules)


@query(
    "v02_null_counts",
    " UNION ALL ".join(_row(f"nulls in {c}", f"count(*) FILTER ({c} IS NULL)", "0", "= 0", "od") for c in OD_COLUMNS),
)
def null_counts(i: Inputs) -> DataFrame:
    return quality.report(i.od, quality.no_nulls(OD_COLUMNS))


@query(
    "v03_value_ranges",
    " UNION ALL ".join(
        [
            _row("negative total", "count(*) FILTER (total < 0)", "0", "= 0", "od_purpose"),
            _row("min hour", "min(hour)", ">= 0", ">= 0", "od_purpose"),
            _row("max hour", "max(hour)", "<= 23", "<= 23", "od_purpose"),
            _row("min date", "min(date)", ">= 19950101", ">= 19950101", "od_purpose"),
            _row("max date", "max(date)", "<= 20001231", "<= 20001231", "od_purpose"),
        ]
    ),
)
def value_ranges(i: Inputs) -> DataFrame:
    rules = [quality.not_negative("total"), *quality.within("hour", 0, 23), *quality.within("date", 19950101, 20001231)]
    return quality.report(i.od_purpose, rules)


NUMBERS = ["total", "avg_dist"]
LISTED = ["hour", "age_10", "purpose", "o_admdong_cd"]


def _profile(column: str, table: str) -> str:
    number = "NULL::DOUBLE" if column.endswith("_cd") else f"{column}::DOUBLE"
    value = f"{column}::VARCHAR" if column in LISTED else "NULL::VARCHAR"
    # sums of unrounded means depend on the order of addition
    total = f"round(sum({number}), 2)" if column == "avg_dist" else f"sum({number})"
    return f"""SELECT (date // 100)::VARCHAR AS yyyymm, '{column}' AS "column", {value} AS value, count(*) AS n_rows,
        count(*) FILTER ({column} IS NULL) AS n_nulls, count(*) FILTER (isnan({number})) AS n_nans,
        count(*) FILTER ({number} < 0) AS n_negative, round(min({number}), 6) AS least, round(max({number}), 6) AS most,
        {total} AS total FROM {table} GROUP BY ALL"""


def _profiles(i: Inputs) -> DataFrame:
    """Profiles published in two runs, even years and then odd ones, each from its own rows."""
    table = profile.ProfileTable(i.spark, shared_dir(i.spark), tuple(NUMBERS), tuple(LISTED))
    even = F.floor(F.col("date") / 10000) % 2 == 0
    for part in (i.od_purpose.filter(even), i.od_purpose.filter(~even)):
        table.add(part)
    return table.read()


@query("v02_month_profiles", " UNION ALL ".join(_profile(c, "od_purpose") for c in [*NUMBERS, *LISTED]))
def month_profiles(i: Inputs) -> DataFrame:
    """One row for each month, column and listed value, from one read of each month."""
    exact = F.when(F.col("column") == "avg_dist", F.round("total", 2)).otherwise(F.col("total"))
    return rounded(_profiles(i).withColumn("total", exact), "least", "most")


MONTH_BOUNDS = [
    ("total", "n_nulls", "count(*) FILTER (total IS NULL)", "0", "= 0", profile.no_nulls("total")),
    ("total", "n_negative", "count(*) FILTER (total < 0)", "0", "= 0", profile.not_negative("total")),
    ("hour", "most", "max(hour)", "<= 22", "<= 22", profile.at_most("hour", 22)),
    ("age_10", "least", "min(age_10)", ">= 10", ">= 10", profile.at_least("age_10", 10)),
    ("hour", "n_values", "count(DISTINCT hour)", "24", "= 24", profile.cardinality("hour", 24)),
    ("purpose", "n_values", "count(DISTINCT purpose)", "7", "= 7", profile.cardinality("purpose", 7)),
]


@query(
    "v05_month_report",
    " UNION ALL ".join(
        f"""SELECT (date // 100)::VARCHAR AS yyyymm, '{c}' AS "column", '{m}' AS metric, ({sql})::DOUBLE AS measured,
              '{expected}' AS expected, CASE WHEN {sql} {test} THEN 'PASS' ELSE 'FAIL' END AS status FROM od_purpose GROUP BY ALL"""
        for c, m, sql, expected, test, _ in MONTH_BOUNDS
    ),
)
def month_report(i: Inputs) -> DataFrame:
    """Checks of every month from the published profiles; the trips are not read for it."""
    return profile.report(_profiles(i), [b[-1] for b in MONTH_BOUNDS], "yyyymm")


@query(
    "v06_month_gaps",
    " UNION ALL ".join(
        f"""SELECT coalesce(h.yyyymm, w.yyyymm) AS yyyymm, '{c}' AS "column", coalesce(h.v, w.v) AS value,
              CASE WHEN h.v IS NULL THEN 'missing' ELSE 'extra' END AS gap
            FROM (SELECT DISTINCT (date // 100)::VARCHAR AS yyyymm, {c}::VARCHAR AS v FROM od_purpose WHERE {c} IS NOT NULL) h
            FULL JOIN (SELECT yyyymm, unnest(range({a}, {b}, {s}))::VARCHAR AS v FROM (SELECT DISTINCT (date // 100)::VARCHAR AS yyyymm FROM od_purpose)) w
              ON h.yyyymm = w.yyyymm AND h.v = w.v WHERE h.v IS NULL OR w.v IS NULL"""
        for c, (a, b, s) in {"hour": (1, 25, 1), "age_10": (0, 90, 10)}.items()
    ),
)
def month_gaps(i: Inputs) -> DataFrame:
    """Values that a month lacks or has beyond the list; hours are expected as 1 to 24 here."""
    return profile.value_gaps(_profiles(i), {"hour": range(1, 25), "age_10": range(0, 90, 10)})


@query("v03_value_list", "SELECT age_10 AS value, count(*) AS n_rows FROM od_purpose GROUP BY ALL")
def value_list(i: Inputs) -> DataFrame:
    return quality.value_list(i.od_purpose, "age_10")


@query(
    "v04_conservation",
    """SELECT before, after, abs(before - after) < 0.01 AS conserved FROM (
         SELECT (SELECT sum(POP) FROM lp_raw WHERE ADMDONG_CD < '03') AS before, (SELECT sum(pop) FROM lp) AS after)""",
)
def conservation(i: Inputs) -> DataFrame:
    before = i.lp_raw.filter(F.col("ADMDONG_CD") < "03").agg(F.sum("POP").alias("before"))
    after = i.lp.agg(F.sum("pop")).scalar()
    both = before.withColumn("after", after)
    return both.withColumn("conserved", F.abs(F.col("before") - F.col("after")) < 0.01)


@query(
    "v05_cardinalities",
    " UNION ALL ".join(
        [
            _row("distinct admdong_cd", "count(DISTINCT admdong_cd)", "15", "= 15", "lp"),
            _row("distinct date", "count(DISTINCT date)", "31", "= 31", "lp"),
            _row("distinct hour", "count(DISTINCT hour)", "24", "= 24", "lp"),
            _row("distinct age_10", "count(DISTINCT age_10)", "8", "= 8", "lp"),
        ]
    ),
)
def cardinalities(i: Inputs) -> DataFrame:
    expected = {"admdong_cd": 15, "date": 31, "hour": 24, "age_10": 8}
    return quality.report(i.lp, [quality.cardinality(c, n) for c, n in expected.items()])


@query(
    "v05_value_gaps",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", value, CASE WHEN h.v IS NULL THEN 'missing' ELSE 'extra' END AS gap FROM (
              SELECT coalesce(h.v, w.v) AS value, h, w FROM (SELECT DISTINCT {c}::VARCHAR AS v FROM lp) h
              FULL JOIN (SELECT unnest(range({a}, {b}, {s}))::VARCHAR AS v) w ON h.v = w.v) WHERE h.v IS NULL OR w.v IS NULL"""
        for c, (a, b, s) in {"hour": (1, 25, 1), "age_10": (0, 90, 10), "date": (20240101, 20240132, 1)}.items()
    ),
)
def value_gaps(i: Inputs) -> DataFrame:
    """Hours are expected as 1 to 24 here, so hour 0 is extra and hour 24 missing."""
    expected = {"hour": range(1, 25), "age_10": range(0, 90, 10), "date": range(20240101, 20240132)}
    return quality.value_gaps(i.lp, expected)


@query(
    "v06_missing_months",
    f"SELECT yyyymm FROM ({SPINE}) WHERE yyyymm NOT IN (SELECT yyyymm FROM months WHERE total > 1.0 * (SELECT median(total) FROM months))",
)
def missing_months(i: Inputs) -> DataFrame:
    months = series.with_median(series.monthly_totals(i.od, "total"))
    return ingest.pending(_spine(i), months.filter(F.col("total") > F.col("median")))


@query(
    "v07_fifteen_rows",
    """SELECT count(*) AS n_areas, count(*) FILTER (n = 15) AS n_complete, sum(top)::BIGINT AS top_group,
         (SELECT sum(pop_5)::BIGINT FROM census5 WHERE age_5_start >= 70) AS raw_top FROM (
           SELECT admdong_cd, count(*) AS n, sum(pop) FILTER (age_idx = 14) AS top FROM census15 GROUP BY ALL)""",
)
def fifteen_rows(i: Inputs) -> DataFrame:
    per_area = census.to_15_groups(i.census5).groupBy("admdong_cd").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("age_idx") == 14, F.col("pop"))).alias("top")
    )
    raw_top = i.census5.filter(F.col("age_5_start") >= 70).agg(F.sum("pop_5")).scalar()
    return per_area.agg(
        F.count("*").alias("n_areas"),
        F.count_if(F.col("n") == 15).alias("n_complete"),
        F.sum("top").alias("top_group"),
    ).withColumn("raw_top", raw_top)
