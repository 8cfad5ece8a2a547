"""Calendar (K). Days come from the orders, moved into the years of the holiday lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow import vocab
from ebbflow.functions import calendar
from ebbflow.operators import mobility
from ebbflow.plans.bindings import Inputs, _ints, daytype_sql, week_part_sql
from ebbflow.plans.catalog import query


@query(
    "k01_holiday",
    f"SELECT date, date IN ({_ints(vocab.SCHOOL_HOLIDAYS)}) AS is_holiday, n_orders FROM cal_dates",
)
def holiday(i: Inputs) -> DataFrame:
    return i.cal_dates.select("date", calendar.is_holiday(F.col("date")).alias("is_holiday"), "n_orders")


@query(
    "k02_school_term",
    """SELECT date, date % 10000 BETWEEN 301 AND 720 OR date % 10000 BETWEEN 820 AND 1220 AS in_term FROM cal_dates""",
)
def school_term(i: Inputs) -> DataFrame:
    return i.cal_dates.select("date", calendar.in_school_term(F.col("date")).alias("in_term"))


@query("k03_daytype", f"SELECT date, {daytype_sql('date')} AS daytype, n_orders FROM cal_dates")
def daytype(i: Inputs) -> DataFrame:
    return i.cal_dates.select("date", calendar.daytype(F.col("date")).alias("daytype"), "n_orders")


@query(
    "k04_week_part",
    f"SELECT {week_part_sql('date')} AS day_type, count(*) AS n_days, sum(n_orders)::BIGINT AS n_orders FROM cal_dates GROUP BY ALL",
)
def week_part(i: Inputs) -> DataFrame:
    return i.cal_dates.groupBy(calendar.week_part(F.col("date")).alias("day_type")).agg(
        F.count("*").alias("n_days"), F.sum("n_orders").alias("n_orders")
    )


@query("k05_calendar_table", "SELECT * FROM cal")
def calendar_table(i: Inputs) -> DataFrame:
    return calendar.calendar_table(i.cal_span, "s", "e")


@query(
    "k06_daytype_counts",
    """SELECT date // 10000 AS year, count(*) FILTER (daytype = 'weekday_school') AS weekday_school,
         count(*) FILTER (daytype = 'vacation_weekday') AS vacation_weekday,
         count(*) FILTER (daytype = 'weekend') AS weekend, count(*) FILTER (daytype = 'holiday') AS holiday
       FROM cal GROUP BY ALL""",
)
def daytype_counts(i: Inputs) -> DataFrame:
    days = calendar.calendar_table(i.cal_span, "s", "e")
    year = F.floor(F.col("date") / 10000).cast("int").alias("year")
    counts = days.groupBy(year).pivot("daytype", vocab.DAYTYPES).count()
    return counts.fillna(0)


@query("k07_days_present", "SELECT n_days FROM wd_days")
def days_present(i: Inputs) -> DataFrame:
    return mobility.day_count(i.trips, "weekday")


@query(
    "k08_holiday_audit",
    f"""SELECT date, CASE WHEN date IN ({_ints(vocab.SCHOOL_HOLIDAYS)}) THEN 'school' ELSE 'mobility' END AS only_in, n_orders
        FROM cal_dates WHERE (date IN ({_ints(vocab.SCHOOL_HOLIDAYS)})) <> (date IN ({_ints(vocab.MOBILITY_HOLIDAYS)}))""",
)
def holiday_audit(i: Inputs) -> DataFrame:
    """Days with orders that only one of the two holiday lists knows."""
    d = F.col("date")
    school, mobility_ = calendar.is_holiday(d, "school"), calendar.is_holiday(d, "mobility")
    return i.cal_dates.filter(school != mobility_).select(
        "date", F.when(school, "school").otherwise("mobility").alias("only_in"), "n_orders"
    )
