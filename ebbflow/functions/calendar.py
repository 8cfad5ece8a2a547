"""Calendar expressions over yyyymmdd integers and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbflow import vocab


def to_date(ymd: Column) -> Column:
    year = F.floor(ymd / 10000).cast("int")
    month = (F.floor(ymd / 100) % 100).cast("int")
    return F.make_date(year, month, (ymd % 100).cast("int"))


def to_ymd(date: Column) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def monday_based_weekday(ymd: Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(to_date(ymd))


def is_holiday(ymd: Column, calendar: str | list[int] = "school") -> Column:
    days = vocab.HOLIDAY_CALENDARS[calendar] if isinstance(calendar, str) else list(calendar)
    return ymd.isin(days)


def in_school_term(ymd: Column) -> Column:
    mmdd = ymd % 10000
    first, second = vocab.SCHOOL_TERMS
    return mmdd.between(*first) | mmdd.between(*second)


def daytype(ymd: Column, calendar: str | list[int] = "school") -> Column:
    """Four day types; a holiday wins over a weekend, a weekend over term and vacation."""
    return (
        F.when(is_holiday(ymd, calendar), "holiday")
        .when(monday_based_weekday(ymd) >= 5, "weekend")
        .when(in_school_term(ymd), "weekday_school")
        .otherwise("vacation_weekday")
    )


def week_part(ymd: Column, calendar: str | list[int] = "mobility") -> Column:
    """'weekday' or 'weekend'; a holiday counts as weekend."""
    free = is_holiday(ymd, calendar) | (monday_based_weekday(ymd) >= 5)
    return F.when(free, "weekend").otherwise("weekday")


def with_iso_week(df: DataFrame, date: str = "date") -> DataFrame:
    """Add week_start_date (Monday), iso_year and iso_week."""
    c = F.col(date)
    return df.withColumns(
        {
            "week_start_date": F.trunc(c, "week"),
            "iso_year": F.extract(F.lit("YEAROFWEEK"), c).cast("int"),
            "iso_week": F.weekofyear(c).cast("int"),
        }
    )


def iso_monday(year: int, week: int) -> dt.date:
    return dt.date.fromisocalendar(year, week, 1)


def calendar_table(spans: DataFrame, start: str, end: str) -> DataFrame:
    """Every day of the closed span(s) held in two date columns, with its day type.

    Raises at run time when a span ends before it starts.
    """
    guarded = F.when(F.col(start) <= F.col(end), F.sequence(start, end)).otherwise(
        F.raise_error(F.concat_ws(" > ", F.lit("start"), F.col(start), F.col(end)))
    )
    days = spans.select(F.explode(guarded).alias("_day"))
    ymd = to_ymd(F.col("_day"))
    return days.select(ymd.alias("date")).select(
        "date",
        monday_based_weekday(F.col("date")).cast("int").alias("weekday"),
        daytype(F.col("date")).alias("daytype"),
    )


def calendar_between(spark: SparkSession, start_ymd: int, end_ymd: int) -> DataFrame:
    """Calendar for two yyyymmdd numbers; the order of the ends is checked first."""
    start = dt.datetime.strptime(str(start_ymd), "%Y%m%d").date()
    end = dt.datetime.strptime(str(end_ymd), "%Y%m%d").date()
    if start > end:
        raise ValueError(f"start {start_ymd} is after end {end_ymd}")
    span = spark.range(1).select(F.lit(start).alias("s"), F.lit(end).alias("e"))
    return calendar_table(span, "s", "e")


def month_spine(spans: DataFrame, start: str, end: str) -> DataFrame:
    """One 'yyyymm' row per month of the closed span(s)."""
    first = F.trunc(F.col(start), "month")
    months = F.sequence(first, F.col(end), F.expr("interval 1 month"))
    return spans.select(F.explode(months).alias("_m")).select(
        F.date_format("_m", "yyyyMM").alias("yyyymm")
    )
