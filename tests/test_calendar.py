import datetime as dt

import pytest
from support import rows
from pyspark.sql import functions as F

from ebbflow import vocab
from ebbflow.functions import calendar

DAYTYPES = {
    20230101: "holiday", 20230102: "vacation_weekday", 20230307: "weekday_school", 20230311: "weekend",
    20230725: "vacation_weekday", 20230905: "weekday_school", 20231225: "holiday", 20180215: "holiday",
    20230121: "holiday",  # a Saturday: the holiday wins
}


def test_daytype_values_and_priority(spark):
    df = spark.createDataFrame([(d,) for d in DAYTYPES], "date int")
    got = dict(df.select("date", calendar.daytype(F.col("date"))).collect())
    assert got == DAYTYPES


@pytest.mark.parametrize("ymd,inside", [(20230228, False), (20230301, True), (20230720, True), (20230721, False),
                                        (20230819, False), (20230820, True), (20231220, True), (20231221, False)])
def test_term_edges(spark, ymd, inside):
    df = spark.createDataFrame([(ymd,)], "d int")
    assert df.select(calendar.in_school_term(F.col("d"))).first()[0] is inside


def test_calendar_covers_leap_year_and_types_partition_the_days(spark):
    days = calendar.calendar_between(spark, 20200101, 20201231)
    by_type = dict(days.groupBy("daytype").count().collect())
    assert sum(by_type.values()) == 366 and set(by_type) == set(vocab.DAYTYPES)
    assert days.filter("date = 20200229").count() == 1


def test_calendar_rejects_reversed_range(spark):
    with pytest.raises(ValueError):
        calendar.calendar_between(spark, 20230102, 20230101)
    span = spark.createDataFrame([(dt.date(2023, 1, 2), dt.date(2023, 1, 1))], "s date, e date")
    with pytest.raises(Exception, match="start"):
        calendar.calendar_table(span, "s", "e").collect()


def test_holiday_lists_differ_in_three_days():
    school, mobility = set(vocab.SCHOOL_HOLIDAYS), set(vocab.MOBILITY_HOLIDAYS)
    assert school - mobility == {20180813}
    assert mobility - school == {20180613, 20200415}


def test_week_part_counts_holidays_as_weekend(spark):
    df = spark.createDataFrame([(20230123,), (20230125,), (20230128,)], "d int")
    got = [r[0] for r in df.select(calendar.week_part(F.col("d"))).collect()]
    assert got == ["weekend", "weekday", "weekend"]


def test_iso_week_in_53_week_year(spark):
    dates = [dt.date(2020, 12, 31), dt.date(2021, 1, 3), dt.date(2021, 1, 4)]
    df = spark.createDataFrame([(d,) for d in dates], "date date")
    got = calendar.with_iso_week(df).orderBy("date").collect()
    assert [(r.iso_year, r.iso_week) for r in got] == [d.isocalendar()[:2] for d in dates]
    assert all(r.week_start_date.weekday() == 0 for r in got)


def test_month_spine_has_72_months(spark):
    span = spark.createDataFrame([(dt.date(2018, 1, 15), dt.date(2023, 12, 1))], "s date, e date")
    months = [r[0] for r in rows(calendar.month_spine(span, "s", "e"))]
    assert len(months) == 72 and months[0] == "201801" and months[-1] == "202312"
