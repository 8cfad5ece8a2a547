import datetime as dt
import math

import pytest
from support import rows
from pyspark.sql import functions as F

from ebbflow import vocab
from ebbflow.functions.calendar import iso_monday
from ebbflow.functions.columns import lookup
from ebbflow.operators import blending, claims, contact, employment, ili


def test_weekly_sum_is_preserved_and_weeks_start_on_monday(inputs):
    for sum_over in (("sido_code", "sex"), ("sex",), ()):
        weeks = claims.weekly(inputs.claims, sum_over)
        assert weeks.agg(F.sum("episodes")).first()[0] == inputs.claims.count()
        assert ("sex" in weeks.columns) == ("sex" not in sum_over)
    assert weeks.filter(F.weekday("week_start_date") != 0).count() == 0


def test_claims_argument_errors(inputs):
    with pytest.raises(ValueError):
        claims.weekly(inputs.claims, ["age_group"])
    with pytest.raises(ValueError):
        claims.weekly(inputs.claims.drop("sex"))
    for bad in ({"sex": "X"}, {"age_groups": ["7-8"]}, {"setting": "icu"}):
        with pytest.raises(ValueError):
            claims.select(inputs.claims, **bad)
    with pytest.raises(ValueError):
        claims.season(inputs.claims, 2019)


def test_date_range_is_closed(inputs):
    day = claims.select(inputs.claims, date_range=("1997-05-28", "1997-05-28"))
    assert {r[0] for r in day.select("date").distinct().collect()} <= {dt.date(1997, 5, 28)}
    assert day.count() == inputs.claims.filter("date = '1997-05-28'").count()


def test_season_starts_in_week_36(spark):
    assert iso_monday(2019, 36) == dt.date(2019, 9, 2)
    weeks = spark.createDataFrame([(dt.date(2019, 8, 26),), (dt.date(2019, 9, 2),), (dt.date(2020, 8, 24),), (dt.date(2020, 8, 31),)], "week_start_date date")
    assert rows(claims.season(weeks, 2019)) == [(dt.date(2019, 9, 2), 0), (dt.date(2020, 8, 24), 51)]


def test_a_missing_group_is_no_zero(spark):
    bridge = spark.createDataFrame([("0", 0, 0.2), ("1-6", 0, 0.8), ("1-6", 1, 1.0)], "age_group string, age_idx int, weight double")
    known = [("s", 0, "0", 10.0, True), ("s", 0, "1-6", 5.0, True), ("s", 1, "0", 10.0, True), ("s", 1, "1-6", None, True), ("s", 2, "0", 1.0, True)]
    long = spark.createDataFrame(known, "season string, week_in_season int, age_group string, ili_rate double, is_valid_week boolean")
    got = {(r.week_in_season, r.age_idx): r.rate for r in ili.to_15_ages(long, bridge).collect()}
    assert got == {(0, 0): 6.0, (0, 1): 5.0, (1, 0): None, (1, 1): None, (2, 0): None}


def test_contacts_outside_the_ages_fail(spark):
    long = spark.createDataFrame([("home", 15, 0, 1.0)], "setting string, contact_idx int, participant_idx int, value double")
    days = spark.createDataFrame([(20230101, "holiday")], "date int, daytype string")
    with pytest.raises(Exception, match="outside"):
        contact.daily_series(long, days).collect()


def test_successor_codes(spark):
    df = spark.createDataFrame([(45,), (11,)], "sido_code bigint")
    assert rows(claims.merge_successors(df)) == [(11,), (52,)]


def test_season_map():
    assert [ili.season_week_to_iso(2020, w) for w in (0, 16, 17, 51)] == [(2020, 36), (2020, 52), (2021, 1), (2021, 35)]
    for bad in (-1, 52):
        with pytest.raises(ValueError):
            ili.season_week_to_iso(2020, bad)


def test_long_table_agrees_with_the_scalar_map(inputs):
    valid = inputs.ili.filter("is_valid_week").select("season_start_year", "week_in_season", "calendar_year", "iso_week").distinct()
    for y, w, cy, iso in valid.collect():
        assert (cy, iso) == ili.season_week_to_iso(y, w)


def test_bridge_covers_every_age_once(spark):
    assert all(math.isclose(r.coverage, 1.0) for r in ili.bridge_coverage(ili.bridge(spark)).collect())
    assert ili.bridge(spark, weighted=False).count() == 18


def test_age_bridge_of_constant_rate_is_constant(spark):
    rows_ = [(g, "2018-2019", 0, True, 10.0) for g in vocab.ILI_AGE_GROUPS]
    long = spark.createDataFrame(rows_, "age_group string, season string, week_in_season int, is_valid_week boolean, ili_rate double")
    got = ili.to_15_ages(long, ili.bridge(spark)).collect()
    assert len(got) == 15 and all(math.isclose(r.rate, 10.0) for r in got)


def test_unknown_age_group(inputs):
    with pytest.raises(ValueError):
        ili.for_age(inputs.ili, "65")


def test_weeks_are_aligned_by_iso_keys(spark):
    long = spark.createDataFrame([(2021, 1, "2020-2021", True, 2.0)], "calendar_year int, iso_week int, season string, is_valid_week boolean, ili_rate double")
    weekly = spark.createDataFrame([(2020, 53, 7), (2021, 1, 9)], "iso_year int, iso_week int, episodes bigint")
    assert blending.align_weeks(long, weekly).first().episodes == 9


def cells(spark):
    data = [(s, a, b, 1.0 + (s == "school") * a) for s in vocab.SETTINGS for a in range(15) for b in range(15)]
    return spark.createDataFrame(data, "setting string, contact_idx int, participant_idx int, value double")


def test_contact_combination(spark):
    long = cells(spark)
    total = lambda df: df.agg(F.sum("value")).first()[0]
    assert math.isclose(total(contact.combine(long, "weekday_school")), total(long))
    assert total(contact.combine(long, weights={"home": 2.0})) == 450
    assert total(contact.combine(long, "weekend")) == pytest.approx(225 * (1.3 + 0.2 + 1.2))
    with pytest.raises(ValueError):
        contact.combine(long, "monday")


def test_contact_orientation_and_summary(spark):
    long = cells(spark)
    assert rows(contact.swap_orientation(contact.swap_orientation(long))) == rows(long)
    school = contact.matrix_summary(long).filter("setting = 'school'").first()
    assert (school.max_value, school.max_contact_idx, school.max_participant_idx) == (15.0, 14, 0)
    assert school.mean_diagonal == 8.0
    assert all(r.is_square for r in contact.shape_report(long).collect())
    assert not contact.shape_report(long.filter("contact_idx < 14")).first().is_square


def test_scenario_reductions(spark):
    got = {r.scenario: r for r in contact.compare_scenarios(cells(spark), contact.scenarios(), "weekday_school").collect()}
    assert got["weekday_school"].reduction == 0 and got["school_closed"].reduction == 225 * 8


def test_area_rates_fills(spark):
    areas = spark.createDataFrame([("11010010",), ("99010010",)], "admdong_cd string")
    rates = spark.createDataFrame([("서울", 5, 0.5)], "sido_nm string, age_idx int, employment_rate double")
    got = {(r.admdong_cd[:2], r.age_idx): r.rho for r in employment.area_rates(areas, rates, fill_under_15=0.1, fill_unknown=0.3).collect()}
    assert len(got) == 30
    assert (got["11", 0], got["11", 5], got["11", 6], got["99", 5]) == (0.1, 0.5, 0.3, 0.3)
    assert areas.select(lookup(F.substring("admdong_cd", 1, 2), {"11": 1}, 0)).count() == 2
