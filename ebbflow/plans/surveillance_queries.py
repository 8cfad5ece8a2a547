"""Claims, influenza surveillance, employment and contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow import vocab
from ebbflow.functions import calendar
from ebbflow.operators import blending, claims, contact, employment, ili
from ebbflow.plans.bindings import Inputs
from ebbflow.plans.catalog import query, rounded


@query("a11_weekly_claims", "SELECT * FROM weekly")
def weekly_claims(i: Inputs) -> DataFrame:
    return claims.weekly(i.claims)


@query(
    "a11_weekly_claims_by_province",
    """SELECT date_trunc('week', date)::DATE AS week_start_date, isoyear(date)::INTEGER AS iso_year, weekofyear(date)::INTEGER AS iso_week,
         age_group, sido_code, sum(episodes)::BIGINT AS episodes FROM claims GROUP BY ALL""",
)
def weekly_claims_by_province(i: Inputs) -> DataFrame:
    return claims.weekly(i.claims, ["sex"])


@query(
    "a12_claims_season",
    """SELECT *, (date_diff('day', DATE '1997-09-01', week_start_date) // 7)::INTEGER AS week_in_season FROM weekly
       WHERE week_start_date BETWEEN DATE '1997-09-01' AND DATE '1998-08-24'""",
)
def claims_season(i: Inputs) -> DataFrame:
    return claims.season(claims.weekly(i.claims), 1997)


@query("a13_employment_rates", "SELECT sido_nm, age_label, age_idx, sum(population_15plus)::BIGINT AS population_15plus, sum(employed)::BIGINT AS employed, any_value(employment_rate) AS employment_rate FROM employment GROUP BY sido_nm, age_label, age_idx, region_raw")
def employment_rates(i: Inputs) -> DataFrame:
    return i.rates


@query(
    "a14_rate_pivot",
    "SELECT age_idx, " + ", ".join(f"max(round(employment_rate * 100, 1)) FILTER (sido_nm = '{p}') AS {n}" for p, n in (("서울", "a"), ("경기", "b"), ("인천", "c")))
    + " FROM employment GROUP BY ALL",
)
def rate_pivot(i: Inputs) -> DataFrame:
    return employment.rate_pivot(i.rates, ["서울", "경기", "인천"]).toDF("age_idx", "a", "b", "c")


@query("a14_mean_rate", "SELECT age_idx, round(avg(employment_rate), 6) AS mean_rate FROM employment GROUP BY ALL")
def mean_rate(i: Inputs) -> DataFrame:
    out = i.rates.groupBy("age_idx").agg(F.avg("employment_rate").alias("mean_rate"))
    return rounded(out, "mean_rate")


@query(
    "a15_contact_matrix",
    """SELECT contact_idx, participant_idx, round(sum(w * value), 6) AS value FROM contacts JOIN lambdas USING (setting)
       WHERE daytype = 'vacation_weekday' GROUP BY ALL""",
)
def contact_matrix(i: Inputs) -> DataFrame:
    return rounded(contact.combine(i.contacts, "vacation_weekday"), "value")


@query(
    "a15_contact_matrix_custom",
    """SELECT contact_idx, participant_idx, round(sum(CASE setting WHEN 'home' THEN 2.0::DOUBLE * value WHEN 'work' THEN 0.5::DOUBLE * value ELSE 0 END), 6) AS value
       FROM contacts GROUP BY ALL""",
)
def contact_matrix_custom(i: Inputs) -> DataFrame:
    return rounded(contact.combine(i.contacts, weights={"home": 2.0, "work": 0.5}), "value")


@query("a16_orientation", "SELECT setting, participant_idx AS contact_idx, contact_idx AS participant_idx, value FROM contacts")
def orientation(i: Inputs) -> DataFrame:
    return contact.swap_orientation(i.contacts)


@query("a16_shape_check", "SELECT setting, count(*) AS n_cells, count(*) = 225 AS is_square FROM contacts GROUP BY ALL")
def shape_check(i: Inputs) -> DataFrame:
    return contact.shape_report(i.contacts)


@query(
    "a17_matrix_summary",
    """SELECT setting, round(sum(value), 6) AS total, round(avg(value) FILTER (contact_idx = participant_idx), 6) AS mean_diagonal,
         max(value) AS max_value, first(contact_idx ORDER BY value DESC, contact_idx, participant_idx) AS max_contact_idx,
         first(participant_idx ORDER BY value DESC, contact_idx, participant_idx) AS max_participant_idx FROM contacts GROUP BY ALL""",
)
def matrix_summary(i: Inputs) -> DataFrame:
    return rounded(contact.matrix_summary(i.contacts), "total", "mean_diagonal")


CASES = """
    SELECT daytype AS scenario, setting, w FROM lambdas WHERE daytype <> 'holiday'
    UNION ALL SELECT 'school_closed', setting, CASE WHEN setting = 'school' THEN 0 ELSE w END FROM lambdas WHERE daytype = 'weekday_school'"""


@query(
    "a18_scenarios",
    f"""SELECT scenario, round(total, 4) AS total, round((SELECT sum(value) FROM contacts) - total, 4) AS reduction FROM (
          SELECT scenario, sum(w * value) AS total FROM contacts JOIN ({CASES}) USING (setting) GROUP BY ALL)""",
)
def scenarios(i: Inputs) -> DataFrame:
    out = contact.compare_scenarios(i.contacts, contact.scenarios(), "weekday_school")
    return rounded(out, "total", "reduction", digits=4)


@query("a19_ili_long", "SELECT * FROM ili")
def ili_long(i: Inputs) -> DataFrame:
    return i.ili


@query(
    "a20_ili_series",
    "SELECT week_in_season, iso_week, ili_rate FROM ili WHERE age_group = '0' AND season = '1997-1998' AND is_valid_week AND week_in_season BETWEEN 4 AND 40",
)
def ili_series(i: Inputs) -> DataFrame:
    one = ili.series(ili.for_age(i.ili, "0"), "1997-1998", True, 4, 40)
    return one.select("week_in_season", "iso_week", "ili_rate")


@query(
    "a21_ili_by_age",
    "SELECT age_group, count(*) AS n_rows, count(ili_rate) AS n_rates, sum(ili_rate) AS rate_sum FROM ili GROUP BY ALL",
)
def ili_by_age(i: Inputs) -> DataFrame:
    return i.ili.groupBy("age_group").agg(
        F.count("*").alias("n_rows"), F.count("ili_rate").alias("n_rates"), F.sum("ili_rate").alias("rate_sum")
    )


@query(
    "a22_season_stats",
    """SELECT age_group, season, avg(ili_rate) AS mean, max(ili_rate) AS max, min(ili_rate) AS min,
         count(*) FILTER (ili_rate IS NULL) AS n_missing FROM ili WHERE is_valid_week GROUP BY ALL""",
)
def season_stats(i: Inputs) -> DataFrame:
    return ili.season_stats(i.ili, "age_group")


@query(
    "a23_missing_weeks",
    """SELECT age_group, season, string_agg(week_in_season::VARCHAR, ',' ORDER BY week_in_season) AS weeks FROM ili
       WHERE is_valid_week AND ili_rate IS NULL GROUP BY ALL""",
)
def missing_weeks(i: Inputs) -> DataFrame:
    out = ili.missing_weeks(i.ili, "age_group")
    return out.withColumn("weeks", F.array_join("weeks", ","))


@query(
    "a24_age_bridge",
    """SELECT season, week_in_season, age_idx, CASE WHEN count(ili_rate) = any_value(n_groups) THEN round(sum(weight * ili_rate), 6) END AS rate
       FROM ili JOIN bridge USING (age_group) JOIN (SELECT age_idx, count(*) AS n_groups FROM bridge GROUP BY ALL) USING (age_idx)
       WHERE is_valid_week GROUP BY season, week_in_season, age_idx""",
)
def age_bridge(i: Inputs) -> DataFrame:
    return rounded(ili.to_15_ages(i.ili, ili.bridge(i.spark)), "rate")


PLAIN_BRIDGE = " UNION ALL ".join(
    f"SELECT '{g}' AS age_group, unnest({m}) AS age_idx" for g, m in vocab.ILI_BRIDGE_UNWEIGHTED.items()
)


@query(
    "a24_age_bridge_unweighted",
    f"""SELECT season, week_in_season, age_idx, CASE WHEN count(ili_rate) = any_value(n_groups) THEN sum(ili_rate) END AS rate
       FROM ili JOIN ({PLAIN_BRIDGE}) USING (age_group)
       JOIN (SELECT age_idx, count(*) AS n_groups FROM ({PLAIN_BRIDGE}) GROUP BY ALL) USING (age_idx)
       WHERE is_valid_week GROUP BY season, week_in_season, age_idx""",
)
def age_bridge_unweighted(i: Inputs) -> DataFrame:
    return ili.to_15_ages(i.ili, ili.bridge(i.spark, weighted=False))


@query(
    "a25_bridge_coverage",
    """SELECT season, age_idx, round(sum(weight), 6) AS coverage FROM (SELECT DISTINCT season, age_group FROM ili) JOIN bridge USING (age_group) GROUP BY ALL""",
)
def bridge_coverage(i: Inputs) -> DataFrame:
    """Coverage per season of the groups that are really in the data."""
    present = i.ili.select("season", "age_group").distinct()
    joined = present.join(ili.bridge(i.spark), "age_group")
    out = joined.groupBy("season", "age_idx").agg(F.sum("weight").alias("coverage"))
    return rounded(out, "coverage")


@query(
    "x04_daily_contacts",
    """SELECT date, daytype, contact_idx, participant_idx, round(v, 6) AS value FROM cal JOIN (
         SELECT daytype, contact_idx, participant_idx, sum(w * value) AS v FROM contacts JOIN lambdas USING (setting) GROUP BY ALL) USING (daytype)""",
)
def daily_contacts(i: Inputs) -> DataFrame:
    days = calendar.calendar_table(i.cal_span, "s", "e")
    return rounded(contact.daily_series(i.contacts, days), "value")


@query(
    "x06_align_weeks",
    """SELECT i.calendar_year AS iso_year, i.iso_week, i.season, i.ili_rate, w.episodes, i.age_group FROM ili i
       JOIN (SELECT iso_year, iso_week, sum(episodes)::BIGINT AS episodes FROM weekly GROUP BY ALL) w
         ON i.calendar_year = w.iso_year AND i.iso_week = w.iso_week WHERE i.is_valid_week""",
)
def align_weeks(i: Inputs) -> DataFrame:
    return blending.align_weeks(i.ili, claims.weekly(i.claims), extra=["age_group"])
