import math

import pytest
from support import rows
from pyspark.sql import functions as F

from ebbflow import vocab
from ebbflow.functions import columns as c
from ebbflow.operators import census, population


def test_age_codes(spark):
    df = spark.createDataFrame([("M05",), ("F70",), ("M75",)], "s string")
    got = df.select(c.age5_of(F.col("s")), c.age10_of(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(5, 0), (70, 70), (75, 70)]


def test_age_groups(spark):
    df = spark.createDataFrame([(a,) for a in range(0, 105, 5)], "a int")
    got = df.select("a", c.age10_from_age5(F.col("a")), c.age_idx15(F.col("a"))).collect()
    assert all(t == min(a, 80) // 10 * 10 and i == min(a, 70) // 5 for a, t, i in got)


def test_fifteen_rows_per_area_and_total_kept(inputs):
    groups = census.to_15_groups(inputs.census5)
    assert {r["count"] for r in groups.groupBy("admdong_cd").count().collect()} == {15}
    total = lambda df, v: df.agg(F.sum(v)).first()[0]
    assert total(groups, "pop") == total(inputs.census5, "pop_5") == total(inputs.census10, "pop")
    assert groups.filter("pop = 0").count() > 0  # the scaffold is really filled
    assert rows(groups.drop("age_group")) == rows(census.scaffold_15(inputs.census5))
    assert {r[0] for r in groups.select("age_group").distinct().collect()} == set(vocab.AGE_LABELS_15)


def test_a_null_name_keeps_its_people(spark):
    df = spark.createDataFrame([("11", None, None, "a", 0, 5)], "admdong_cd string, admdong_nm string, sgg_nm string, sido_nm string, age_5_start int, pop_5 long")
    got = census.scaffold_15(df)
    assert got.count() == 15 and got.agg(F.sum("pop")).first()[0] == 5


def test_both_matrix_forms_agree(inputs):
    groups = census.to_15_groups(inputs.census5)
    assert rows(census.matrix(groups)) == rows(census.pivot_matrix(groups))


def test_population_is_conserved(inputs):
    before = inputs.lp_raw.join(inputs.capital.select(F.col("admdong_cd").alias("ADMDONG_CD")), "ADMDONG_CD")
    assert before.agg(F.sum("POP")).first()[0] == inputs.lp.agg(F.sum("pop")).first()[0]


def test_unknown_age_form(inputs):
    with pytest.raises(ValueError):
        population.refine(inputs.lp_raw, inputs.capital, "age_1")


def test_day_night_and_gap(spark):
    data = [(20230102, 4, "A", 20, 20.0), (20230102, 13, "A", 20, 30.0), (20230103, 13, "A", 20, 50.0),
            (20230102, 4, "B", 20, 5.0), (20230102, 13, "B", 20, 9.0), (20230102, 9, "A", 0, 30.0), (20230107, 9, "A", 0, 20.0)]
    pop = spark.createDataFrame(data, "date int, hour int, admdong_cd string, age_10 int, pop double")
    assert rows(population.day_night(pop)) == [("A", 20, 40.0, 20.0, 2.0)]
    assert rows(population.weekday_weekend_gap(pop)) == [("A", 0, 30.0, 20.0, 10.0, 0.5)]


def test_detection_uses_only_rows_present(spark):
    pop = spark.createDataFrame(
        [(20230101, 3, "A", 20, 10.0), (20230101, 5, "A", 20, 30.0), (20230101, 6, "A", 20, 99.0), (20230101, 3, "B", 20, 1.0)],
        "date int, hour int, admdong_cd string, age_10 int, pop double")
    registered = spark.createDataFrame([("A", 20, 40), ("B", 20, 0)], "admdong_cd string, age_10 int, pop bigint")
    assert rows(population.detection(pop, registered).select("admdong_cd", "detection_rate")) == [("A", 0.5)]
    one = population.detection_summary(population.detection(pop, registered)).first()
    assert one["median"] == 0.5 and one["std"] is None and one.n_areas == 1


def test_strict_and_default_maps(spark):
    df = spark.createDataFrame([("11110515",), ("26000000",)], "code string")
    assert [r[0] for r in df.select(c.sido_by_prefix(F.col("code"))).collect()] == ["서울", "unknown"]
    with pytest.raises(Exception, match="unmapped code: 26"):
        df.select(c.strict_map(F.substring("code", 1, 2), {"11": "x"}, "code")).collect()


def test_ratio_and_nan(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (float("nan"), 1.0)], "a double, b double")
    assert [r[0] for r in df.limit(2).select(c.ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.5]
    assert df.select(F.avg(c.none_if_nan(F.col("a")))).first()[0] == 1.0


def test_speeds(spark):
    df = spark.createDataFrame([(1000.0, 6.0)], "d double, t double")
    got = df.select(*[c.speed_kmh(F.col("d"), F.col("t"), h).alias(h) for h in vocab.SPEED_HYPOTHESES]).first()
    assert math.isclose(got.dist_m_time_min, 10) and math.isclose(got.dist_m_time_10min, 1)
    assert math.isclose(got.dist_100m_time_min, 1000) and math.isclose(got.dist_100m_time_10min, 100)
