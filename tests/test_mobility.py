import math

import pytest
from support import rows
from pyspark.sql import functions as F

from ebbflow import joins
from ebbflow.operators import blending, flows, mobility
from ebbflow.session import shared_dir
from ebbflow.sources import sinks
from ebbflow.sources.published import MonthTable

RAW = "ETL_YMD int, TIME_CD string, O_CELL_ID string, D_CELL_ID string, SEX_CD string, AGE_CD string, PURPOSE tinyint, TOTAL double, AVG_DIST double, AVG_TIME double"


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame([("c1", "A", "a"), ("c2", "A", "a"), ("c3", "B", "b")], "cell_id string, admdong_cd string, admdong_nm string")


@pytest.fixture(scope="module")
def areas(cells):
    return cells.select("admdong_cd", "admdong_nm").distinct()


@pytest.fixture(scope="module")
def raw(spark):
    # 2023-01-02 and -03 are weekdays, -07 a Saturday, -23 a holiday on a Monday
    data = [
        (20230102, "0800", "c1", "c3", "M", "20", 1, 2.0, 100.0, 10.0),
        (20230102, "0830", "c2", "c3", "F", "20", 2, 6.0, 300.0, 20.0),
        (20230103, "0900", "c1", "c2", "F", "80", 3, 4.0, 50.0, 5.0),
        (20230107, "0900", "c1", "c3", "F", "70", 3, 1.0, 50.0, 5.0),
        (20230123, "0900", "c3", "c1", "F", "00", 3, 0.0, 50.0, 5.0),
        (20230103, "0900", "c1", "out", "F", "30", 3, 9.0, 50.0, 5.0),
    ]
    return spark.createDataFrame(data, RAW)


def test_refine_weights_means_and_drops_outside(raw, cells, areas):
    got = rows(mobility.refine(raw, cells, areas))
    assert (20230102, 8, "A", "a", "B", "b", 20, 8.0, 250.0, 17.5) in got
    assert (20230123, 9, "B", "b", "A", "a", 0, 0.0, None, None) in got  # zero weight: null, no error
    assert len(got) == 4


def test_purpose_product_keeps_purpose_and_total(raw, cells, areas):
    two = mobility.refine(raw, cells, areas, keep_purpose=True)
    assert two.columns.index("purpose") == two.columns.index("age_10") + 1
    total = lambda df: df.agg(F.sum("total")).first()[0]
    assert two.count() == 5 and total(two) == total(mobility.refine(raw, cells)) == 13.0


def test_daily_flow_divides_by_days_present(raw, cells):
    od = mobility.refine(raw, cells)
    got = rows(mobility.daily_flow(od))
    assert got == [("A", "A", 70, 9, 2.0), ("A", "B", 20, 8, 4.0)]
    weekend = rows(mobility.daily_flow(od, "weekend"))
    assert weekend == [("A", "B", 70, 9, 0.5)]  # Saturday and the holiday
    assert mobility.day_count(od, "all").first()[0] == 4


def test_daily_flow_errors(raw, cells):
    od = mobility.refine(raw, cells)
    with pytest.raises(ValueError):
        mobility.daily_flow(od, "sunday")
    with pytest.raises(Exception, match="no weekend dates"):
        mobility.daily_flow(od.filter("date < 20230104"), "weekend").collect()


def test_unmapped_rows_are_counted_and_dropped(spark, raw, cells):
    od = mobility.refine(raw, cells)
    index = spark.createDataFrame([("A", 0)], "admdong_cd string, area_idx int")
    report = mobility.unmapped_report(mobility.flag_mapped(od, index)).first()
    assert (report.n_rows, report.n_mapped, report.n_unmapped) == (4, 1, 3)
    assert rows(mobility.daily_flow(od, "weekday", index=index)) == [("A", "A", 70, 9, 2.0)]


def test_dense_slice_is_square_and_keeps_the_flow(inputs):
    index = mobility.area_index(inputs.capital)
    cells = mobility.dense_cells(mobility.dense_rows(inputs.pi, index, 30, 8), index)
    n = index.count()
    part = inputs.pi.filter("age_7 = 30 AND hour = 8").agg(F.sum("pi")).first()[0] or 0.0
    assert cells.count() == n * n
    assert math.isclose(cells.agg(F.sum("pi")).first()[0], part)


def test_marginals_agree_with_total(inputs):
    got = mobility.flow_marginals(inputs.pi).groupBy("margin").agg(F.sum("flow")).collect()
    assert len(got) == 4 and all(math.isclose(r[1], got[0][1]) for r in got)


def test_net_flow_sums_to_zero_and_equals_the_join(inputs):
    flow = mobility.net_flow(inputs.od)
    assert abs(flow.agg(F.sum("net")).first()[0]) < 1e-6
    assert rows(flow.select("admdong_cd", "inflow", "outflow")) == rows(mobility.inflow_outflow_join(inputs.od))


def test_lookup_falls_back_to_a_shuffle_join_above_the_bound(spark, raw, cells, monkeypatch):
    expected = rows(mobility.refine(raw, cells))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = mobility.refine(raw, cells)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in hinted
        monkeypatch.setattr(joins.small, "__defaults__", (None, 2))
        free = mobility.refine(raw, cells)
        assert "BroadcastHashJoin" not in free._jdf.queryExecution().executedPlan().toString()
        assert rows(free) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_decade_split_keeps_the_flow(inputs):
    split = blending.split_decades(inputs.pi, inputs.census5)
    whole = inputs.pi.join(inputs.census5.select(F.col("admdong_cd").alias("o_admdong_cd")).distinct(), "o_admdong_cd")
    total = lambda df: df.agg(F.sum("pi")).first()[0]
    assert math.isclose(total(split), total(whole))
    assert {r[0] for r in split.select("age_5_start").distinct().collect()} <= {*range(10, 75, 5)}


def test_static_flows_stay_at_home(inputs):
    flows = blending.static_flows(inputs.areas)
    assert flows.filter("o_admdong_cd <> d_admdong_cd OR weight <> 1").count() == 0
    assert flows.count() == inputs.areas.count() * 3


def test_missing_column_is_reported(spark, cells):
    with pytest.raises(ValueError, match="TIME_CD"):
        mobility.refine(spark.range(1), cells)


def test_flows_of_months_equal_the_full_run(spark, raw, cells):
    path = shared_dir(spark)
    more = raw.withColumn("ETL_YMD", F.col("ETL_YMD") + 100).withColumn("TOTAL", F.col("TOTAL") * 3)
    january, february = mobility.refine(raw, cells), mobility.refine(more, cells)
    sinks.write_months(january, f"{path}/od", ["hour"])
    table = flows.FlowTable(spark, f"{path}/flows")
    assert table.add(spark.read.parquet(f"{path}/od/yyyymm=202301")) == ["202301"]
    first = {f for f in MonthTable(spark, table.root).read().inputFiles()}
    # February is added by its own trips alone: January's parts stay the files they were
    assert table.add(february) == ["202302"]
    assert first < set(MonthTable(spark, table.root).read().inputFiles())
    both = january.unionByName(february)
    for daytype in ("weekday", "weekend", "all"):
        assert rows(table.flow(daytype=daytype)) == rows(mobility.daily_flow(both, daytype))
        if daytype != "weekend":  # February has none
            assert rows(table.flow("202302", "202302", daytype)) == rows(mobility.daily_flow(february, daytype))
    assert rows(table.flow("202301", "202301")) == rows(mobility.daily_flow(january))
    index = spark.createDataFrame([("A", 0)], "admdong_cd string, area_idx int")
    assert rows(table.flow(index=index)) == rows(mobility.daily_flow(both, index=index))
    # a corrected month takes the place of what it had
    assert table.add(mobility.refine(more.filter("TOTAL > 9"), cells)) == ["202302"]
    assert rows(table.flow("202302")) == rows(mobility.daily_flow(mobility.refine(more.filter("TOTAL > 9"), cells)))
    table.drop(["202302"])
    assert rows(table.flow()) == rows(mobility.daily_flow(january))
    with pytest.raises(Exception, match="no weekday dates"):
        table.flow("209901").collect()
    with pytest.raises(ValueError):
        table.flow(daytype="sunday")
