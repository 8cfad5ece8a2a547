"""The whole flow over a data folder made of small files."""

import pytest
from support import rows
from pyspark.sql import functions as F

from ebbflow import vocab
from ebbflow.operators import mobility
from ebbflow.sources import sinks
from ebbflow.store import Store


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    areas = [("11010010", "a", "s", "서울특별시"), ("41010010", "b", "g", "경기도"), ("26010010", "c", "p", "부산광역시")]
    census = [(*a, age, 10 + age) for a in areas for age in range(0, 105, 5)]
    spark.createDataFrame(census, "admdong_cd string, admdong_nm string, sgg_nm string, sido_nm string, age_5_start int, pop_5 bigint").write.parquet(str(root / "census"))
    od = [(20230102, 8, "11010010", "41010010", 20, 4.0), (20230103, 8, "11010010", "41010010", 20, 2.0),
          (20230102, 8, "11010010", "26010010", 20, 7.0), (20230202, 8, "11010010", "41010010", 20, 50.0)]
    sinks.write_months(spark.createDataFrame(od, "date int, hour int, o_admdong_cd string, d_admdong_cd string, age_10 int, total double"), str(root / "movement"), ["date"])
    cells = [(s, a, b, 1.0) for s in vocab.SETTINGS for a in range(15) for b in range(15)]
    spark.createDataFrame(cells, "setting string, contact_idx int, participant_idx int, value double").write.parquet(str(root / "contacts"))
    for folder, name in (("ili", "seasons_0세.csv"), ("ili", "seasons_65세이상.csv"), ("ili_total", "seasons.csv")):
        (root / folder).mkdir(exist_ok=True)
        (root / folder / name).write_bytes('"2018-2019절기",1,2,3\n'.encode("cp949"))
    (root / "claims" / "inpatient_only").mkdir(parents=True)
    (root / "claims" / "inpatient_only" / "c.csv").write_text(",".join(vocab.CLAIMS_COLUMNS) + "\n2019-09-02,11,남자,1. 0-5세,7\n2019-09-03,26,여자,6. 65세 이상,2\n")
    (root / "employment").mkdir()
    (root / "employment" / "e.csv").write_bytes(("t\nt\n" + "서울특별시,계,15-19세,200,50,1,2,3,4\n").encode("cp949"))
    return Store(spark, str(root))


def test_daily_flow_of_one_month(store):
    assert rows(store.daily_flow("202301")) == [("11010010", "41010010", 20, 8, 3.0)]
    assert store.daily_flow("202301", census_areas=False).count() == 2
    assert store.movement("202301", "202302").count() == 4


def test_population_is_of_the_capital_region(store):
    assert store.population_15().count() == 30
    assert store.population_15(None).count() == 45
    assert mobility.area_index(store.population_15()).agg(F.max("area_idx")).first()[0] == 1


def test_small_sources(store):
    assert store.contact_matrix("weekday_school").agg(F.sum("value")).first()[0] == 900
    assert store.ili().count() == 54 and store.ili("65+").count() == 54
    assert store.claims("inpatient_only", sido_codes=[11]).first().episodes == 7
    assert store.calendar(20230101, 20230131).count() == 31
    rates = {(r.admdong_cd, r.age_idx): r.rho for r in store.area_rates(fill_unknown=0.2).collect()}
    assert len(rates) == 45 and rates["11010010", 3] == 0.25 and rates["26010010", 3] == 0.2
    with pytest.raises(ValueError):
        store.claims("icu")
    with pytest.raises(ValueError):
        store.ili("66+")


def test_broken_contact_matrix_fails(spark, store, tmp_path):
    store.contacts().filter("participant_idx < 14").write.parquet(str(tmp_path / "contacts"))
    with pytest.raises(Exception, match="not 15 x 15"):
        Store(spark, str(tmp_path)).contacts().collect()
