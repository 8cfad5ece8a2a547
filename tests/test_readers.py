import pytest
from pyspark.sql import functions as F
from support import rows

from ebbflow import vocab
from ebbflow.functions.columns import month_key
from ebbflow.operators import census, claims, employment, ili, population
from ebbflow.plans.bindings import CENSUS_HEADERS
from ebbflow.sources import ingest, readers, sinks
from ebbflow.sources.published import MonthTable


def cp949(path, text):
    path.write_bytes(text.encode("cp949"))
    return str(path)


def census_text(lines):
    head = ",".join(["행정구역", "2023년01월_계_총인구수", *CENSUS_HEADERS.values()])
    body = [f'"{area}","9,999",' + ",".join(f'"{v:,}"' for v in values) for area, values in lines]
    return "\n".join([head, *body]) + "\n"


def test_census_file(spark, tmp_path):
    values = [1000 + a for a in range(21)]
    text = census_text(
        [
            ("경기도 고양시 (4128000000)", [0] * 21),
            ("경기도 고양시 덕양구 (4128100000)", [0] * 21),
            ("경기도 고양시 덕양구 주교동(4128151000)", values),
            ("서울특별시 강남구 뷁동(1168051000)", values),
        ]
    )
    long = census.parse(readers.census_csv(spark, cp949(tmp_path / "a.csv", text)))
    assert long.count() == 42
    one = rows(long.filter("age_5_start = 100"))
    assert one == [
        ("11680510", "뷁동", "강남구", "서울특별시", 100, 1020),
        ("41281510", "주교동", "고양시 덕양구", "경기도", 100, 1020),
    ]


def test_census_rejects_bad_rows_and_headers(spark, tmp_path):
    bad = census_text([("서울특별시 강남구 신사동", [1] * 21)])
    with pytest.raises(Exception, match="unparsed area"):
        census.parse(readers.census_csv(spark, cp949(tmp_path / "b.csv", bad))).collect()
    with pytest.raises(ValueError, match="21"):
        census.age_columns(["행정구역", "2023년01월_계_0~4세"])


def test_employment_file(spark, tmp_path):
    text = (
        "행정구역별,성별,연령별,15세 이상 인구,일하였음,a,b,c,d\n"
        "행정구역별,성별,연령별,명,명,명,명,명,명\n"
        "서울특별시,계,합계,1000,600,1,2,3,4\n서울특별시,계,15-19세,200,50,1,2,3,4\n"
        "강원도,계,70세 이상,0,0,0,0,0,0\n동부,계,15-19세,9,9,0,0,0,0\n서울특별시,남자,15-19세,100,30,1,2,3,4\n"
    )
    raw = readers.employment_csv(spark, cp949(tmp_path / "e.csv", text))
    assert raw.count() == 5
    got = rows(employment.rates(raw))
    assert got == [("강원", "70세 이상", 14, 0, 0, None), ("서울", "15-19세", 3, 200, 50, 0.25)]
    with pytest.raises(ValueError):
        employment.rates(raw, "남")


def test_employment_numbers_are_read_or_fail(spark, tmp_path):
    good = '서울특별시,계,15-19세,"1,200",50,1,2,3,4\n'
    raw = readers.employment_csv(spark, cp949(tmp_path / "g.csv", "표,,,,,,,,\n지역,성별,연령,명,명,명,명,명,명\n" + good))
    assert rows(raw, "population_15plus", "worked_total") == [(1200, 50)]
    for bad in ("서울특별시,계,15-19세,200,-,1,2,3,4\n", "서울특별시,모름,15-19세,200,5,1,2,3,4\n"):
        with pytest.raises(Exception):
            readers.employment_csv(spark, cp949(tmp_path / "b.csv", good + bad)).collect()


def test_census_files_of_other_column_order(spark, tmp_path):
    one, two = (tmp_path / f"{n}.csv" for n in "ab")
    paths = [cp949(one, "행정구역,x,y\n가,1,2\n"), cp949(two, "행정구역,y,x\n나,2,1\n")]
    assert rows(readers.census_csv(spark, paths), "x", "y") == [("1", "2"), ("1", "2")]
    with pytest.raises(Exception):  # one folder is one header
        readers.census_csv(spark, str(tmp_path)).collect()
    with pytest.raises(Exception):
        readers.census_csv(spark, [paths[0], cp949(tmp_path / "c.csv", "행정구역,x,z\n다,1,2\n")]).collect()


def test_ili_file(spark, tmp_path):
    full = ",".join(str(i) for i in range(54))
    text = f'"2018-2019절기",{full}\n\n"2020-2021절기",1.5,,3\n'
    long = ili.to_long(readers.ili_csv(spark, cp949(tmp_path / "i.csv", text)))
    assert long.count() == 108
    assert long.filter("NOT is_valid_week").agg({"iso_week": "max"}).first()[0] == 0
    short = [r.ili_rate for r in ili.series(long, "2020-2021").collect()]
    assert short[:4] == [1.5, None, 3.0, None] and len(short) == 52
    assert ili.series(long, "2018-2019", start_week=10, end_week=12).count() == 3
    with pytest.raises(Exception, match="unknown season"):
        ili.series(long, "1900-1901").collect()


def test_ili_bad_season_fails(spark, tmp_path):
    with pytest.raises(Exception):
        ili.to_long(readers.ili_csv(spark, cp949(tmp_path / "i.csv", "x-y,1,2\n"))).collect()


def test_ili_files_by_age(spark, tmp_path):
    for suffix in ("0세", "65세이상"):
        cp949(tmp_path / f"seasons_{suffix}.csv", '"2018-2019절기",1,2\n')
    got = readers.ili_by_age_csv(spark, str(tmp_path)).select("age_group").collect()
    assert sorted(r[0] for r in got) == ["0", "65+"]
    cp949(tmp_path / "seasons_성인.csv", '"2018-2019절기",1,2\n')
    with pytest.raises(Exception, match="unknown age group"):
        readers.ili_by_age_csv(spark, str(tmp_path)).collect()


def test_claims_file(spark, tmp_path):
    head = ",".join(vocab.CLAIMS_COLUMNS)
    path = tmp_path / "c.csv"
    path.write_text(f"{head}\n2019-09-02,11,남자,1. 0-5세,7\n2019-09-03,52,여자,6. 65세 이상,2\n")
    got = claims.normalise(readers.claims_csv(spark, str(path)))
    assert [(r.sido_code, r.sex, r.age_group, r.episodes) for r in got.orderBy("date").collect()] == [
        (11, "M", "0-5", 7), (52, "F", "65+", 2)]
    path2 = tmp_path / "d.csv"
    path2.write_text(f"{head}\n2019-09-02,11,남자,7. 없음,7\n")
    with pytest.raises(Exception, match="unmapped age group"):
        claims.normalise(readers.claims_csv(spark, str(path2))).collect()
    with pytest.raises(ValueError, match="missing columns"):
        claims.normalise(spark.range(1))


def test_movement_and_population_csv(spark, tmp_path):
    m = tmp_path / "movement_202301.csv"
    m.write_text("ETL_YMD,TIME_CD,O_CELL_ID,D_CELL_ID,SEX_CD,AGE_CD,PURPOSE,TOTAL,AVG_DIST,AVG_TIME\n20230101,0830,001,002,M,20,1,2.5,100,7\n")
    row = readers.movement_csv(spark, str(m)).first()
    assert (row.O_CELL_ID, row.PURPOSE, row.TOTAL) == ("001", 1, 2.5)
    p = tmp_path / "population_202301.csv"
    p.write_text("ETL_YMD,TIMEZN_CD,ADMDONG_CD,SEX_AGE_CD,POP\n20230101,03,01110515,M05,1.5\n")
    assert readers.population_csv(spark, str(p)).first().ADMDONG_CD == "01110515"
    names = {r.yyyymm for r in readers.files(spark, str(tmp_path), "*.csv").collect()}
    assert names == {"202301"}
    bad = tmp_path / "bad.csv"
    bad.write_text("ETL_YMD,TIMEZN_CD,ADMDONG_CD,SEX_AGE_CD,POP\nx,03,01110515,M05,1.5\n")
    with pytest.raises(Exception):
        readers.population_csv(spark, str(bad)).collect()


def test_month_partitions_are_pruned(spark, tmp_path):
    df = spark.createDataFrame([(20230101, 1.0), (20230201, 2.0), (20230301, 3.0)], "date int, v double")
    path = str(tmp_path / "t")
    sinks.write_months(df, path, ["v"])
    sinks.write_months(df.filter("date = 20230201"), path, ["v"])
    assert readers.parquet(spark, path, ["v"]).count() == 3
    some = readers.months(spark, path, "202302", "202303")
    assert some.count() == 2
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan


MOVEMENT = "ETL_YMD,TIME_CD,O_CELL_ID,D_CELL_ID,SEX_CD,AGE_CD,PURPOSE,TOTAL,AVG_DIST,AVG_TIME"
POPULATION = "ETL_YMD,TIMEZN_CD,ADMDONG_CD,SEX_AGE_CD,POP"
ROW = {MOVEMENT: "20230101,0830,001,002,M,20,1,2.5,100,7", POPULATION: "20230101,03,01110515,M05,1.5"}


@pytest.mark.parametrize("head", [MOVEMENT, POPULATION])
def test_another_header_fails(spark, tmp_path, head):
    read = readers.movement_csv if head is MOVEMENT else readers.population_csv
    schema = readers.MOVEMENT_SCHEMA if head is MOVEMENT else readers.POPULATION_SCHEMA
    names, values = head.split(","), ROW[head].split(",")
    swapped = [2, 3] if head is MOVEMENT else [2, 3]
    order = list(range(len(names)))
    order[swapped[0]], order[swapped[1]] = swapped[1], swapped[0]
    cases = {
        "swapped": ([names[i] for i in order], [values[i] for i in order]),
        "missing": (names[:-1], values[:-1]),
        "extra": ([*names, "MORE"], [*values, "1"]),
        "other": ([*names[:-1], "LAST"], values),
    }
    for case, (header, row) in cases.items():
        path = tmp_path / f"{case}.csv"
        path.write_text(",".join(header) + "\n" + ",".join(row) + "\n")
        for wanted in (["ETL_YMD"], names):
            with pytest.raises(Exception, match="[Hh]eader"):
                read(spark, str(path)).select(*wanted).collect()
        with pytest.raises(Exception, match="[Hh]eader"):
            readers.split_feed(spark, str(path), schema)[1].collect()
    good = tmp_path / "good.csv"
    good.write_text(head + "\n" + ROW[head] + "\n")
    assert read(spark, str(good)).select("ETL_YMD").count() == 1
    with pytest.raises(Exception):  # one file of several
        read(spark, [str(good), str(tmp_path / "swapped.csv")]).collect()


def test_lines_that_do_not_parse_go_to_quarantine(spark, tmp_path):
    for month, lines in {
        "202301": ["20230101,03,A,M05,1.5", "20230101,03,A,M05,x", "20230102,03,A,M05", "20230103,03,A,M05,1,2"],
        "202302": ["20230201,03,A,M05,2"],
    }.items():
        (tmp_path / f"population_{month}.csv").write_text("\n".join([POPULATION, *lines]) + "\n")
    good, bad = readers.split_feed(spark, str(tmp_path), readers.POPULATION_SCHEMA)
    assert rows(good, "ETL_YMD", "POP", "yyyymm") == [(20230101, 1.5, "202301"), (20230201, 2.0, "202302")]
    assert rows(bad, "yyyymm", "line") == [
        ("202301", "20230101,03,A,M05,x"), ("202301", "20230102,03,A,M05"), ("202301", "20230103,03,A,M05,1,2")]
    assert all(r.file.endswith("population_202301.csv") for r in bad.collect())


def test_quarantine_is_counted_in_the_ledger(spark, tmp_path):
    feed, out = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()
    (feed / "population_202301.csv").write_text(f"{POPULATION}\n20230101,03,A,M05,1.5\n20230101,03,A,M05,x\n")
    (feed / "population_202302.csv").write_text(f"{POPULATION}\n20230201,03,A,M05,2\n")
    (feed / "population_202303.csv").write_text("ETL_YMD,TIMEZN_CD,SEX_AGE_CD,ADMDONG_CD,POP\n20230301,03,M05,A,2\n")
    split = lambda ms: readers.split_feed(
        spark, [f"{feed}/population_{m}.csv" for m in ms], readers.POPULATION_SCHEMA)
    areas = spark.createDataFrame([("A",)], "admdong_cd string")

    def refine(raw):
        return population.sums(raw, areas).withColumn("yyyymm", month_key(F.col("date")))

    three = spark.createDataFrame([("202301",), ("202302",), ("202303",)], "yyyymm string")
    got = ingest.run(
        spark, lambda ms: split(ms)[0], refine, three, three.limit(0), readers.files(spark, str(feed)),
        out, str(tmp_path / "ledger"), "pop", ["hour"], malformed=lambda ms: split(ms)[1])
    lines = {r.yyyymm: r for r in got.collect()}
    assert [(lines[m].status, lines[m].output_rows, lines[m].quarantined_rows) for m in sorted(lines)] == [
        ("OK", 1, 1), ("OK", 1, 0), ("FAILED", None, None)]
    assert "eader" in lines["202303"].error
    kept = spark.read.parquet(f"{out}/quarantine").filter("line IS NOT NULL")
    assert {r.line for r in kept.collect()} == {"20230101,03,A,M05,x"}


def test_a_long_season_row_fails(spark, tmp_path):
    for n in (55, 60):
        path = cp949(tmp_path / f"{n}.csv", '"2018-2019절기",' + ",".join(["1"] * n) + "\n")
        with pytest.raises(Exception, match="more than 54 weeks"):
            ili.to_long(readers.ili_csv(spark, path)).collect()


@pytest.mark.parametrize("first", [True, False])
def test_months_of_other_columns(spark, tmp_path, first):
    path = str(tmp_path / "t")
    with_, without = ("202301", "202302") if first else ("202302", "202301")
    row = lambda m: int(m + "01")
    a = spark.createDataFrame([(row(with_), 1.0, 7)], "date int, v double, purpose int")
    b = spark.createDataFrame([(row(without), 2.0)], "date int, v double")
    table = MonthTable(spark, str(tmp_path / "published"))
    for df in (a, b):
        sinks.write_months(df, path, ["v"])
        table.publish_months(table.measure(table.stage(df, ["v"]), df, "v"))
    want = sorted([(row(with_), 1.0, 7), (row(without), 2.0, None)])
    assert rows(readers.months(spark, path, "202301", "202302"), "date", "v", "purpose") == want
    assert rows(table.read(), "date", "v", "purpose") == want
    one = readers.months(spark, path, without, without)
    assert rows(one, "date", "v", "purpose") == [(row(without), 2.0, None)]
    sinks.write_months(spark.createDataFrame([(20230301, "x")], "date int, v string"), path, ["v"])
    with pytest.raises(ValueError, match="column v"):
        readers.months(spark, path, "202301", "202302")
