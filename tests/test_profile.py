"""Month profiles that merge and agreement of the columns of many files."""

import pytest
from support import rows

from ebbflow.operators import profile, quality
from ebbflow.sources import agreement, readers, sinks
from ebbflow.sources.published import MonthTable

NAN = float("nan")
ROWS = [
    (20230101, 0, "A", 5.0), (20230101, 1, "A", -2.0), (20230131, 1, None, None), (20230201, 1, "B", NAN),
    (20230201, 7, "A", 3.0), (20230201, 7, "A", 3.0), (20230301, None, "C", None),
]
COLUMNS, LISTED = ("total",), ("hour", "area")


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(ROWS, "date int, hour int, area string, total double")


def test_profile_of_nulls_nans_and_text(trips):
    got = {(r.yyyymm, r.column, r.value): r for r in profile.month_profile(trips, COLUMNS, LISTED).collect()}
    january, february = got["202301", "total", None], got["202302", "total", None]
    assert (january.n_rows, january.n_nulls, january.n_negative, january.least, january.most, january.total) == (3, 1, 1, -2.0, 5.0, 3.0)
    assert (february.n_rows, february.n_nans, february.least, february.most, february.total) == (3, 1, 3.0, 3.0, 6.0)
    march = got["202303", "total", None]
    assert (march.n_rows, march.n_nulls, march.least, march.total) == (1, 1, None, None)
    assert got["202301", "area", "A"].n_rows == 2 and got["202301", "area", "A"].least is None
    assert got["202301", "area", None].n_nulls == 1 and got["202302", "hour", "7"].n_rows == 2
    assert profile.month_profile(trips.limit(0), COLUMNS, LISTED).count() == 0
    with pytest.raises(ValueError, match="missing columns"):
        profile.month_profile(trips, ["nowhere"])


def test_parts_merge_into_the_whole(trips):
    whole = profile.month_profile(trips, COLUMNS, LISTED)
    parts = [profile.month_profile(trips.filter(c), COLUMNS, LISTED) for c in ("hour = 1", "hour <> 1", "hour IS NULL")]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rows(profile.merged(union)) == rows(whole)


def test_one_read_for_all_columns(spark, trips, tmp_path):
    sinks.write_months(trips, str(tmp_path), ["date"])
    plan = profile.month_profile(spark.read.parquet(str(tmp_path)), COLUMNS, LISTED)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_months_are_checked_without_their_rows(spark, trips, tmp_path):
    table = profile.ProfileTable(spark, str(tmp_path / "profiles"), COLUMNS, LISTED)
    assert table.read().count() == 0
    assert table.add(trips.filter("date < 20230201")) == ["202301"]
    first = set(MonthTable(spark, table.root).read().inputFiles())
    assert table.add(trips.filter("date >= 20230201")) == ["202302", "202303"]
    assert first < set(MonthTable(spark, table.root).read().inputFiles())
    assert rows(table.read()) == rows(profile.month_profile(trips, COLUMNS, LISTED))
    assert rows(table.read("202302", "202302")) == rows(profile.month_profile(trips.filter("date = 20230201"), COLUMNS, LISTED))
    # a corrected month takes the place of what it had
    assert table.add(trips.filter("date = 20230301").fillna({"total": 9.0})) == ["202303"]
    assert {r.yyyymm: r.total for r in profile.month_totals(table.read(), "total").collect()} == {"202301": 3.0, "202302": 6.0, "202303": 9.0}
    with pytest.raises(Exception, match="no month"):
        table.add(spark.createDataFrame([(None, 1, "A", 1.0)], trips.schema))


def test_report_and_gaps(trips):
    profiles = profile.month_profile(trips, COLUMNS, LISTED)
    bounds = [profile.no_nulls("total"), profile.not_negative("total"), profile.at_most("hour", 6),
              profile.at_least("hour", 0), profile.cardinality("area", 3)]
    got = {(r.column, r.metric): (r.measured, r.status) for r in profile.report(profiles, bounds).collect()}
    assert got == {("total", "n_nulls"): (2.0, "FAIL"), ("total", "n_negative"): (1.0, "FAIL"), ("hour", "most"): (7.0, "FAIL"),
                   ("hour", "least"): (0.0, "PASS"), ("area", "n_values"): (3.0, "PASS")}
    monthly = {(r.yyyymm, r.metric): r.status for r in profile.report(profiles, bounds, "yyyymm").collect() if r.column == "hour"}
    assert monthly["202301", "most"] == "PASS" and monthly["202302", "most"] == "FAIL"
    assert monthly["202303", "most"] == "FAIL"  # an hour that is only null has no extreme
    gaps = rows(profile.value_gaps(profiles, {"hour": [0, 1], "area": ["A"]}))
    assert gaps == sorted(
        [("202302", "area", "B", "extra"), ("202302", "hour", "0", "missing"), ("202302", "hour", "7", "extra"),
         ("202303", "area", "A", "missing"), ("202303", "area", "C", "extra"), ("202303", "hour", "0", "missing"),
         ("202303", "hour", "1", "missing")], key=repr)
    # over one month the same as from the table
    may = trips.filter("date = 20230201")
    mine = profile.value_gaps(profile.month_profile(may, COLUMNS, LISTED), {"hour": [0, 1], "area": ["A"]}).drop("yyyymm")
    assert rows(mine) == rows(quality.value_gaps(may, {"hour": [0, 1], "area": ["A"]}).select("column", "value", "gap"))


def test_columns_of_many_files(spark, trips, tmp_path):
    def schemas(*dfs):
        return agreement.schema_table(spark, {f"f{n}": df.schema for n, df in enumerate(dfs)})

    swapped = trips.select("date", "area", "hour", "total")
    typed = trips.withColumn("hour", trips.hour.cast("long"))
    for others, verdict in (((trips,), "same"), ((swapped,), "order"), ((typed,), "type"), ((trips.drop("hour"),), "missing")):
        table = schemas(trips, trips, *others)
        found = {r.column: r.verdict for r in agreement.column_agreement(table).collect()}
        assert found["hour"] == verdict and found["date"] == "same"
        files = {r.file: (r.group, r.agrees) for r in agreement.file_agreement(table).collect()}
        assert files["f0"] == files["f1"] == (0, True) and files["f2"] == ((0, True) if verdict == "same" else (1, False))
        assert agreement.all_agree(table).first().agrees == (verdict == "same")
    assert agreement.all_agree(schemas()).first().agrees and agreement.column_agreement(schemas()).count() == 0
    empty = schemas(trips, trips.select())
    assert not agreement.all_agree(empty).first().agrees
    assert {r.verdict for r in agreement.column_agreement(empty).collect()} == {"missing"}
    sinks.write_months(trips, str(tmp_path), ["date"])
    read = agreement.schema_table(spark, readers.month_schemas(spark, str(tmp_path)))
    assert agreement.all_agree(read).first().n_files == 3
