import pytest
from support import rows
from pyspark.sql import functions as F

from ebbflow.functions.columns import month_key
from ebbflow.operators import mobility, quality, series
from ebbflow.session import shared_dir
from ebbflow.sources import ingest, sinks
from ebbflow.sources.published import FileChanged, MonthTable
from ebbflow.streaming import ingest as stream
from test_mobility import RAW, areas, cells, raw  # noqa: F401

ORDER = ["date", "hour"]


def months(spark, *names):
    return spark.createDataFrame([(m,) for m in names], "yyyymm string")


def fed(raw):  # noqa: F811
    return raw.withColumn("yyyymm", month_key(F.col("ETL_YMD")))


def test_a_stray_row_cannot_replace_its_month(spark, raw, cells):  # noqa: F811
    path = shared_dir(spark)
    refine = lambda df: mobility.refine(df, cells)
    january, two = months(spark, "202301"), months(spark, "202301", "202302")
    late = raw.limit(1).withColumns({"ETL_YMD": F.lit(20230131), "yyyymm": F.lit("202302")})
    feed = fed(raw).unionByName(late)
    load = lambda ms: feed.filter(F.col("yyyymm").isin(ms))
    args = (f"{path}/out", f"{path}/ledger", "total", ORDER)
    ingest.run(spark, load, refine, january, two.limit(0), two, *args)
    before = rows(MonthTable(spark, args[0]).read().drop("yyyymm"))
    got = ingest.run(spark, load, refine, two, january, two, *args)
    by_month = {r.yyyymm: (r.status, r.output_rows, r.stray_rows) for r in got.collect()}
    assert by_month == {"202301": ("SKIPPED", None, None), "202302": ("OK", 1, 1)}
    assert rows(MonthTable(spark, args[0]).read("202301", "202301").drop("yyyymm")) == before
    assert len(MonthTable(spark, args[0]).read().inputFiles()) == 2


def test_months_without_output_have_a_ledger_row(spark, raw, cells):  # noqa: F811
    path = shared_dir(spark)
    two = months(spark, "202301", "202302")
    out = ingest.run(
        spark, lambda ms: fed(raw).filter(F.col("yyyymm").isin(ms)), lambda df: mobility.refine(df, cells.limit(0)),
        two, two.limit(0), two, f"{path}/out", f"{path}/ledger", "total", ORDER)
    assert {(r.yyyymm, r.status, r.output_rows, r.total_sum, r.output_bytes) for r in out.collect()} == {
        ("202301", "OK", 0, None, 0), ("202302", "OK", 0, None, 0)}
    assert out.filter("elapsed_sec > 0").count() == 2


def test_run_is_idempotent_and_keeps_a_ledger(spark, raw, cells):  # noqa: F811
    path = shared_dir(spark)
    refine = lambda df: mobility.refine(df, cells)
    expected = months(spark, "202301", "202302")
    load = lambda ms: fed(raw).filter(F.col("yyyymm").isin(ms))
    args = (f"{path}/out", f"{path}/ledger", "total", ORDER)
    have = months(spark, "202301")
    first = ingest.run(spark, load, refine, expected, expected.limit(0), have, *args)
    assert {(r.yyyymm, r.status, r.output_rows, r.total_sum) for r in first.collect()} == {
        ("202301", "OK", 4, 13.0), ("202302", "MISSING_INPUT", None, None)}
    done = spark.read.parquet(args[1]).filter("status = 'OK'").select("yyyymm")
    again = ingest.run(spark, load, refine, expected, done, have, *args)
    assert {r.status for r in again.collect()} == {"SKIPPED", "MISSING_INPUT"}
    assert MonthTable(spark, args[0]).read().count() == 4 and spark.read.parquet(args[1]).count() == 4


def test_a_bad_month_fails_alone(spark, raw, cells):  # noqa: F811
    path = shared_dir(spark)
    bad = raw.limit(1).withColumns({"ETL_YMD": F.lit(20230215), "AGE_CD": F.lit("xx")})
    both = raw.unionByName(bad)
    two = months(spark, "202301", "202302")
    out = ingest.run(
        spark, lambda ms: fed(both).filter(F.col("yyyymm").isin(ms)), lambda df: mobility.refine(df, cells),
        two, two.limit(0), two, f"{path}/out", f"{path}/ledger", "total", ORDER)
    got = {r.yyyymm: r for r in out.collect()}
    assert got["202301"].status == "OK" and got["202301"].output_rows == 4
    assert got["202302"].status == "FAILED" and got["202302"].error


def test_a_run_that_dies_shows_the_old_months(spark, raw, cells, monkeypatch):  # noqa: F811
    path = shared_dir(spark)
    january = months(spark, "202301")
    args = (january, january.limit(0), january, f"{path}/out", f"{path}/ledger", "total", ORDER)
    table = MonthTable(spark, f"{path}/out")
    ingest.run(spark, lambda ms: fed(raw), lambda df: mobility.refine(df, cells), *args)
    before, listed = rows(table.read()), table.months().collect()
    doubled = fed(raw).withColumn("TOTAL", F.col("TOTAL") * 2)

    def die(self, *_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(MonthTable, "publish", die)
        with pytest.raises(KeyboardInterrupt):
            ingest.run(spark, lambda ms: doubled, lambda df: mobility.refine(df, cells), *args)
    assert rows(table.read()) == before and table.months().collect() == listed
    assert len(table.unpublished()) == 1
    ingest.run(spark, lambda ms: doubled, lambda df: mobility.refine(df, cells), *args)
    assert table.months().first().total_sum == 26.0 and table.read().count() == 4
    # the ledger of what was published, from the manifests alone
    history = [(r.version, r.yyyymm, r.output_rows, r.total_sum) for r in table.ledger().orderBy("version").collect()]
    assert history == [(1, "202301", 4, 13.0), (2, "202301", 4, 26.0)]
    with pytest.raises(RuntimeError, match="published since"):
        table.publish([], base=1)


def test_audits_keep_months_back(spark, raw, cells):  # noqa: F811
    path = shared_dir(spark)
    two = months(spark, "202301", "202302")
    feed = fed(raw).unionByName(fed(raw).withColumns({"ETL_YMD": F.lit(20230201), "yyyymm": F.lit("202302")}))
    totals = spark.createDataFrame([("202301", 13.0), ("202302", 12.0)], "yyyymm string, total double")
    audit = ingest.all_of(ingest.keeps_totals(totals, "total"), ingest.full_groups(["date", "hour"], 99))
    run = lambda a: ingest.run(
        spark, lambda ms: feed.filter(F.col("yyyymm").isin(ms)), lambda df: mobility.refine(df, cells),
        two, two.limit(0), two, f"{path}/out", f"{path}/ledger", "total", ORDER, a)
    got = {r.yyyymm: (r.status, r.error) for r in run(ingest.keeps_totals(totals, "total")).collect()}
    assert got["202301"] == ("OK", None) and got["202302"][0] == "FAILED" and "feed has 12.0" in got["202302"][1]
    assert [r.yyyymm for r in MonthTable(spark, f"{path}/out").months().collect()] == ["202301"]
    both = {r.yyyymm: r.error for r in run(audit).collect()}
    assert "have not 99 rows" in both["202301"] and "feed has" in both["202302"]


def landed(spark, part, path, cells, mark):  # noqa: F811
    part.coalesce(1).write.mode("append").parquet(f"{path}/landing")
    feed = stream.stream_files(spark, f"{path}/landing", part.schema, "parquet", "*.parquet")
    stream.ingest_movement(feed, cells, f"{path}/out", f"{path}/{mark}")
    return feed


def test_stream_equals_batch_whatever_is_lost(spark, raw, cells, areas):  # noqa: F811
    path = shared_dir(spark)
    batch = rows(mobility.refine(raw, cells, areas))
    table = MonthTable(spark, f"{path}/out")
    # two files of one month; the second run has lost the checkpoint and meets the first again
    landed(spark, raw.filter("TOTAL > 3"), path, cells, "mark")
    feed = landed(spark, raw.filter("TOTAL <= 3"), path, cells, "other")
    assert rows(stream.read_movement(spark, f"{path}/out", areas)) == batch
    # neither a run without new files nor one more lost checkpoint adds anything
    version = table.versions()[-1]
    for mark in ("other", "third"):
        stream.ingest_movement(feed, cells, f"{path}/out", f"{path}/{mark}")
    assert table.versions()[-1] == version and len(table.files()) == 2
    assert rows(stream.read_movement(spark, f"{path}/out", areas)) == batch
    # a read touches one folder a month after the folders are merged
    assert len({f.rsplit("/", 1)[0] for f in table.read().inputFiles()}) == 2
    assert stream.compact_movement(spark, f"{path}/out") == ["202301"]
    assert len({f.rsplit("/", 1)[0] for f in table.read().inputFiles()}) == 1
    assert rows(stream.read_movement(spark, f"{path}/out", areas)) == batch
    assert stream.compact_movement(spark, f"{path}/out") == [] and len(table.files()) == 2
    stream.ingest_movement(feed, cells, f"{path}/out", f"{path}/fourth")
    assert rows(stream.read_movement(spark, f"{path}/out", areas)) == batch
    assert RAW.startswith("ETL_YMD")


def test_a_batch_that_dies_before_it_publishes_adds_nothing(spark, raw, cells, areas, monkeypatch):  # noqa: F811
    path = shared_dir(spark)
    raw.coalesce(1).write.parquet(f"{path}/landing")
    batch = spark.read.parquet(f"{path}/landing").select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").cast("string").alias("_modified"))
    take = lambda df: stream.take(
        df, lambda b: mobility.refine_partials(b, cells), mobility.partial_keys(), "total", f"{path}/out")
    with monkeypatch.context() as patch:
        patch.setattr(MonthTable, "publish", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            take(batch)
    assert MonthTable(spark, f"{path}/out").versions() == []
    take(batch)
    take(batch)  # a replay
    assert rows(stream.read_movement(spark, f"{path}/out", areas)) == rows(mobility.refine(raw, cells, areas))
    with pytest.raises(FileChanged):
        take(batch.withColumn("_modified", F.lit("later")))


def test_empty_files_and_unknown_months(spark, raw, cells, areas):  # noqa: F811
    path = shared_dir(spark)
    landed(spark, raw.limit(0), path, cells, "mark")
    table = MonthTable(spark, f"{path}/out")
    assert table.versions() == [] and table.unpublished() != [""]
    with pytest.raises(ValueError, match="no such month"):
        table.read("209901")
    assert table.read(schema=raw.schema).count() == 0 and table.ledger().count() == 0


def test_stream_reads_csv_files(spark, raw, cells, areas):  # noqa: F811
    path = shared_dir(spark)
    sinks.write_csv(raw, f"{path}/landing")
    feed = stream.stream_files(spark, f"{path}/landing", raw.schema, "csv", "*.csv", header=True)
    stream.ingest_movement(feed, cells, f"{path}/out", f"{path}/mark", keep_purpose=True)
    got = rows(stream.read_movement(spark, f"{path}/out", areas))
    assert got == rows(mobility.refine(raw, cells, areas, keep_purpose=True))


def test_series_checks(spark):
    data = [(f"2023{m:02d}", float(t), 1) for m, t in enumerate([100, 100, 30, 100, 190, 100, 120], 1)]
    m = spark.createDataFrame(data, "yyyymm string, total double, n_rows bigint")
    assert [r.yyyymm for r in series.outliers_by_upper_median(m).orderBy("yyyymm").collect()] == ["202303", "202305"]
    assert [r.yyyymm for r in series.below_median(m).collect()] == ["202303"]
    assert [r.yyyymm for r in series.month_change(m).orderBy("yyyymm").collect()] == ["202303", "202304", "202305", "202306", "202307"]
    e = series.extremes(m).first()
    assert (e.min_month, e.max_month, e.first_total, e.last_total) == ("202303", "202305", 100.0, 120.0)
    even = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 1), ("c", 3.0, 1), ("d", 40.0, 1)], "yyyymm string, total double, n_rows bigint")
    assert {r.yyyymm for r in series.outliers_by_upper_median(even).collect()} == {"a", "d"}  # upper median is 3


def test_back_fill_keeps_every_month(spark):
    ledger = spark.createDataFrame([("a", "OK", 5, 1.0), ("b", "SKIPPED", None, None), ("c", "FAILED", None, None)],
                                   "yyyymm string, status string, output_rows bigint, total_sum double")
    m = spark.createDataFrame([("b", 2.0, 7)], "yyyymm string, total double, n_rows bigint")
    assert rows(series.fill_skipped(ledger, m)) == [("a", 5, 1.0), ("b", 7, 2.0)]


def test_observation_counts_in_one_pass(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("A", 4.0)], "cd string, v double")
    kept, seen = quality.before_after(df, F.col("cd") == "A", "v")
    assert kept.count() == 2
    assert seen.get == {"rows_before": 3, "rows_after": 2, "sum_before": 7.0, "sum_after": 5.0}


def test_quality_report(spark):
    df = spark.createDataFrame([(1, -1.0), (25, None)], "hour int, v double")
    rules = [*quality.no_nulls(["v"]), quality.not_negative("v"), *quality.within("hour", 0, 23), quality.cardinality("hour", 2)]
    got = {r["check"]: (r.metric, r.status) for r in quality.report(df, rules).collect()}
    assert got == {"nulls in v": (1.0, "FAIL"), "negative v": (1.0, "FAIL"), "min hour": (1.0, "PASS"),
                   "max hour": (25.0, "FAIL"), "distinct hour": (2.0, "PASS")}


def test_value_gaps_of_several_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, None)], "n int, c string")
    got = rows(quality.value_gaps(df, {"n": [1, 3], "c": ["a"]}))
    assert got == [("c", "b", "extra"), ("c", None, "extra"), ("n", "2", "extra"), ("n", "3", "missing")]


def test_code_sets(spark):
    left, right = spark.createDataFrame([("a",), ("b",), ("b",)], "k string"), spark.createDataFrame([("b",), ("c",)], "k string")
    r = quality.code_sets(left, right, "k").first()
    assert (r.n_left, r.n_right, r.n_matched, r.only_left, r.only_right, r.pct_of_left) == (2, 2, 1, 1, 1, 50.0)
    assert rows(quality.one_sided(left, right, "k")) == [("a", "left"), ("c", "right")]


def test_empty_left_side(spark):
    empty = spark.createDataFrame([], "k string")
    assert quality.code_sets(empty, empty, "k").first().pct_of_left == 0.0


def test_shared_dir_needs_a_setting_on_a_cluster(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError):
        shared_dir(Session())
