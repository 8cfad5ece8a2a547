"""Sources, sinks and ingest. Each query writes and reads data Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow import vocab
from ebbflow.functions import calendar
from ebbflow.functions.columns import month_key
from ebbflow.operators import census, codebook, employment, ili, population, mobility, quality
from ebbflow.plans.bindings import CAPITAL, Inputs
from ebbflow.plans.catalog import query, rounded
from ebbflow.plans.population_queries import REGIONS
from ebbflow.session import shared_dir
from ebbflow.sources import ingest, readers, sinks
from ebbflow.streaming import ingest as stream


@query(
    "s01_movement_csv",
    """SELECT ETL_YMD, count(*) AS n, sum(TOTAL) AS total, sum(AVG_DIST) AS dist, sum(AVG_TIME) AS minutes,
         count(DISTINCT O_CELL_ID) AS n_origins, min(TIME_CD) AS first_time, max(AGE_CD) AS last_age
       FROM od_raw GROUP BY ALL""",
)
def movement_csv(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark)
    sinks.write_csv(i.od_raw, path)
    return readers.movement_csv(i.spark, path).groupBy("ETL_YMD").agg(
        F.count("*").alias("n"),
        F.sum("TOTAL").alias("total"),
        F.sum("AVG_DIST").alias("dist"),
        F.sum("AVG_TIME").alias("minutes"),
        F.count_distinct("O_CELL_ID").alias("n_origins"),
        F.min("TIME_CD").alias("first_time"),
        F.max("AGE_CD").alias("last_age"),
    )


@query(
    "s02_population_csv",
    """SELECT ADMDONG_CD, TIMEZN_CD, count(*) AS n, sum(POP) AS pop FROM lp_raw GROUP BY ALL""",
)
def population_csv(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark)
    sinks.write_csv(i.lp_raw, path)
    return readers.population_csv(i.spark, path).groupBy("ADMDONG_CD", "TIMEZN_CD").agg(
        F.count("*").alias("n"), F.sum("POP").alias("pop")
    )


CENSUS_LONG = """
    SELECT a.admdong_cd, a.admdong_nm, a.sgg_nm, a.sido_nm, g.age_5_start, coalesce(c.pop_5, 0)::BIGINT AS pop_5
    FROM (SELECT DISTINCT admdong_cd, admdong_nm, sgg_nm, sido_nm FROM census5) a
    CROSS JOIN (SELECT unnest(range(0, 101, 5))::INTEGER AS age_5_start) g
    LEFT JOIN census5 c ON c.admdong_cd = a.admdong_cd AND c.age_5_start = g.age_5_start"""


@query("s03_census_csv", CENSUS_LONG)
def census_csv(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark)
    readers.korean_charsets(i.spark)
    i.census_text.write.options(header=True, encoding=readers.KOREAN).csv(path)
    return census.parse(readers.census_csv(i.spark, path))


@query(
    "s04_employment_csv",
    """SELECT region_raw, age_label, population_15plus, employed AS worked_total FROM employment""",
)
def employment_csv(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark)
    readers.korean_charsets(i.spark)
    text = [F.col(c).cast("string") for c in ("population_15plus", "worked_total")]
    rows = i.employment_raw.select(
        "region_raw", "sex", "age_label", *text, *[F.lit("0").alias(c) for c in employment.RAW_COLUMNS[5:]]
    )
    titles = rows.limit(2).select(*[F.lit(f"항목 {c}").alias(c) for c in rows.columns])
    titles.unionByName(rows).write.options(encoding=readers.KOREAN).csv(path)
    raw = readers.employment_csv(i.spark, path)
    kept = raw.filter(
        (F.col("sex") == "계") & (F.col("age_label") != "합계") & (F.col("region_raw") != "동부")
    )
    return kept.select("region_raw", "age_label", "population_15plus", "worked_total")


@query(
    "s05_ili_csv",
    """SELECT season, season_start_year, week_in_season, iso_week, calendar_year, is_valid_week, ili_rate
       , age_group FROM ili""",
)
def ili_csv(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark)
    readers.korean_charsets(i.spark)
    slots = [c for c in i.ili_wide.columns if c not in ("age_group", "season")]
    files = []
    for number, group in enumerate(vocab.ILI_AGE_GROUPS):  # a fixed list of seven, a folder each
        files.append(f"{path}/{number}")
        mine = i.ili_wide.filter(F.col("age_group") == group).select("season", *slots)
        mine.write.options(encoding=readers.KOREAN).csv(files[-1])
    folder = F.element_at(F.split(F.input_file_name(), "/"), -2).cast("int")
    group_of = F.get(F.array(*map(F.lit, vocab.ILI_AGE_GROUPS)), folder)
    read = readers.ili_csv(i.spark, files).withColumn("age_group", group_of)
    return ili.to_long(read, ("age_group",))


@query("s06_claims_normalised", "SELECT * FROM claims")
def claims_normalised(i: Inputs) -> DataFrame:
    return i.claims


@query(
    "s07_parquet_projection",
    """SELECT c_mktsegment, count(*) AS n, max(c_nationkey) AS last_nation FROM customer GROUP BY ALL""",
)
def parquet_projection(i: Inputs) -> DataFrame:
    df = readers.parquet(i.spark, f"{i.folder}/customer.parquet", ["c_mktsegment", "c_nationkey"])
    return df.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.max("c_nationkey").alias("last_nation")
    )


MOVEMENT_ORDER = ["date", "hour", "o_admdong_cd", "d_admdong_cd", "age_10"]


def _written_od(i: Inputs) -> str:
    path = shared_dir(i.spark)
    sinks.write_months(i.od, path, MOVEMENT_ORDER)
    return path


@query(
    "s08_glob_scan",
    """SELECT (date // 100)::INTEGER AS yyyymm, count(*) AS n, sum(total) AS total
       FROM od WHERE date // 10000 = 1997 GROUP BY ALL""",
)
def glob_scan(i: Inputs) -> DataFrame:
    path = _written_od(i)
    year = i.spark.read.option("basePath", path).parquet(f"{path}/yyyymm=1997*")
    return year.groupBy("yyyymm").agg(F.count("*").alias("n"), F.sum("total").alias("total"))


@query("s09_union_files", "SELECT admdong_cd, sido_nm, age_5_start, pop_5 FROM census5")
def union_files(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark)
    paths = [f"{path}/{number}" for number in range(len(REGIONS))]
    for region, one in zip(REGIONS, paths):
        i.census5.filter(F.col("sido_nm") == region).write.parquet(one)
    return readers.parquet(i.spark, paths).select("admdong_cd", "sido_nm", "age_5_start", "pop_5")


@query(
    "s10_month_sink",
    """SELECT (date // 100)::INTEGER AS yyyymm, count(*) AS n, sum(total) AS total,
         sum(avg_dist * total) AS dist FROM od GROUP BY ALL""",
)
def month_sink(i: Inputs) -> DataFrame:
    """Written twice, the second time one year only: the other months must stay."""
    path = _written_od(i)
    sinks.write_months(i.od.filter(F.col("date").between(19980101, 19981231)), path, MOVEMENT_ORDER)
    out = i.spark.read.parquet(path).groupBy("yyyymm").agg(
        F.count("*").alias("n"),
        F.sum("total").alias("total"),
        F.sum(F.col("avg_dist") * F.col("total")).alias("dist"),
    )
    return rounded(out, "dist", digits=0)


@query(
    "s11_csv_sink",
    """SELECT age_10, round(median(detection_rate), 6) AS median, count(*) AS n_areas FROM detection GROUP BY ALL""",
)
def csv_sink(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark)
    summary = population.detection_summary(population.detection(i.lp, i.census10, 50))
    sinks.write_csv(rounded(summary.select("age_10", "median", "n_areas"), "median"), path)
    return i.spark.read.schema("age_10 int, median double, n_areas bigint").csv(path, header=True)


@query(
    "s12_age_columns",
    f"SELECT age_5_start, sum(pop_5)::BIGINT AS pop FROM ({CENSUS_LONG}) GROUP BY ALL",
)
def age_columns(i: Inputs) -> DataFrame:
    return census.parse(i.census_text).groupBy("age_5_start").agg(F.sum("pop_5").alias("pop"))


SPINE = """
    SELECT strftime(unnest(generate_series(date_trunc('month', min(l_shipdate)), max(l_shipdate), INTERVAL 1 MONTH)), '%Y%m') AS yyyymm
    FROM lineitem"""


def _spine(i: Inputs) -> DataFrame:
    span = i.table("lineitem").agg(
        F.min("l_shipdate").cast("date").alias("s"), F.max("l_shipdate").cast("date").alias("e")
    )
    return calendar.month_spine(span, "s", "e")


@query(
    "s13_pending_months",
    f"""SELECT yyyymm, CASE WHEN yyyymm::INTEGER % 3 = 0 THEN 'SKIPPED' WHEN yyyymm::INTEGER % 5 = 0 THEN 'MISSING_INPUT'
          ELSE 'PENDING' END AS status FROM ({SPINE})""",
)
def pending_months(i: Inputs) -> DataFrame:
    months = i.od_raw.select(month_key(F.col("ETL_YMD")).alias("yyyymm")).distinct()
    number = F.col("yyyymm").cast("int")
    return ingest.plan(_spine(i), months.filter(number % 3 == 0), months.filter(number % 5 != 0))


FEED = """strftime(strptime({0}::VARCHAR, '%Y%m%d') - CASE WHEN {0} % 100 = 1 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END, '%Y%m')"""


def _placed_totals(i: Inputs, fed: DataFrame) -> DataFrame:
    """What the feed holds of trips with both ends in an area, by month of the feed."""
    trips = mobility.place_trips(fed, i.cells)
    return trips.groupBy(F.col("yyyymm").cast("string").alias("yyyymm")).agg(F.sum("total").alias("total"))


@query(
    "s13_ingest_run",
    f"""SELECT s.yyyymm,
          CASE WHEN s.yyyymm::INTEGER % 3 = 0 THEN 'SKIPPED' WHEN f.yyyymm IS NULL THEN 'MISSING_INPUT' ELSE 'OK' END AS status,
          CASE WHEN s.yyyymm::INTEGER % 3 <> 0 AND f.yyyymm IS NOT NULL THEN coalesce(m.n_rows, 0) END AS output_rows,
          CASE WHEN s.yyyymm::INTEGER % 3 <> 0 AND f.yyyymm IS NOT NULL THEN m.total END AS total_sum,
          CASE WHEN s.yyyymm::INTEGER % 3 <> 0 AND f.yyyymm IS NOT NULL THEN coalesce(m.stray, 0) END AS stray_rows
        FROM ({SPINE}) s
        LEFT JOIN (SELECT DISTINCT {FEED.format("ETL_YMD")} AS yyyymm FROM od_raw) f ON s.yyyymm = f.yyyymm
        LEFT JOIN (SELECT {FEED.format("date")} AS yyyymm, count(*) AS n_rows, sum(total) AS total,
                     count(*) FILTER (date % 100 = 1) AS stray FROM od GROUP BY ALL) m ON s.yyyymm = m.yyyymm""",
)
def ingest_run(i: Inputs) -> DataFrame:
    """The feed lands as month folders; a run takes the months the output lacks. What is dated
    the first of a month comes in the feed of the month before."""
    path = shared_dir(i.spark)
    landing = f"{path}/landing"
    day = F.to_date(F.col("ETL_YMD").cast("string"), "yyyyMMdd")
    feed_day = F.when(F.dayofmonth(day) == 1, F.date_sub(day, 1)).otherwise(day)
    fed = i.od_raw.withColumn("yyyymm", F.date_format(feed_day, "yyyyMM"))
    sinks.write_months(fed, landing, ["ETL_YMD", "TIME_CD"])
    spine = _spine(i)
    done = spine.filter(F.col("yyyymm").cast("int") % 3 == 0)

    def load(months: list[str]) -> DataFrame:
        feed = i.spark.read.parquet(landing)
        return feed.filter(F.col("yyyymm").isin([int(m) for m in months]))

    result = ingest.run(
        i.spark, load, lambda raw: mobility.refine(raw, i.cells, i.capital), spine, done,
        readers.files(i.spark, landing, "*.parquet"),
        f"{path}/movement", f"{path}/ledger", "total", MOVEMENT_ORDER,
        ingest.keeps_totals(_placed_totals(i, fed), "total"),
    )
    return result.drop("error", "output_bytes", "elapsed_sec", "quarantined_rows")


@query(
    "s14_code_book",
    """SELECT sido_cd, sido_nm, count(*) AS n_areas, count(DISTINCT sgg_cd) AS n_districts
       FROM areas JOIN customer ON c_nationkey = nationkey WHERE sido_cd IN ('00', '01', '02') GROUP BY ALL""",
)
def code_book(i: Inputs) -> DataFrame:
    """Counts over the customers' areas, so the work grows with the table."""
    book = i.areas.join(
        i.table("customer").select(F.col("c_nationkey").alias("nationkey")), "nationkey"
    )
    return codebook.counts(codebook.region(book, CAPITAL))


@query(
    "s15_before_after",
    """SELECT count(*) AS rows_before, count(*) FILTER (ADMDONG_CD < '03') AS rows_after, sum(POP) AS sum_before,
         sum(POP) FILTER (ADMDONG_CD < '03') AS sum_after FROM lp_raw""",
)
def before_after(i: Inputs) -> DataFrame:
    return quality.before_after_table(i.lp_raw, F.col("ADMDONG_CD") < "03", "POP")


@query(
    "s15_population_ledger",
    """SELECT b.*, output_rows, unique_admdongs, pop_sum_after, abs(pop_sum_before - pop_sum_after) AS pop_diff FROM (
         SELECT (ETL_YMD // 100)::VARCHAR AS yyyymm, count(*) AS input_rows, count(*) FILTER (ADMDONG_CD < '03') AS filtered_rows,
           sum(POP) FILTER (ADMDONG_CD < '03') AS pop_sum_before FROM lp_raw GROUP BY ALL) b
       JOIN (SELECT (date // 100)::VARCHAR AS yyyymm, count(*) AS output_rows, count(DISTINCT admdong_cd) AS unique_admdongs,
           sum(pop) AS pop_sum_after FROM lp GROUP BY ALL) USING (yyyymm)""",
)
def population_ledger(i: Inputs) -> DataFrame:
    return population.month_ledger(i.lp_raw, i.lp, i.capital)


@query("s16_month_spine", SPINE)
def month_spine(i: Inputs) -> DataFrame:
    return _spine(i)


@query("z01_stream_ingest", "SELECT * FROM od")
def stream_ingest(i: Inputs) -> DataFrame:
    """The raw feed as files, picked up by two runs of the stream of which the second has lost
    the checkpoint of the first, then merged by month; equal to the batch."""
    path = shared_dir(i.spark)
    landing, output = f"{path}/landing", f"{path}/movement"
    late = F.col("ETL_YMD") >= 19980615
    for n, part in enumerate((i.od_raw.filter(~late), i.od_raw.filter(late))):
        part.write.mode("append").parquet(landing)
        feed = stream.stream_files(i.spark, landing, part.schema, "parquet", "*.parquet")
        stream.ingest_movement(feed, i.cells, output, f"{path}/checkpoint{n}")
    stream.compact_movement(i.spark, output)
    return stream.read_movement(i.spark, output, i.capital)


@query("z01_stream_population", "SELECT * FROM lp")
def stream_population(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark)
    landing, output = f"{path}/landing", f"{path}/population"
    late = F.col("ETL_YMD") >= 20240115
    for n, part in enumerate((i.lp_raw.filter(~late), i.lp_raw.filter(late))):
        part.write.mode("append").parquet(landing)
        feed = stream.stream_files(i.spark, landing, part.schema, "parquet", "*.parquet")
        stream.ingest_population(feed, i.capital, output, f"{path}/checkpoint{n}")
    stream.compact_population(i.spark, output)
    return stream.read_population(i.spark, output, i.capital)
