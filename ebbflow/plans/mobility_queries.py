"""Movement: refinement, mean daily flows, reports and blending."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow.functions import calendar
from ebbflow.functions.columns import kind_of, ratio
from ebbflow.operators import blending, flows, mobility, population, series, stats
from ebbflow.plans.bindings import Inputs
from ebbflow.plans.catalog import query, rounded
from ebbflow.session import shared_dir


@query("a01_od_month", "SELECT * FROM od")
def od_month(i: Inputs) -> DataFrame:
    return mobility.with_names(i.od, i.capital)


@query("a02_od_month_purpose", "SELECT * FROM od_purpose")
def od_month_purpose(i: Inputs) -> DataFrame:
    return mobility.with_names(i.od_purpose, i.capital)


@query("a08_daily_flow", "SELECT * FROM pi")
def daily_flow(i: Inputs) -> DataFrame:
    return i.pi


@query(
    "a08_daily_flow_all_days",
    """SELECT o_admdong_cd, d_admdong_cd, least(age_10, 70) AS age_7, hour,
         sum(total) / (SELECT count(DISTINCT date) FROM od) AS pi FROM od WHERE age_10 >= 10 GROUP BY ALL""",
)
def daily_flow_all_days(i: Inputs) -> DataFrame:
    return mobility.daily_flow(
        i.od, "all", index=mobility.area_index(i.capital), dated=i.trips
    )


@query("a08_flow_by_months", "SELECT * FROM pi")
def flow_by_months(i: Inputs) -> DataFrame:
    """The trips come in two deliveries of months, the mean flow from their parts."""
    table = flows.FlowTable(i.spark, shared_dir(i.spark))
    late = F.col("date") >= 19950101
    for trips in (i.od.filter(~late), i.od.filter(late)):
        table.add(trips)
    return table.flow()


@query(
    "a09_flow_marginals",
    """SELECT CASE WHEN grouping(age_7) = 0 THEN 'age' WHEN grouping(hour) = 0 THEN 'hour'
         WHEN grouping(o_admdong_cd) = 0 THEN 'origin' ELSE 'total' END AS margin, age_7, hour, o_admdong_cd,
         round(sum(pi), 6) AS flow FROM pi GROUP BY GROUPING SETS ((age_7), (hour), (o_admdong_cd), ())""",
)
def flow_marginals(i: Inputs) -> DataFrame:
    return rounded(mobility.flow_marginals(i.pi), "flow")


@query(
    "a09_outflow_extremes",
    """SELECT round(avg(flow), 6) AS mean_outflow, round(max(flow), 6) AS max_outflow FROM (
         SELECT o_admdong_cd, sum(pi) AS flow FROM pi GROUP BY ALL)""",
)
def outflow_extremes(i: Inputs) -> DataFrame:
    out = mobility.outflow_extremes(i.pi)
    return rounded(out, "mean_outflow", "max_outflow")


@query(
    "a10_dense_slice",
    """SELECT o.admdong_cd AS o_admdong_cd, d.admdong_cd AS d_admdong_cd, coalesce(pi, 0)::DOUBLE AS pi
       FROM capital o CROSS JOIN capital d LEFT JOIN pi ON o.admdong_cd = o_admdong_cd AND d.admdong_cd = d_admdong_cd
         AND age_7 = 30 AND hour = 8""",
)
def dense_slice(i: Inputs) -> DataFrame:
    index = mobility.area_index(i.capital)
    return mobility.dense_cells(mobility.dense_rows(i.pi, index, 30, 8), index)


@query(
    "a27_moves_per_person",
    """SELECT m.age_10, total_moves, avg_pop_total, total_moves / avg_pop_total AS moves_per_person
       FROM (SELECT age_10, sum(total) AS total_moves FROM od GROUP BY ALL) m JOIN avg_pop USING (age_10)""",
)
def moves_per_person(i: Inputs) -> DataFrame:
    moves = i.od.groupBy("age_10").agg(F.sum("total").alias("total_moves"))
    joined = moves.join(population.mean_population_by_age(i.lp), "age_10")
    return joined.withColumn("moves_per_person", ratio(F.col("total_moves"), F.col("avg_pop_total")))


@query(
    "a28_totals_by_dimension",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d}::VARCHAR AS key, sum(total) AS total FROM od_purpose GROUP BY ALL"
        for d in ("date", "hour", "age_10", "purpose")
    ),
)
def totals_by_dimension(i: Inputs) -> DataFrame:
    return mobility.totals_by(i.od_purpose, ["date", "hour", "age_10", "purpose"])


@query(
    "a29_destinations",
    """SELECT grp, avg(n) AS mean_destinations, median(n) AS median_destinations, sum(total_trips) AS total_trips FROM (
         SELECT CASE WHEN age_10 = 70 THEN 'old' ELSE 'adult' END AS grp, o_admdong_cd, count(DISTINCT d_admdong_cd) AS n,
           sum(total) AS total_trips FROM od WHERE age_10 IN (30, 40, 50, 70) GROUP BY ALL) GROUP BY ALL""",
)
def destinations(i: Inputs) -> DataFrame:
    grp = F.when(F.col("age_10") == 70, "old").otherwise("adult")
    some = i.od.filter(F.col("age_10").isin(30, 40, 50, 70)).withColumn("grp", grp)
    per_origin = mobility.destinations_per_origin(some, "grp")
    return stats.summary(
        per_origin, ["grp"], "n_destinations", {"median_destinations": 0.5},
        [F.avg("n_destinations").alias("mean_destinations"), F.sum("total_trips").alias("total_trips")],
    )


@query("a30_net_flow", "SELECT * FROM net")
def net_flow(i: Inputs) -> DataFrame:
    return mobility.net_flow(i.od)


WEIGHTED = [0.25, 0.5, 0.75, 0.9, 0.99]


@query(
    "a31_weighted_quantiles",
    """SELECT kind, round(any_value(s) / any_value(w), 6) AS mean, """
    + ", ".join(f"min(avg_dist) FILTER (cum >= {q} * w) AS p{int(q * 100)}" for q in WEIGHTED)
    + """ FROM (SELECT kind, avg_dist, sum(total) OVER (PARTITION BY kind ORDER BY avg_dist) AS cum,
           sum(total) OVER (PARTITION BY kind) AS w, sum(avg_dist * total) OVER (PARTITION BY kind) AS s
         FROM (SELECT CASE WHEN o_admdong_cd = d_admdong_cd THEN 'within' ELSE 'cross' END AS kind, avg_dist, total
               FROM od WHERE avg_dist > 0)) GROUP BY kind""",
)
def weighted_quantiles(i: Inputs) -> DataFrame:
    kind = kind_of(F.col("o_admdong_cd"), F.col("d_admdong_cd"))
    trips = i.od.filter(F.col("avg_dist") > 0).withColumn("kind", kind)
    out = stats.exact_quantiles(
        trips, ["kind"], "avg_dist", WEIGHTED, weight="total", method="weighted", max_groups=2
    )
    return rounded(out.drop("n", "min", "max"), "mean")


DIST_SQL = "sum(avg_dist * total) / sum(total)"


@query(
    "a32_distance_by_hour",
    f"""SELECT hour, 'all' AS kind, round({DIST_SQL}, 6) AS w_avg_dist FROM od WHERE avg_dist > 0 GROUP BY ALL
        UNION ALL SELECT hour, CASE WHEN o_admdong_cd = d_admdong_cd THEN 'within' ELSE 'cross' END, round({DIST_SQL}, 6)
        FROM od WHERE avg_dist > 0 GROUP BY ALL""",
)
def distance_by_hour(i: Inputs) -> DataFrame:
    """All trips and the split by kind from one aggregation: the totals add up the splits."""
    kind = kind_of(F.col("o_admdong_cd"), F.col("d_admdong_cd"))
    split = mobility.mean_distance_by(i.od, F.col("hour"), kind.alias("kind")).select("hour", "kind", "num", "den")
    both = split.groupingSets([[F.col("hour"), F.col("kind")], [F.col("hour")]], F.col("hour"), F.col("kind"))
    out = both.agg(ratio(F.sum("num"), F.sum("den")).alias("w_avg_dist"))
    return rounded(out.select("hour", F.coalesce("kind", F.lit("all")).alias("kind"), "w_avg_dist"), "w_avg_dist")


@query("a32_distance_by_age", f"SELECT age_10, round({DIST_SQL}, 6) AS w_avg_dist FROM od WHERE avg_dist > 0 GROUP BY ALL")
def distance_by_age(i: Inputs) -> DataFrame:
    out = mobility.mean_distance_by(i.od, "age_10").select("age_10", "w_avg_dist")
    return rounded(out, "w_avg_dist")


def _profile_sql(dim: str) -> str:
    return f"""SELECT {dim}, hour, sum(total) AS total, sum(total) / nullif(sum(sum(total)) OVER (PARTITION BY {dim}), 0) AS share
        FROM od_purpose GROUP BY {dim}, hour"""


@query("a33_purpose_hour_profile", _profile_sql("purpose"))
def purpose_hour_profile(i: Inputs) -> DataFrame:
    sums = i.od_purpose.groupBy("purpose", "hour").agg(F.sum("total").alias("total"))
    return stats.share_of_group(sums, ["purpose"], "total", "share")


@query("a33_age_hour_profile", _profile_sql("age_10"))
def age_hour_profile(i: Inputs) -> DataFrame:
    sums = i.od.groupBy("age_10", "hour").agg(F.sum("total").alias("total"))
    return stats.share_of_group(sums, ["age_10"], "total", "share")


@query(
    "a34_log_histogram",
    """SELECT b.bin, round(10 ** (any_value(lo) + b.bin * (any_value(hi) - any_value(lo)) / 59), 4) AS "left",
         coalesce(sum(total) FILTER (x.bin = b.bin), 0) AS count FROM (SELECT unnest(range(59))::INTEGER AS bin) b, (
         SELECT *, least(coalesce(floor((t - lo) / nullif((hi - lo) / 59, 0)), 0), 58)::INTEGER AS bin FROM (
           SELECT total, log10(avg_dist) AS t, (SELECT log10(greatest(min(avg_dist), 1e-3)) FROM od WHERE avg_dist > 0) AS lo,
             (SELECT log10(max(avg_dist)) FROM od WHERE avg_dist > 0) AS hi FROM od WHERE avg_dist > 0) WHERE t >= lo) x GROUP BY b.bin""",
)
def log_histogram(i: Inputs) -> DataFrame:
    out = stats.histogram(i.od, "avg_dist", 59, weight="total", scale="log10", floor=1e-3)
    return rounded(out.select("bin", "left", "count"), "left", digits=4)


@query(
    "a35_histogram",
    """SELECT grp, b.bin, round(any_value(lo) + b.bin * (any_value(hi) - any_value(lo)) / 40, 6) AS "left",
         round(any_value(lo) + (b.bin + 1) * (any_value(hi) - any_value(lo)) / 40, 6) AS "right",
         count(*) FILTER (x.bin = b.bin) AS count FROM (SELECT unnest(range(40))::INTEGER AS bin) b, (
         SELECT *, least(floor((avg_dist - lo) / ((hi - lo) / 40)), 39)::INTEGER AS bin FROM (
           SELECT CASE WHEN age_10 >= 70 THEN 'old' ELSE 'other' END AS grp, avg_dist,
             min(avg_dist) OVER () AS lo, max(avg_dist) OVER () AS hi FROM od WHERE avg_dist > 0 AND avg_dist < 20000)) x GROUP BY grp, b.bin""",
)
def plain_histogram(i: Inputs) -> DataFrame:
    grp = F.when(F.col("age_10") >= 70, "old").otherwise("other")
    out = stats.histogram(
        i.od.withColumn("grp", grp), "avg_dist", 40, keys=["grp"], low=0, high=20000, open_interval=True
    )
    return rounded(out, "left", "right")


@query(
    "a41_distance_profile",
    "SELECT count(*) AS n, "
    + ", ".join(f"round(quantile_cont(avg_dist, {q}), 6) AS p{int(q * 100)}" for q in (0.05, 0.25, 0.5, 0.75, 0.95))
    + ", max(avg_dist) AS max, round(avg(avg_dist), 6) AS mean FROM od WHERE o_admdong_cd = d_admdong_cd AND avg_dist > 0",
)
def distance_profile(i: Inputs) -> DataFrame:
    same = i.od.filter((F.col("o_admdong_cd") == F.col("d_admdong_cd")) & (F.col("avg_dist") > 0))
    out = stats.exact_quantiles(same, [], "avg_dist", [0.05, 0.25, 0.5, 0.75, 0.95], max_groups=1)
    return rounded(out.drop("min"), "mean", "p5", "p25", "p50", "p75", "p95")


@query(
    "a53_weekday_trips",
    """SELECT age_10, sum(total) / (SELECT n_days FROM wd_days) AS daily_avg_trips, sum(total) AS total_trips, count(*) AS n_records
       FROM od_days WHERE day_type = 'weekday' GROUP BY ALL""",
)
def weekday_trips(i: Inputs) -> DataFrame:
    return mobility.weekday_trips_by_age(i.od, dated=i.trips)


@query(
    "a54_distance_quantiles_by_age",
    "SELECT age_10, "
    + ", ".join(f"round(quantile_cont(avg_dist, {q}), 6) AS p{int(q * 100)}" for q in (0.1, 0.25, 0.5, 0.75, 0.9))
    + ", round(avg(avg_dist), 6) AS mean FROM od_days WHERE day_type = 'weekday' GROUP BY ALL",
)
def distance_quantiles_by_age(i: Inputs) -> DataFrame:
    weekdays = i.od.filter(calendar.week_part(F.col("date")) == "weekday")
    out = stats.exact_quantiles(
        weekdays, ["age_10"], "avg_dist", [0.1, 0.25, 0.5, 0.75, 0.9], max_groups=9
    )
    return rounded(out.drop("n", "min", "max"), "mean", "p10", "p25", "p50", "p75", "p90")


@query(
    "a55_same_area_share",
    """SELECT age_10, coalesce(sum(total) FILTER (o_admdong_cd = d_admdong_cd), 0) / sum(total) * 100 AS same_pct FROM od GROUP BY ALL""",
)
def same_area_share(i: Inputs) -> DataFrame:
    return mobility.same_area_share(i.od, "age_10")


@query(
    "a56_hour_share",
    """SELECT grp, hour, trips, trips / sum(trips) OVER (PARTITION BY grp) * 100 AS pct FROM (
         SELECT CASE WHEN age_10 = 70 THEN 'old' ELSE 'adult' END AS grp, hour, sum(total) AS trips
         FROM od WHERE age_10 IN (30, 40, 50, 70) GROUP BY ALL)""",
)
def hour_share(i: Inputs) -> DataFrame:
    grp = F.when(F.col("age_10") == 70, "old").otherwise("adult")
    sums = (
        i.od.filter(F.col("age_10").isin(30, 40, 50, 70))
        .groupBy(grp.alias("grp"), "hour")
        .agg(F.sum("total").alias("trips"))
    )
    out = stats.share_of_group(sums, ["grp"], "trips", "_share")
    return out.select("grp", "hour", "trips", (F.col("_share") * 100).alias("pct"))


# -- monthly series -----------------------------------------------------------------------


@query(
    "a58_outlier_months",
    """SELECT yyyymm, total, total / m AS times_median FROM (SELECT *, (SELECT list_sort(list(total))[count(*) // 2 + 1] FROM months) AS m FROM months)
       WHERE total < 0.97 * m OR total > 1.03 * m""",
)
def outlier_months(i: Inputs) -> DataFrame:
    months = series.monthly_totals(i.od, "total")
    return series.outliers_by_upper_median(months, 0.97, 1.03)


@query(
    "a59_yearly",
    """SELECT substr(yyyymm, 1, 4) AS year, avg(total) AS avg_total, min(total) AS min_total, max(total) AS max_total FROM months GROUP BY ALL""",
)
def yearly(i: Inputs) -> DataFrame:
    return series.yearly(series.monthly_totals(i.od, "total"))


@query(
    "a60_below_median",
    "SELECT yyyymm, total, n_rows FROM months WHERE total < 0.9 * (SELECT median(total) FROM months)",
)
def below_median(i: Inputs) -> DataFrame:
    return series.below_median(series.monthly_totals(i.od, "total"), 0.9)


@query(
    "a61_extremes",
    """SELECT (SELECT yyyymm FROM months ORDER BY total, yyyymm LIMIT 1) AS min_month, (SELECT min(total) FROM months) AS min_total,
         (SELECT yyyymm FROM months ORDER BY total DESC, yyyymm LIMIT 1) AS max_month, (SELECT max(total) FROM months) AS max_total,
         (SELECT total FROM months ORDER BY yyyymm LIMIT 1) AS first_total, (SELECT total FROM months ORDER BY yyyymm DESC LIMIT 1) AS last_total""",
)
def extremes(i: Inputs) -> DataFrame:
    return series.extremes(series.monthly_totals(i.od, "total"))


def _ledger(months: DataFrame) -> DataFrame:
    status = F.when(F.col("yyyymm").cast("int") % 3 == 0, "SKIPPED").otherwise("OK")
    return months.select(
        "yyyymm", status.alias("status"), F.col("n_rows").alias("output_rows"), F.col("total").alias("total_sum")
    )


@query("a62_ledger_status", "SELECT status, count(*) AS n FROM ledger GROUP BY ALL")
def ledger_status(i: Inputs) -> DataFrame:
    months = series.monthly_totals(i.od, "total")
    return _ledger(months).groupBy("status").agg(F.count("*").alias("n"))


@query("a62_back_fill", "SELECT yyyymm, output_rows, total_sum FROM ledger")
def back_fill(i: Inputs) -> DataFrame:
    months = series.monthly_totals(i.od, "total")
    return series.fill_skipped(_ledger(months), months)


@query(
    "w03_month_change",
    """SELECT * FROM (SELECT yyyymm, total, (total - lag(total) OVER (ORDER BY yyyymm)) / lag(total) OVER (ORDER BY yyyymm) * 100 AS pct FROM months)
       WHERE abs(pct) > 5""",
)
def month_change(i: Inputs) -> DataFrame:
    return series.month_change(series.monthly_totals(i.od, "total"), 5)


# -- windows and top-k -----------------------------------------------------------------------


@query(
    "w01_hourly_moves_normalised",
    "SELECT age_10, hour, sum(total) AS moves, sum(total) / avg(sum(total)) OVER (PARTITION BY age_10) AS normalised FROM od GROUP BY age_10, hour",
)
def hourly_moves_normalised(i: Inputs) -> DataFrame:
    hourly = population.hourly_totals(i.od, "total", "age_10", alias="moves")
    return stats.relative_to_group_mean(hourly, ["age_10"], "moves", "normalised")


@query(
    "w02_normalised_by_daytype",
    """SELECT day_type, age_10, hour, sum(total) AS moves, sum(total) / avg(sum(total)) OVER (PARTITION BY age_10, day_type) AS normalised
       FROM od_days GROUP BY day_type, age_10, hour""",
)
def normalised_by_daytype(i: Inputs) -> DataFrame:
    typed = i.od.withColumn("day_type", calendar.week_part(F.col("date")))
    hourly = population.hourly_totals(typed, "total", "day_type", "age_10", alias="moves")
    return stats.relative_to_group_mean(hourly, ["age_10", "day_type"], "moves", "normalised")


@query("w04_area_index", "SELECT admdong_cd, (dense_rank() OVER (ORDER BY admdong_cd) - 1)::INTEGER AS area_idx FROM (SELECT DISTINCT o_admdong_cd AS admdong_cd FROM od)")
def area_index(i: Inputs) -> DataFrame:
    return mobility.area_index(i.od.select(F.col("o_admdong_cd").alias("admdong_cd")))


@query(
    "w05_running_weight",
    """SELECT * FROM (SELECT floor(avg_dist / 1000)::INTEGER AS km, sum(total) AS w, sum(sum(total)) OVER (ORDER BY floor(avg_dist / 1000)) AS running
       FROM od WHERE avg_dist > 0 GROUP BY floor(avg_dist / 1000))""",
)
def running_weight(i: Inputs) -> DataFrame:
    """Running trips over kilometre bins: the window sees one row per kilometre."""
    from pyspark.sql import Window

    km = F.floor(F.col("avg_dist") / 1000).cast("int")
    bins = i.od.filter(F.col("avg_dist") > 0).groupBy(km.alias("km")).agg(F.sum("total").alias("w"))
    return bins.withColumn("running", F.sum("w").over(Window.orderBy("km")))


@query(
    "t01_sorted_write",
    "SELECT date // 100 AS yyyymm, count(*) AS n, true AS sorted FROM od GROUP BY ALL",
)
def sorted_write(i: Inputs) -> DataFrame:
    """Rows of every written file are in key order."""
    from pyspark.sql import Window

    from ebbflow.plans.source_queries import _written_od

    rows = i.spark.read.parquet(_written_od(i)).select(
        "yyyymm", "date", "hour", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    key = F.col("date") * 100 + F.col("hour")
    previous = F.lag(key).over(Window.partitionBy("file").orderBy("row"))
    checked = rows.withColumn("_ok", F.coalesce(previous <= key, F.lit(True)))
    return checked.groupBy("yyyymm").agg(F.count("*").alias("n"), F.every("_ok").alias("sorted"))


@query(
    "t02_top_pairs",
    """(SELECT 'same' AS kind, * FROM pairs WHERE o_admdong_cd = d_admdong_cd ORDER BY total DESC, o_admdong_cd, d_admdong_cd LIMIT 20)
       UNION ALL (SELECT 'cross', * FROM pairs WHERE o_admdong_cd <> d_admdong_cd ORDER BY total DESC, o_admdong_cd, d_admdong_cd LIMIT 20)""",
)
def top_pairs(i: Inputs) -> DataFrame:
    same = mobility.top_pairs(i.od, True).withColumn("kind", F.lit("same"))
    return same.unionByName(mobility.top_pairs(i.od, False).withColumn("kind", F.lit("cross")))


@query(
    "t03_top_pairs_by_hour",
    """SELECT * FROM (SELECT hour, o_admdong_cd, d_admdong_cd, sum(total) AS total, row_number() OVER (PARTITION BY hour
         ORDER BY sum(total) DESC, o_admdong_cd, d_admdong_cd)::INTEGER AS rank FROM od
       WHERE o_admdong_cd <> d_admdong_cd AND hour IN (3, 8, 12, 18) GROUP BY hour, o_admdong_cd, d_admdong_cd) WHERE rank <= 10""",
)
def top_pairs_by_hour(i: Inputs) -> DataFrame:
    cross = i.od.filter(
        (F.col("o_admdong_cd") != F.col("d_admdong_cd")) & F.col("hour").isin(3, 8, 12, 18)
    )
    order = [F.desc("total"), F.col("o_admdong_cd"), F.col("d_admdong_cd")]
    return stats.top_per_group(mobility.pair_totals(cross, ["hour"]), ["hour"], order, 10)


@query(
    "t04_top_net_flow",
    """(SELECT 'activity' AS side, * FROM net ORDER BY net DESC, admdong_cd LIMIT 5)
       UNION ALL (SELECT 'residential', * FROM net ORDER BY net, admdong_cd LIMIT 5)""",
)
def top_net_flow(i: Inputs) -> DataFrame:
    return mobility.top_and_bottom_net(mobility.net_flow(i.od), 5)


# -- blending -----------------------------------------------------------------------------


@query(
    "x01_split_decades",
    """SELECT o_admdong_cd, d_admdong_cd, age_5_start, hour, round(pi * share, 6) AS pi FROM pi JOIN (
         SELECT admdong_cd AS o_admdong_cd, g.age_5_start // 10 * 10 AS age_7, g.age_5_start,
           coalesce(coalesce(sum(pop_5) FILTER (c.age_5_start = g.age_5_start), 0)
             / nullif(sum(pop_5) FILTER (c.age_5_start // 10 = g.age_5_start // 10), 0), 0.5) AS share
         FROM census5 c CROSS JOIN (SELECT unnest(range(10, 70, 5))::INTEGER AS age_5_start) g GROUP BY ALL) USING (o_admdong_cd, age_7)
       UNION ALL SELECT o_admdong_cd, d_admdong_cd, age_7, hour, round(pi, 6) FROM pi WHERE age_7 >= 70""",
)
def split_decades(i: Inputs) -> DataFrame:
    return rounded(blending.split_decades(i.pi, i.census5), "pi")


@query(
    "x02_detection_correction",
    "SELECT o_admdong_cd, d_admdong_cd, age_7, hour, round(CASE WHEN age_7 BETWEEN 20 AND 69 THEN pi * (1 / 0.9::DOUBLE) ELSE pi END, 6) AS pi FROM pi",
)
def detection_correction(i: Inputs) -> DataFrame:
    return rounded(blending.correct_detection(i.pi), "pi")


@query(
    "x02_median_correction",
    """SELECT o_admdong_cd, d_admdong_cd, age_7, hour, round(coalesce(pi / nullif(median, 0), pi), 6) AS pi
       FROM pi LEFT JOIN (SELECT age_10 AS age_7, median(detection_rate) AS median FROM detection GROUP BY ALL) USING (age_7)""",
)
def median_correction(i: Inputs) -> DataFrame:
    summary = population.detection_summary(population.detection(i.lp, i.census10, 50))
    return rounded(blending.correct_by_median(i.pi, summary), "pi")


@query(
    "x03_static_flows",
    """SELECT DISTINCT admdong_cd AS o_admdong_cd, admdong_cd AS d_admdong_cd, unnest([0, 5, 70])::INTEGER AS age_5_start, 1::DOUBLE AS weight
       FROM census5""",
)
def static_flows(i: Inputs) -> DataFrame:
    return blending.static_flows(i.census5)
