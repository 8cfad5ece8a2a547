"""Origin-destination movement: refinement, mean daily flows and their views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbflow import vocab
from ebbflow.contracts import fail_if_empty, require_choice, require_columns
from ebbflow.functions import calendar
from ebbflow.functions.columns import hour_of, ratio, top_code
from ebbflow.joins import small

RAW_COLUMNS = [
    "ETL_YMD", "TIME_CD", "O_CELL_ID", "D_CELL_ID", "AGE_CD", "PURPOSE",
    "TOTAL", "AVG_DIST", "AVG_TIME",
]


def place_trips(raw: DataFrame, cells: DataFrame) -> DataFrame:
    """Raw trips with both ends placed in areas; trips with an end outside are dropped.

    The cell table is looked up twice. It is broadcast if its count is within the bound;
    beyond that both look-ups are shuffle joins whose skewed partitions (a busy cell) are
    split at run time.
    """
    require_columns(raw, RAW_COLUMNS, "movement feed")
    places = small(cells, ["cell_id", "admdong_cd"])
    origin = places.toDF("O_CELL_ID", "o_admdong_cd")
    destination = places.toDF("D_CELL_ID", "d_admdong_cd")
    return (
        raw.join(origin, "O_CELL_ID")
        .join(destination, "D_CELL_ID")
        .select(
            F.col("ETL_YMD").alias("date"),
            hour_of(F.col("TIME_CD")).alias("hour"),
            "o_admdong_cd",
            "d_admdong_cd",
            F.col("AGE_CD").cast("int").alias("age_10"),
            F.col("PURPOSE").cast("int").alias("purpose"),
            F.col("TOTAL").alias("total"),
            F.col("AVG_DIST").alias("avg_dist"),
            F.col("AVG_TIME").alias("avg_time"),
            *_feed_month(raw),
        )
    )


def _feed_month(df: DataFrame) -> list[str]:
    """The month of the feed a row came in, where the table has it."""
    return ["yyyymm"] if "yyyymm" in df.columns else []


def outside_report(raw: DataFrame, cells: DataFrame) -> DataFrame:
    """Raw trips whose origin or destination is not among the cells, in one scan."""
    known = small(cells, ["cell_id"]).withColumn("_in", F.lit(True))
    flagged = raw.join(known.toDF("O_CELL_ID", "_o"), "O_CELL_ID", "left").join(
        known.toDF("D_CELL_ID", "_d"), "D_CELL_ID", "left"
    )
    return flagged.agg(
        F.count_if(F.col("_o").isNull()).alias("n_origin_outside"),
        F.count_if(F.col("_d").isNull()).alias("n_destination_outside"),
    )


def refine(
    raw: DataFrame, cells: DataFrame, areas: DataFrame | None = None, keep_purpose: bool = False
) -> DataFrame:
    """Movement per (date, hour, origin, destination, decade of age [, purpose]).

    One scan, two look-ups, one shuffle on the group key behind a map-side combine.
    With `areas`, names are attached to the aggregated rows; they never enter the key.
    A column `yyyymm`, the month of the feed, is kept and keeps feeds apart.
    """
    partial = refine_partials(raw, cells, keep_purpose)
    means = finish_partials(partial, combined=True)
    return means if areas is None else with_names(means, areas)


def refine_partials(raw: DataFrame, cells: DataFrame, keep_purpose: bool = False) -> DataFrame:
    """The additive part of `refine`: sums that can be merged again later."""
    keys = partial_keys(keep_purpose) + _feed_month(raw)
    trips = place_trips(raw, cells)
    return trips.groupBy(*keys).agg(
        F.sum("total").alias("total"),
        F.sum(F.col("avg_dist") * F.col("total")).alias("dist_total"),
        F.sum(F.col("avg_time") * F.col("total")).alias("time_total"),
    )


def partial_keys(keep_purpose: bool = False) -> list[str]:
    keys = ["date", "hour", "o_admdong_cd", "d_admdong_cd", "age_10"]
    return keys + ["purpose"] if keep_purpose else keys


def finish_partials(partial: DataFrame, combined: bool = False) -> DataFrame:
    """Turn sums into means, merging the sums of several batches first unless `combined`."""
    keys = partial_keys("purpose" in partial.columns) + _feed_month(partial) * combined
    if not combined:
        partial = partial.groupBy(*keys).agg(
            *[F.sum(c).alias(c) for c in ("total", "dist_total", "time_total")]
        )
    return partial.select(
        *keys,
        "total",
        ratio(F.col("dist_total"), F.col("total")).alias("avg_dist"),
        ratio(F.col("time_total"), F.col("total")).alias("avg_time"),
    )


def with_names(od: DataFrame, areas: DataFrame) -> DataFrame:
    """Refined movement in its published column order, with the names of both areas."""
    names = small(areas, ["admdong_cd", "admdong_nm"])
    named = od.join(names.toDF("o_admdong_cd", "o_admdong_nm"), "o_admdong_cd", "left").join(
        names.toDF("d_admdong_cd", "d_admdong_nm"), "d_admdong_cd", "left"
    )
    extra = ["purpose"] if "purpose" in od.columns else []
    return named.select(
        "date", "hour", "o_admdong_cd", "o_admdong_nm", "d_admdong_cd", "d_admdong_nm",
        "age_10", *extra, "total", "avg_dist", "avg_time", *_feed_month(od),
    )


def area_index(areas: DataFrame) -> DataFrame:
    """0-based position of each distinct area code in code order (bounded by the code book)."""
    codes = areas.select("admdong_cd").distinct()
    position = F.row_number().over(Window.orderBy("admdong_cd")) - 1
    return codes.select("admdong_cd", position.alias("area_idx"))


def flag_mapped(od: DataFrame, index: DataFrame) -> DataFrame:
    """Movement with o_idx, d_idx and is_mapped (both ends are in the area index)."""
    known = small(index, ["admdong_cd", "area_idx"])
    both = od.join(known.toDF("o_admdong_cd", "o_idx"), "o_admdong_cd", "left").join(
        known.toDF("d_admdong_cd", "d_idx"), "d_admdong_cd", "left"
    )
    return both.withColumn("is_mapped", F.col("o_idx").isNotNull() & F.col("d_idx").isNotNull())


def unmapped_report(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.count("*").alias("n_rows"),
        F.count_if("is_mapped").alias("n_mapped"),
        F.count_if(~F.col("is_mapped")).alias("n_unmapped"),
    )


def dates_of(od: DataFrame, daytype: str, holidays="mobility") -> DataFrame:
    """Distinct dates of one day type that are present in the data."""
    require_choice(daytype, ("weekday", "weekend", "all"), "daytype")
    dates = od.select("date").distinct()
    if daytype == "all":
        return dates
    return dates.filter(calendar.week_part(F.col("date"), holidays) == daytype)


def day_count(od: DataFrame, daytype: str, holidays="mobility") -> DataFrame:
    """One row `n_days`: days present, not calendar days."""
    return dates_of(od, daytype, holidays).agg(F.count("*").alias("n_days"))


def daily_flow(
    od: DataFrame,
    daytype: str = "weekday",
    holidays="mobility",
    index: DataFrame | None = None,
    dated: DataFrame | None = None,
) -> DataFrame:
    """Mean daily flow pi per (origin, destination, 7 ages, hour), sparse.

    Cells without trips are implied zeros. With `index`, rows whose ends are not in the
    area index are dropped (see `flag_mapped` for the count). The days present are counted
    on `dated` where given: any table with the same dates that is cheaper to read. No such
    day at all is an error.
    """
    dated = od if dated is None else dated
    n_days = day_count(dated, daytype, holidays).scalar()
    kept = od.filter(F.col("age_10").isin(vocab.MOBILITY_AGES_RAW))
    if daytype != "all":
        kept = kept.filter(calendar.week_part(F.col("date"), holidays) == daytype)
    if index is not None:
        known = small(index, ["admdong_cd"])
        kept = kept.join(known.toDF("o_admdong_cd"), "o_admdong_cd", "left_semi")
        kept = kept.join(known.toDF("d_admdong_cd"), "d_admdong_cd", "left_semi")
    summed = kept.groupBy(
        "o_admdong_cd", "d_admdong_cd", top_code(F.col("age_10"), 70).alias("age_7"), "hour"
    ).agg(F.sum("total").alias("_sum"))
    pi = summed.select(
        "o_admdong_cd", "d_admdong_cd", "age_7", "hour", ratio(F.col("_sum"), n_days).alias("pi")
    )
    return fail_if_empty(pi, dates_of(dated, daytype, holidays), f"no {daytype} dates in the data")


def flow_marginals(pi: DataFrame) -> DataFrame:
    """Totals of pi by age, hour, origin and overall, in one pass."""
    sets = [["age_7"], ["hour"], ["o_admdong_cd"], []]
    cols = [F.col("age_7"), F.col("hour"), F.col("o_admdong_cd")]
    grouped = pi.groupingSets([[F.col(c) for c in s] for s in sets], *cols)
    level = (
        F.when(F.grouping("age_7") == 0, "age")
        .when(F.grouping("hour") == 0, "hour")
        .when(F.grouping("o_admdong_cd") == 0, "origin")
        .otherwise("total")
    )
    return grouped.agg(level.alias("margin"), F.sum("pi").alias("flow")).select(
        "margin", "age_7", "hour", "o_admdong_cd", "flow"
    )


def outflow_extremes(pi: DataFrame) -> DataFrame:
    """Mean and maximum of the areas' total outflow."""
    out = pi.groupBy("o_admdong_cd").agg(F.sum("pi").alias("flow"))
    return out.agg(F.avg("flow").alias("mean_outflow"), F.max("flow").alias("max_outflow"))


def dense_rows(pi: DataFrame, index: DataFrame, age_7: int, hour: int) -> DataFrame:
    """One (age, hour) slice of pi as dense rows: per origin an array over all destinations.

    The array is ordered by area index and zero-filled. It is as long as the code book.
    """
    codes = index.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("area_idx", "admdong_cd"))),
            lambda s: s.admdong_cd,
        )
    ).scalar()
    part = pi.filter((F.col("age_7") == age_7) & (F.col("hour") == hour))
    by_origin = part.groupBy("o_admdong_cd").agg(
        F.map_from_entries(F.collect_list(F.struct("d_admdong_cd", "pi"))).alias("_row")
    )
    zero = F.lit(0.0)
    joined = index.join(
        by_origin.withColumnRenamed("o_admdong_cd", "admdong_cd"), "admdong_cd", "left"
    ).withColumn("_codes", codes)
    return joined.select(
        F.col("admdong_cd").alias("o_admdong_cd"),
        "area_idx",
        F.transform(
            "_codes", lambda c: F.coalesce(F.try_element_at(F.col("_row"), c), zero)
        ).alias("flow"),
    )


def dense_cells(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Long form of `dense_rows`: (origin, destination, pi) with zeros included."""
    long = rows.select("o_admdong_cd", F.posexplode("flow").alias("area_idx", "pi"))
    names = index.select("area_idx", F.col("admdong_cd").alias("d_admdong_cd"))
    return long.join(names, "area_idx").select("o_admdong_cd", "d_admdong_cd", "pi")


def totals_by(od: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Trip totals by each dimension separately (grouping sets, one pass), long form."""
    cols = [F.col(d) for d in dims]
    grouped = od.groupingSets([[c] for c in cols], *cols)
    names = F.coalesce(*[F.when(F.grouping(d) == 0, F.lit(d)) for d in dims])
    keys = F.coalesce(*[F.when(F.grouping(d) == 0, F.col(d).cast("string")) for d in dims])
    agg = grouped.agg(
        names.alias("dimension"), keys.alias("key"), F.sum("total").alias("total")
    )
    return agg.select("dimension", "key", "total")


def pair_totals(od: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return od.groupBy(*extra, "o_admdong_cd", "d_admdong_cd").agg(F.sum("total").alias("total"))


def top_pairs(od: DataFrame, same_area: bool, k: int = 20) -> DataFrame:
    test = F.col("o_admdong_cd") == F.col("d_admdong_cd")
    pairs = pair_totals(od.filter(test if same_area else ~test))
    return pairs.orderBy(F.desc("total"), "o_admdong_cd", "d_admdong_cd").limit(k)


def net_flow(od: DataFrame) -> DataFrame:
    """Inflow, outflow and net flow per area from trips that cross areas.

    Each trip is emitted once for either end and summed by area: one shuffle, combined
    on the map side, instead of two aggregations and a full join.
    """
    cross = od.filter(F.col("o_admdong_cd") != F.col("d_admdong_cd"))
    zero = F.lit(0.0)
    ends = F.array(
        F.struct(F.col("d_admdong_cd").alias("cd"), F.col("total").alias("i"), zero.alias("o")),
        F.struct(F.col("o_admdong_cd").alias("cd"), zero.alias("i"), F.col("total").alias("o")),
    )
    by_area = (
        cross.select(F.inline(ends))
        .groupBy(F.col("cd").alias("admdong_cd"))
        .agg(F.sum("i").alias("inflow"), F.sum("o").alias("outflow"))
    )
    return by_area.withColumn("net", F.col("inflow") - F.col("outflow"))


def inflow_outflow_join(od: DataFrame) -> DataFrame:
    """The same as two area tables met by a full outer join with zero fill."""
    cross = od.filter(F.col("o_admdong_cd") != F.col("d_admdong_cd"))
    inflow = cross.groupBy(F.col("d_admdong_cd").alias("admdong_cd")).agg(
        F.sum("total").alias("inflow")
    )
    outflow = cross.groupBy(F.col("o_admdong_cd").alias("admdong_cd")).agg(
        F.sum("total").alias("outflow")
    )
    zero = F.lit(0.0)
    return inflow.join(outflow, "admdong_cd", "full").select(
        "admdong_cd",
        F.coalesce("inflow", zero).alias("inflow"),
        F.coalesce("outflow", zero).alias("outflow"),
    )


def top_and_bottom_net(flow: DataFrame, k: int = 20) -> DataFrame:
    """The k areas of largest and of smallest net flow, each trimmed by its own top-k."""
    hubs = flow.orderBy(F.desc("net"), "admdong_cd").limit(k)
    homes = flow.orderBy("net", "admdong_cd").limit(k)
    return hubs.withColumn("side", F.lit("activity")).unionByName(
        homes.withColumn("side", F.lit("residential"))
    )


def mean_distance_by(od: DataFrame, *keys: Column | str) -> DataFrame:
    """Trip-weighted mean distance per key over rows with a positive distance."""
    return (
        od.filter(F.col("avg_dist") > 0)
        .groupBy(*keys)
        .agg(
            F.sum(F.col("avg_dist") * F.col("total")).alias("num"),
            F.sum("total").alias("den"),
        )
        .withColumn("w_avg_dist", ratio(F.col("num"), F.col("den")))
    )


def destinations_per_origin(od: DataFrame, *keys: str) -> DataFrame:
    return od.groupBy(*keys, "o_admdong_cd").agg(
        F.count_distinct("d_admdong_cd").alias("n_destinations"),
        F.sum("total").alias("total_trips"),
    )


def weekday_trips_by_age(
    od: DataFrame, holidays="mobility", dated: DataFrame | None = None
) -> DataFrame:
    """Per age on weekdays: mean trips per day, trips and rows (`dated` as in `daily_flow`)."""
    n_days = day_count(od if dated is None else dated, "weekday", holidays).scalar()
    kept = od.filter(calendar.week_part(F.col("date"), holidays) == "weekday")
    return (
        kept.groupBy("age_10")
        .agg(F.sum("total").alias("total_trips"), F.count("*").alias("n_records"))
        .select(
            "age_10",
            ratio(F.col("total_trips"), n_days).alias("daily_avg_trips"),
            "total_trips",
            "n_records",
        )
    )


def same_area_share(od: DataFrame, *keys: str) -> DataFrame:
    """Share in percent of trips that stay in their area."""
    same = F.sum(F.when(F.col("o_admdong_cd") == F.col("d_admdong_cd"), F.col("total")))
    return od.groupBy(*keys).agg(
        (ratio(F.coalesce(same, F.lit(0.0)), F.sum("total")) * 100).alias("same_pct")
    )
