"""Polygons, centroids, distances, densities and point-in-polygon assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow import vocab
from ebbflow.functions import geometry
from ebbflow.functions.columns import distance_band, ratio, speed_kmh, straight_distance
from ebbflow.joins import same_rows, small
from ebbflow.operators import stats
from ebbflow.session import settled

# Cover cells carry edges, 32 bytes each: both bounds must hold for a broadcast.
MAX_COVER_CELLS = 50_000
MAX_COVER_EDGES = 1_000_000
# A cell with no more edges is not split further; a split makes SPLIT x SPLIT cells.
FEW_EDGES = 32
SPLIT = 4


def measure(polygons: DataFrame, key: str) -> DataFrame:
    """Area in square kilometres and centroid of each polygon.

    Polygons have a column `vertices` (one open ring) or `shape` (parts and holes).
    """
    if "shape" in polygons.columns:
        area = geometry.shape_area(F.col("shape"))
        cx, cy = geometry.shape_centroid(F.col("shape"))
    else:
        area = geometry.area(F.col("vertices"))
        cx, cy = geometry.centroid(F.col("vertices"))
    measured = polygons.select(
        key,
        (area / 1_000_000).alias("area_km2"),
        cx.alias("ctr_x"),
        cy.alias("ctr_y"),
    )
    return same_rows(measured, polygons)


def first_per_key(df: DataFrame, key: str, order: list) -> DataFrame:
    """One row per key, the first in a stated order (no arbitrary pick).

    Done as a minimum of a struct, so copies are combined before the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    ranked = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(ranked.alias("_r")).select(key, "_r.*")


def with_straight_distance(od: DataFrame, centroids: DataFrame, minimum: float = 100) -> DataFrame:
    """Crossing trips with the centroid distance and the ratio of the reported one to it.

    Pairs of areas closer than `minimum` metres are left out.
    """
    points = small(centroids, ["admdong_cd", "ctr_x", "ctr_y"])
    trips = od.filter((F.col("o_admdong_cd") != F.col("d_admdong_cd")) & (F.col("avg_dist") > 0))
    placed = trips.join(points.toDF("o_admdong_cd", "o_x", "o_y"), "o_admdong_cd").join(
        points.toDF("d_admdong_cd", "d_x", "d_y"), "d_admdong_cd"
    )
    straight = straight_distance(F.col("o_x"), F.col("o_y"), F.col("d_x"), F.col("d_y"))
    return (
        placed.withColumn("straight_dist_m", straight)
        .drop("o_x", "o_y", "d_x", "d_y")
        .filter(F.col("straight_dist_m") > minimum)
        .withColumn("ratio", ratio(F.col("avg_dist"), F.col("straight_dist_m")))
    )


def band_consistency(trips: DataFrame, settle: bool = True) -> DataFrame:
    """Per distance band: quartiles of the ratio, medians of both distances and rows.

    `settle=False` for trips that are a stored table (`stats.exact_quantiles`).
    """
    band = distance_band(F.col("straight_dist_m"))
    measures = {m: F.col(m) for m in ("ratio", "avg_dist", "straight_dist_m")}
    q = stats.measured_quantiles(
        trips.withColumn("dist_bin", band), ["dist_bin"], measures, [0.25, 0.5, 0.75],
        max_groups=len(vocab.DISTANCE_BANDS), settle=settle,
    )
    of = lambda measure, column: F.max(F.when(F.col("measure") == measure, F.col(column)))
    return q.groupBy("dist_bin").agg(
        of("ratio", "p25").alias("ratio_p25"),
        of("ratio", "p50").alias("ratio_p50"),
        of("ratio", "p75").alias("ratio_p75"),
        of("avg_dist", "p50").alias("avg_dist_p50"),
        of("straight_dist_m", "p50").alias("straight_p50"),
        of("ratio", "n").alias("count"),
    )


def band_verdict(bands: DataFrame, limit: float = 0.30) -> DataFrame:
    """Coefficient of variation of the band medians and whether it is below the limit."""
    cv = ratio(F.stddev("ratio_p50"), F.avg("ratio_p50"))
    return bands.agg(cv.alias("ratio_cv")).withColumn("consistent", F.col("ratio_cv") < limit)


def speed_table(trips: DataFrame, min_straight: float = 500, settle: bool = True) -> DataFrame:
    """Quartiles of the speed under each unit hypothesis; plausible if the median is 10-50."""
    kept = trips.filter((F.col("avg_time") > 0) & (F.col("straight_dist_m") > min_straight))
    kept = kept.select("avg_dist", "avg_time")
    if settle:
        kept = settled(kept)
    speeds = {h: speed_kmh(F.col("avg_dist"), F.col("avg_time"), h) for h in vocab.SPEED_HYPOTHESES}
    measures = {h: F.when((v > 0) & (v < 1000), v) for h, v in speeds.items()}
    q = stats.measured_quantiles(kept, [], measures, [0.25, 0.5, 0.75], max_groups=1, settle=False)
    return q.select(
        F.col("measure").alias("hypothesis"), "p25", "p50", "p75", F.col("p50").between(10, 50).alias("plausible")
    )


def unit_medians(od: DataFrame, centroids: DataFrame, minimum: float = 100, settle: bool = True) -> DataFrame:
    """The facts of `unit_verdicts` in one run over the trips: the median distance within areas
    (same_p50), the median ratio of crossing trips (ratio_p50) and the coefficient of variation of
    its medians by distance band (ratio_cv)."""
    points = small(centroids, ["admdong_cd", "ctr_x", "ctr_y"])
    placed = (
        od.filter(F.col("avg_dist") > 0)
        .join(points.toDF("o_admdong_cd", "o_x", "o_y"), "o_admdong_cd", "left")
        .join(points.toDF("d_admdong_cd", "d_x", "d_y"), "d_admdong_cd", "left")
    )
    same = F.col("o_admdong_cd") == F.col("d_admdong_cd")
    straight = straight_distance(F.col("o_x"), F.col("o_y"), F.col("d_x"), F.col("d_y"))
    trips = placed.select(
        "avg_dist", same.alias("same"), F.when(~same & (straight > minimum), straight).alias("straight")
    ).filter(F.col("same") | F.col("straight").isNotNull())
    if settle:
        trips = settled(trips)
    quotient = ratio(F.col("avg_dist"), F.col("straight"))
    band = distance_band(F.col("straight"))
    bands = {label: F.when(band == label, quotient) for _, label in vocab.DISTANCE_BANDS}
    measures = {"same": F.when(F.col("same"), F.col("avg_dist")), "ratio": quotient, **bands}
    q = stats.measured_quantiles(trips, [], measures, [0.5], max_groups=1, settle=False)
    of_band = F.when(F.col("measure").isin(list(bands)), F.col("p50"))
    return q.agg(
        F.max(F.when(F.col("measure") == "same", F.col("p50"))).alias("same_p50"),
        F.max(F.when(F.col("measure") == "ratio", F.col("p50"))).alias("ratio_p50"),
        ratio(F.stddev(of_band), F.avg(of_band)).alias("ratio_cv"),
    )


def unit_verdicts(facts: DataFrame) -> DataFrame:
    """What the same-area median, the ratio median and the bands say about the distance unit."""
    same = F.col("same_p50")
    return facts.select(
        "same_p50",
        "ratio_p50",
        "ratio_cv",
        F.when(same.between(100, 2000), "m").when(same.between(1, 20), "100m").otherwise("other").alias(
            "same_verdict"
        ),
        F.when(F.col("ratio_p50").between(0.8, 2.5), "m")
        .when(F.col("ratio_p50").between(0.005, 0.025), "100m")
        .otherwise("other")
        .alias("ratio_verdict"),
        F.when(F.col("ratio_cv") < 0.30, "consistent").otherwise("not consistent").alias("band_verdict"),
    )


def density(hourly: DataFrame, measured: DataFrame) -> DataFrame:
    """People per square kilometre."""
    return hourly.join(small(measured, ["admdong_cd", "area_km2"]), "admdong_cd").withColumn(
        "density", ratio(F.col("pop_avg"), F.col("area_km2"))
    )


def bounding_box(points: DataFrame, x: str, y: str) -> DataFrame:
    """Extent, rows and a guess of the projected reference system from the lower corner."""
    box = points.agg(
        F.min(x).alias("x_min"), F.max(x).alias("x_max"),
        F.min(y).alias("y_min"), F.max(y).alias("y_max"), F.count("*").alias("n_rows"),
    )
    lower = lambda xs, ys: F.col("x_min").between(*xs) & F.col("y_min").between(*ys)
    guess = (
        F.when(lower((700_000, 1_200_000), (1_500_000, 2_100_000)), "EPSG:5179")
        .when(lower((100_000, 300_000), (400_000, 700_000)), "EPSG:5186")
        .otherwise("unknown")
    )
    return box.withColumn("crs_guess", guess)


def region_report(polygons: DataFrame) -> DataFrame:
    """Polygons per region and geometry type, and whether all share one reference system."""
    n_crs = polygons.agg(F.count_distinct("crs")).scalar()
    counts = polygons.groupBy("region", "geom_type").agg(F.count("*").alias("n_polygons"))
    return counts.withColumn("crs_agrees", n_crs == 1)


def cover(polygons: DataFrame, key: str, tile: float, few: int = FEW_EDGES) -> DataFrame:
    """Square cells that cover each polygon: key, level, cx, cy, inside, edges.

    A cell of level n has a side of tile * 4^n and is the one numbered cx, cy of its level. It
    starts as the smallest that spans the polygon (or its neighbours on the grid) and is split
    while more than `few` edges come near it, down to `tile`. Edges go only to the cells whose box
    they meet. A cell that no edge meets lies wholly inside, and carries none, or is dropped. So
    the number of cells follows the number of edges, not the area. `inside` is true if the cell's
    lower left corner is. The cells are stored in the shared folder. Polygons have `vertices` (one open ring) or `shape` (parts and holes).
    """
    if "shape" in polygons.columns:
        every = F.flatten(F.transform("shape", lambda part: geometry.edges(part.ring)))
    else:
        every = geometry.edges(F.col("vertices"))
    low = lambda *of: F.array_min(F.flatten(F.transform("edges", lambda e: F.array(*[e[c] for c in of]))))
    high = lambda *of: F.array_max(F.flatten(F.transform("edges", lambda e: F.array(*[e[c] for c in of]))))
    boxes = polygons.select(key, every.alias("edges")).filter(F.size("edges") > 0).select(
        key,
        "edges",
        low("x1").alias("x0"),
        high("x1").alias("x1"),
        low("y1").alias("y0"),
        high("y1").alias("y1"),
    )
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(float(tile)))
    level = F.ceil(F.log(extent / tile) / F.log(F.lit(float(SPLIT)))).cast("int")
    side = _side(F.col("level"), tile)
    span = lambda c: F.sequence(F.floor(F.col(f"{c}0") / side), F.floor(F.col(f"{c}1") / side))
    roots = (
        boxes.withColumn("level", level)
        .withColumn("cx", F.explode(span("x")))
        .withColumn("cy", F.explode(span("y")))
    )
    corner = geometry.inside_edges(F.col("edges"), F.col("cx") * side, F.col("cy") * side)
    cells = settled(_near(roots.select(key, "level", "cx", "cy", corner.alias("inside"), "edges"), tile))
    open_ = (F.size("edges") > few) & (F.col("level") > 0)
    done, left = cells.filter(~open_), cells.filter(open_)
    while not left.isEmpty():  # a round for each level at most
        cells = settled(_near(_split(left, key, tile), tile))
        done, left = done.unionByName(cells.filter(~open_)), cells.filter(open_)
    return done.filter(F.col("inside") | (F.size("edges") > 0))


def _side(level, tile: float):
    return F.pow(F.lit(float(SPLIT)), level) * tile


def _near(cells: DataFrame, tile: float) -> DataFrame:
    """The cells with only those of their edges whose box meets theirs."""
    side = _side(F.col("level"), tile)
    x0, y0 = F.col("cx") * side, F.col("cy") * side
    boxed = cells.withColumn("_b", F.struct(x0.alias("x0"), y0.alias("y0"), (x0 + side).alias("x1"), (y0 + side).alias("y1")))
    meets = lambda e: (
        (F.least(e.x1, e.x2) <= F.col("_b.x1"))
        & (F.greatest(e.x1, e.x2) >= F.col("_b.x0"))
        & (F.least(e.y1, e.y2) <= F.col("_b.y1"))
        & (F.greatest(e.y1, e.y2) >= F.col("_b.y0"))
    )
    return boxed.withColumn("edges", F.filter("edges", meets)).drop("_b")


def _split(cells: DataFrame, key: str, tile: float) -> DataFrame:
    """The cells of the next lower level, each with the edges of the one it is part of."""
    numbers = F.array(*[F.lit(n) for n in range(SPLIT)])
    parts = cells.withColumn("_i", F.explode(numbers)).withColumn("_j", F.explode(numbers))
    side = _side(F.col("level"), tile)
    x0, y0, step = F.col("cx") * side, F.col("cy") * side, side / SPLIT
    inside = geometry.inside_from(
        F.col("edges"), F.col("inside"), x0, y0, x0 + F.col("_i") * step, y0 + F.col("_j") * step
    )
    # Apart from the new cx and cy: a lambda would take these for the ones it names.
    return parts.withColumn("_inside", inside).select(
        key,
        (F.col("level") - 1).alias("level"),
        (F.col("cx") * SPLIT + F.col("_i")).alias("cx"),
        (F.col("cy") * SPLIT + F.col("_j")).alias("cy"),
        F.col("_inside").alias("inside"),
        "edges",
    )


def assign_points(
    points: DataFrame, polygons: DataFrame, key: str, tile: float, x: str = "x", y: str = "y"
) -> DataFrame:
    """Points with the key of the polygon that contains them (inner).

    Points meet the cells of each polygon's `cover` by equi-join: in a cell wholly inside nothing
    is tested, in another the few edges near it decide. A cover of few cells with few edges is
    broadcast after a count, so no point is shuffled. With many, a crowded cell is one skewed
    join partition, which adaptive execution splits. `tile` is the side of the smallest cells.
    """
    cells = cover(polygons, key, tile).select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in ("level", "cx", "cy", "inside", "edges")]
    )
    facts = cells.agg(
        F.count("*").alias("n"), F.sum(F.size("_edges")).alias("edges"), F.collect_set("_level").alias("levels")
    ).first()  # a level for each power of four of the extent
    if facts.n <= MAX_COVER_CELLS and (facts.edges or 0) <= MAX_COVER_EDGES:
        cells = F.broadcast(cells)
    levels = F.array(*[F.lit(n) for n in sorted(facts.levels)]).cast("array<int>")
    placed = points.withColumn("_level", F.explode(levels))
    side = _side(F.col("_level"), tile)
    at = lambda c: F.floor(F.col(c) / side)
    placed = placed.withColumns({"_cx": at(x), "_cy": at(y)})
    met = placed.join(cells, ["_level", "_cx", "_cy"])
    decided = geometry.inside_from(
        F.col("_edges"), F.col("_inside"), F.col("_cx") * side, F.col("_cy") * side, F.col(x), F.col(y)
    )
    found = met.filter(F.when(F.size("_edges") == 0, F.lit(True)).otherwise(decided))
    return found.select(*points.columns, F.col("_key").alias(key))
