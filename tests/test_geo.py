import functools
import math

import pytest
from support import rows
from pyspark.sql import functions as F

from ebbflow.operators import geo
from ebbflow.session import settled

RING = "zone string, vertices array<struct<x:double,y:double>>"
L = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]


def ring(points):
    return [(float(x), float(y)) for x, y in points]


def test_area_and_centroid(spark):
    df = spark.createDataFrame([("l", ring(L)), ("r", ring(L[::-1]))], RING)
    for r in geo.measure(df, "zone").collect():
        assert math.isclose(r.area_km2 * 1e6, 12.0)
        assert math.isclose(r.ctr_x, 5 / 3) and math.isclose(r.ctr_y, 5 / 3)


def inside(points, x, y):
    hit, n = False, len(points)
    for i in range(n):
        (x1, y1), (x2, y2) = points[i], points[(i + 1) % n]
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            hit = not hit
    return hit


@pytest.mark.parametrize("tile", [0.7, 3.0, 50.0])
def test_assignment_equals_brute_force(spark, tile):
    shapes = {"l": L, "t": [(2, 2), (6, 3), (3, 7)], "far": [(-9, -9), (-5, -9), (-7, -4)]}
    polygons = spark.createDataFrame([(k, ring(v)) for k, v in shapes.items()], RING)
    points = [(i, -10 + (i * 37 % 200) / 10 + 0.01, -10 + (i * 91 % 200) / 10 + 0.03) for i in range(400)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    want = sorted((i, x, y, k) for i, x, y in points for k, v in shapes.items() if inside(v, x, y))
    assert sorted(tuple(r) for r in geo.assign_points(df, polygons, "zone", tile).collect()) == want and want


def test_shared_edge_has_one_owner(spark):
    squares = [("a", ring([(0, 0), (1, 0), (1, 1), (0, 1)])), ("b", ring([(1, 0), (2, 0), (2, 1), (1, 1)]))]
    points = spark.createDataFrame([(1, 1.0, 0.5)], "id int, x double, y double")
    assert geo.assign_points(points, spark.createDataFrame(squares, RING), "zone", 1).count() == 1


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 9), ("b", 5, 5)], "k string, o int, v int")
    assert rows(geo.first_per_key(df, "k", ["o"])) == [("a", 1, 9), ("b", 5, 5)]


def test_crs_guess(spark):
    for x, y, name in ((900_000, 1_900_000, "EPSG:5179"), (200_000, 500_000, "EPSG:5186"), (1, 1, "unknown")):
        df = spark.createDataFrame([(float(x), float(y))], "x double, y double")
        assert geo.bounding_box(df, "x", "y").first().crs_guess == name


def test_short_distances_are_left_out(spark):
    od = spark.createDataFrame([("a", "b", 90.0), ("a", "c", 150.0), ("a", "a", 5.0)], "o_admdong_cd string, d_admdong_cd string, avg_dist double")
    pts = spark.createDataFrame([("a", 0.0, 0.0), ("b", 60.0, 0.0), ("c", 90.0, 120.0)], "admdong_cd string, ctr_x double, ctr_y double")
    assert rows(geo.with_straight_distance(od, pts).select("d_admdong_cd", "straight_dist_m", "ratio")) == [("c", 150.0, 1.0)]


def test_region_report_sees_mixed_systems(spark):
    df = spark.createDataFrame([("r", "Polygon", "5179"), ("s", "Polygon", "4326")], "region string, geom_type string, crs string")
    assert geo.region_report(df).filter(F.col("crs_agrees")).count() == 0


SHAPE = "zone string, shape array<struct<hole:boolean, ring:array<struct<x:double,y:double>>>>"


def box(x, y, side):
    return ring([(x, y), (x + side, y), (x + side, y + side), (x, y + side)])


def test_holes_and_islands(spark):
    parts = [(False, box(0, 0, 10)), (True, box(2, 2, 4)[::-1]), (False, box(20, 0, 2))]
    df = spark.createDataFrame([("z", parts), ("hole", [(False, box(2, 2, 4))])], SHAPE)
    got = {r.zone: r for r in geo.measure(df, "zone").collect()}
    assert math.isclose(got["z"].area_km2 * 1e6, 100 - 16 + 4)
    assert math.isclose(got["z"].ctr_x, (100 * 5 - 16 * 4 + 4 * 21) / 88)
    assert math.isclose(got["z"].ctr_y, (100 * 5 - 16 * 4 + 4 * 1) / 88)
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 21.0, 1.0), (4, 15.0, 1.0)], "id int, x double, y double")
    for tile in (1.5, 40.0):
        found = geo.assign_points(points, df, "zone", tile).select("id", "zone").collect()
        assert sorted(map(tuple, found)) == [(1, "z"), (2, "hole"), (3, "z")]


def test_a_large_polygon_takes_small_tiles(spark):
    df = spark.createDataFrame([("z", box(0, 0, 1e7))], RING)
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5e6, 9.9e6), (3, -1.0, 5.0)], "id int, x double, y double")
    assert geo.cover(df, "zone", 1.0).count() <= 4
    assert sorted(r.id for r in geo.assign_points(points, df, "zone", 1.0).collect()) == [1, 2]


def test_cells_inside_need_no_edges(spark):
    """A coast of 100,000 vertices: few edges near any cell, and none within."""
    n = 100_000
    radius = lambda k: 1000 + 3 * math.sin(k * 0.037) + 0.05 * math.sin(k * 1.7)
    coast = [(radius(k) * math.cos(2 * math.pi * k / n), radius(k) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    df = spark.createDataFrame([("z", ring(coast))], RING)
    cells = settled(geo.cover(df, "zone", 2.0)).selectExpr("size(edges) AS n", "inside", "level").collect()
    assert len(cells) < n / 4 and sum(c.n for c in cells) < 4 * n
    whole = [c for c in cells if not c.n]
    assert whole and all(c.inside for c in whole) and max(c.level for c in whole) > min(c.level for c in cells)
    spots = [(i, (i * 37 % 211 - 105) * 10.03, (i * 91 % 223 - 111) * 9.71) for i in range(60)]
    spots += [(100 + i, 1010 * math.cos(i), 1010 * math.sin(i)) for i in range(20)]
    points = spark.createDataFrame(spots, "id int, x double, y double")
    got = sorted(r.id for r in geo.assign_points(points, df, "zone", 2.0).collect())
    assert got == [i for i, x, y in spots if inside(coast, x, y)] and len(got) > 20


@pytest.mark.parametrize("few", [1, 3])
def test_split_cells_agree_with_the_whole_ring(spark, few, monkeypatch):
    """Vertices and points on the lines of the grid, a hole, and cells split to the end."""
    monkeypatch.setattr(geo, "cover", functools.partial(geo.cover, few=few))
    star = [(0, 0), (8, 0), (8, 2), (4, 4), (8, 6), (8, 8), (5, 8), (4, 5), (3, 8), (0, 8), (2, 4)]
    hole = [(4, 1), (6, 1), (5, 2)]
    df = spark.createDataFrame([("s", [(False, ring(star)), (True, ring(hole))])], SHAPE)
    spots = [(i, (i % 41) / 4 - 1, (i // 41) / 4 - 1) for i in range(41 * 41)]
    points = spark.createDataFrame(spots, "id int, x double, y double").repartition(3)
    got = sorted(r.id for r in geo.assign_points(points, df, "zone", 0.5).collect())
    assert got == [i for i, x, y in spots if inside(star, x, y) != inside(hole, x, y)]


def test_no_polygons(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id int, x double, y double")
    assert geo.assign_points(points, spark.createDataFrame([], RING), "zone", 1.0).count() == 0
