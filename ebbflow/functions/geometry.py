"""Planar geometry on vertex arrays (`array<struct<x,y>>`, open ring), without UDFs.

A shape of several parts or with holes is `array<struct<hole: boolean, ring: array<struct<x,y>>>>`.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def edges(ring: Column) -> Column:
    """The ring's edges x1, y1, x2, y2, the closing one included."""
    return F.zip_with(
        ring,
        F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)),
        lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")),
    )


def _over_edges(ring: Column, start: Column, step) -> Column:
    """Fold `step(total, x1, y1, x2, y2)` over the ring's edges."""
    return F.aggregate(edges(ring), start, lambda t, e: step(t, e.x1, e.y1, e.x2, e.y2))


def signed_area(ring: Column) -> Column:
    total = _over_edges(
        ring, F.lit(0.0), lambda t, x1, y1, x2, y2: t + (x1 * y2 - x2 * y1)
    )
    return total / 2


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def centroid(ring: Column) -> tuple[Column, Column]:
    def moment(axis):
        def step(t, x1, y1, x2, y2):
            pair = x1 + x2 if axis == "x" else y1 + y2
            return t + pair * (x1 * y2 - x2 * y1)

        return F.try_divide(_over_edges(ring, F.lit(0.0), step), signed_area(ring) * 6)

    return moment("x"), moment("y")


def contains(ring: Column, px: Column, py: Column) -> Column:
    """Even-odd rule; half-open in y, so a point on a shared edge has one owner."""

    def step(inside, x1, y1, x2, y2):
        spans = (y1 > py) != (y2 > py)
        at = x1 + F.try_divide((py - y1) * (x2 - x1), y2 - y1)
        return inside != (spans & (px < at))

    # `px < at` is null on a horizontal edge, where `spans` is false, so the AND is false.
    return _over_edges(ring, F.lit(False), step)


def inside_edges(edges: Column, px: Column, py: Column) -> Column:
    """Even-odd rule over an array of edges, as `contains` has it for a ring."""

    def step(inside, e):
        spans = (e.y1 > py) != (e.y2 > py)
        at = e.x1 + F.try_divide((py - e.y1) * (e.x2 - e.x1), e.y2 - e.y1)
        return inside != (spans & (px < at))

    return F.aggregate(edges, F.lit(False), step)


def inside_from(edges: Column, known: Column, x0: Column, y0: Column, px: Column, py: Column) -> Column:
    """Is a point inside, when it is known whether (x0, y0) is? The edges that the way between the
    two meets are counted, first upright at x0, then level at py: so only edges that touch the box
    of the two points matter. Like `contains`, which takes a point to lie a little to the right
    of itself and, by far less, above: so a point on a rising edge is below it on the upright leg.
    """

    def step(met, e):
        over = (e.x1 > x0) != (e.x2 > x0)
        height = e.y1 + F.try_divide((x0 - e.x1) * (e.y2 - e.y1), e.x2 - e.x1)
        rises = (e.y1 != e.y2) & ((e.y2 > e.y1) == (e.x2 > e.x1))
        below = lambda y: F.when((y < height) | ((y == height) & rises), 1).otherwise(0)
        spans = (e.y1 > py) != (e.y2 > py)
        at = e.x1 + F.try_divide((py - e.y1) * (e.x2 - e.x1), e.y2 - e.y1)
        left = lambda x: F.when(x < at, 1).otherwise(0)
        upright = F.when(over, below(y0) + below(py)).otherwise(0)
        return met + upright + F.when(spans, left(x0) + left(px)).otherwise(0)

    return known != (F.aggregate(edges, F.lit(0), step) % 2 == 1)


def shape_area(shape: Column) -> Column:
    """Area of all parts less the holes."""
    return F.aggregate(
        shape, F.lit(0.0), lambda total, part: total + F.when(part.hole, -area(part.ring)).otherwise(area(part.ring))
    )


def shape_centroid(shape: Column) -> tuple[Column, Column]:
    """Centroid of the parts, weighted by their areas, holes taken out."""

    def along(axis: int) -> Column:
        def step(total, part):
            moment = centroid(part.ring)[axis] * area(part.ring)
            return total + F.when(part.hole, -moment).otherwise(moment)

        return F.try_divide(F.aggregate(shape, F.lit(0.0), step), shape_area(shape))

    return along(0), along(1)


def shape_contains(shape: Column, px: Column, py: Column) -> Column:
    """Even-odd rule over all rings: inside a part and not in one of its holes."""
    return F.aggregate(shape, F.lit(False), lambda inside, part: inside != contains(part.ring, px, py))
