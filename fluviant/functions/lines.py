"""Line geometry as column expressions: no row leaves the JVM.

A line is an array of parts, a part an array of ``{x, y}`` points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def edges_of(line: Column) -> Column:
    """All edges of all parts as ``{ax, ay, bx, by}``."""

    def of_part(part: Column) -> Column:
        starts = F.slice(part, F.lit(1), F.greatest(F.size(part) - 1, F.lit(0)))
        return F.transform(starts, lambda a, i: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), F.element_at(part, i + 2)["x"].alias("bx"), F.element_at(part, i + 2)["y"].alias("by")))

    return F.flatten(F.transform(line, of_part))


def _sum(edges: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda s, e: s + value(e))


def _length(e: Column) -> Column:
    return F.sqrt(F.pow(e["bx"] - e["ax"], 2) + F.pow(e["by"] - e["ay"], 2))


def line_centroid(line: Column) -> Column:
    """Midpoints of the edges weighted by their length; of a line without length, its first point."""
    edges = edges_of(line)
    total = _sum(edges, _length)
    x = _sum(edges, lambda e: _length(e) * (e["ax"] + e["bx"]) / 2) / total
    y = _sum(edges, lambda e: _length(e) * (e["ay"] + e["by"]) / 2) / total
    first = F.element_at(F.element_at(line, 1), 1)
    return F.when(total > 0, point(x, y)).otherwise(point(first["x"], first["y"]))


def distance(line: Column, p: Column) -> Column:
    """Planar distance from a point to the nearest place of a line, in the units of the coordinates."""

    def to_edge(e: Column) -> Column:
        dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
        square = dx * dx + dy * dy
        along = F.when(square > 0, ((p["x"] - e["ax"]) * dx + (p["y"] - e["ay"]) * dy) / square).otherwise(0.0)
        t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
        return F.sqrt(F.pow(p["x"] - (e["ax"] + t * dx), 2) + F.pow(p["y"] - (e["ay"] + t * dy), 2))

    return F.array_min(F.transform(edges_of(line), to_edge))


def box(x: Column, y: Column, radius: float) -> Column:
    """A square polygon around a point, as one ring."""
    r = F.lit(radius)
    corners = [(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r), (x - r, y - r)]
    return F.array(F.array(*[point(a, b) for a, b in corners]))


def ring_area(ring: Column) -> Column:
    """Signed shoelace area of a closed ring, taken from its first point for precision."""
    edges = edges_of(F.array(ring))
    o = F.element_at(ring, 1)
    return _sum(edges, lambda e: (e["ax"] - o["x"]) * (e["by"] - o["y"]) - (e["bx"] - o["x"]) * (e["ay"] - o["y"])) / 2


def polygon_area(polygon: Column) -> Column:
    """Area of the first ring less the areas of the others (holes)."""
    areas = F.transform(polygon, lambda ring: F.abs(ring_area(ring)))
    return let(areas, lambda a: 2 * F.get(a, F.lit(0)) - F.aggregate(a, F.lit(0.0), lambda s, v: s + v))


def _half(ring: Column, own: str, other: str, limit: Column, above: bool) -> Column:
    """A closed ring cut by one line: what lies on its upper or lower side."""

    def pieces(e: Column) -> Column:
        a, b = e[f"a{own}"], e[f"b{own}"]
        in_a, in_b = (a >= limit, b >= limit) if above else (a <= limit, b <= limit)
        across = e[f"a{other}"] + (limit - a) / (b - a) * (e[f"b{other}"] - e[f"a{other}"])
        cut = point(limit, across) if own == "x" else point(across, limit)
        none = F.array().cast("array<struct<x:double,y:double>>")
        return F.concat(F.when(in_a, F.array(point(e["ax"], e["ay"]))).otherwise(none), F.when(in_a != in_b, F.array(cut)).otherwise(none))

    return let(F.flatten(F.transform(edges_of(F.array(ring)), pieces)), lambda p: F.concat(p, F.slice(p, 1, 1)))


def clip_ring(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A closed ring cut by a rectangle, one half-plane after the other; empty if outside.

    Where a concave ring falls apart the pieces stay joined along the border of the
    rectangle, by bridges without area."""
    ring = _half(_half(ring, "x", "y", x0, True), "x", "y", x1, False)
    return _half(_half(ring, "y", "x", y0, True), "y", "x", y1, False)


def clip_polygon(polygon: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The rings of a polygon cut by a rectangle; rings outside are left out."""
    return F.filter(F.transform(polygon, lambda ring: clip_ring(ring, x0, y0, x1, y1)), lambda ring: F.size(ring) > 0)


def polygon_centroid(polygon: Column) -> Column:
    """Area centroid of the outer ring."""
    edges = edges_of(F.slice(polygon, 1, 1))
    twice = _sum(edges, lambda e: e["ax"] * e["by"] - e["bx"] * e["ay"])
    x = _sum(edges, lambda e: (e["ax"] + e["bx"]) * (e["ax"] * e["by"] - e["bx"] * e["ay"])) / (3 * twice)
    y = _sum(edges, lambda e: (e["ay"] + e["by"]) * (e["ax"] * e["by"] - e["bx"] * e["ay"])) / (3 * twice)
    return point(x, y)


def map_points(geometry: Column, x: Callable[[Column], Column], y: Callable[[Column], Column]) -> Column:
    """The geometry with each point's coordinates replaced."""
    return F.transform(geometry, lambda part: F.transform(part, lambda p: point(x(p), y(p))))


def bounds(geometry: Column) -> Column:
    """``{x0, y0, x1, y1}`` of all points."""
    points = F.flatten(geometry)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))
