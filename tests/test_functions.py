"""Geometry, geodesy and routing expressions against closed forms."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluviant.functions import geodesy, lines, routing
from fluviant.functions.simplify import douglas_peucker
from fluviant.schema import GEOMETRY
from fluviant.sources import header_numbers


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def line(*parts):
    return F.array(*[F.array(*[lines.point(F.lit(x), F.lit(y)) for x, y in part]) for part in parts])


def test_geodesic_distance_on_equator_meridian_and_a_published_line():
    zero, one_deg = np.zeros(1), np.ones(1)
    assert geodesy.geodesic_distance(zero, zero, one_deg, zero)[0] == pytest.approx(geodesy.A * math.pi / 180, abs=1e-6)
    lat = np.linspace(0, np.pi / 2, 200_001)
    radius = geodesy.A * (1 - geodesy.E2) / (1 - geodesy.E2 * np.sin(lat) ** 2) ** 1.5
    quarter = np.trapezoid(radius, lat)
    steps = np.linspace(0, 90, 91)
    assert geodesy.geodesic_distance(np.zeros(90), steps[:-1], np.zeros(90), steps[1:]).sum() == pytest.approx(quarter, abs=1e-3)
    # Flinders Peak to Buninyong, a classic test line of this formula (on another ellipsoid within 0.01 m a kilometre)
    d = geodesy.geodesic_distance(np.array([144.42486788]), np.array([-37.95103341]), np.array([143.92649552]), np.array([-37.65282113]))
    assert d[0] == pytest.approx(54972.271, abs=0.3)


def test_geodesic_length_floors_zero_and_sums_parts(spark):
    assert one(spark, geodesy.geodesic_length(line([(5, 5), (5, 5)]))) == 0.01
    both = one(spark, geodesy.geodesic_length(line([(0, 0), (1, 0)], [(1, 0), (2, 0)])))
    assert both == pytest.approx(2 * geodesy.A * math.pi / 180, abs=1e-6)


def test_equal_area_gives_the_area_of_the_globe(spark):
    y = one(spark, geodesy.equal_area_y(F.lit(90.0)))
    assert 2 * y * 2 * math.pi * geodesy.A / 1e6 == pytest.approx(510_065_621.724, abs=0.01)


def test_mercator(spark):
    assert one(spark, geodesy.mercator_x(F.lit(180.0))) == pytest.approx(20037508.342789244)
    assert one(spark, geodesy.mercator_y(F.lit(0.0))) == pytest.approx(0, abs=1e-6)
    assert one(spark, geodesy.mercator_y(F.lit(85.0511287798066))) == pytest.approx(20037508.342789244, rel=1e-9)


def test_centroids_distance_area(spark):
    c = one(spark, lines.line_centroid(line([(0, 0), (2, 0), (2, 2)])))
    assert (c["x"], c["y"]) == (1.5, 0.5)
    c = one(spark, lines.line_centroid(line([(3, 4), (3, 4)])))
    assert (c["x"], c["y"]) == (3, 4)
    assert one(spark, lines.distance(line([(0, 0), (2, 0)]), lines.point(F.lit(1.0), F.lit(3.0)))) == 3
    assert one(spark, lines.distance(line([(0, 0), (2, 0)]), lines.point(F.lit(5.0), F.lit(4.0)))) == 5
    ring = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    hole = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
    assert one(spark, lines.polygon_area(line(ring, hole))) == 15
    p = one(spark, lines.polygon_centroid(line(ring)))
    assert (p["x"], p["y"]) == (2, 2)


def test_velocity_and_k(spark):
    areas = spark.createDataFrame([(0.0,), (6e7,), (9e8,), (None,)], "a double")
    v = [r[0] for r in areas.select(routing.velocity_factor(F.col("a"))).collect()]
    expected = [0.25 if a == 0 else max(0.25, round(math.exp(0.16842 * math.log(a) - 4.68), 3)) for a in (0.0, 6e7, 9e8)]
    assert v == [*expected, None]
    with pytest.raises(Exception, match="negative"):
        spark.createDataFrame([(-1.0,)], "a double").select(routing.velocity_factor(F.col("a"))).collect()
    k = [one(spark, routing.musk_k(F.lit(x), F.lit(1.0))) for x in (2.5, 3.5, -5.0, 1e9)]
    assert k == [2, 4, 0, 100_000]
    assert one(spark, routing.velocity_factor(F.lit(1.0), 0.1)) == 0.25


def test_k_helpers(spark):
    rows = spark.createDataFrame([(1, 1, 10.0), (1, 2, 30.0), (1, 3, 20.0), (2, 1, 7.0)], "g int, o int, k double")
    found = {r[0]: (r[1], r[2]) for r in rows.groupBy("g").agg(routing.last_plus_max_of_others("k", "o"), routing.scaled_mean("k")).collect()}
    assert found == {1: (50.0, 70.0), 2: (7.0, 7.0)}


def test_clipping(spark):
    def area(ring, *limits):
        return one(spark, lines.polygon_area(lines.clip_polygon(line(ring), *(F.lit(float(v)) for v in limits))))

    square = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    assert area(square, 1, 1, 2, 3) == 2 and area(square, -1, -1, 9, 9) == 16 and area(square, 5, 5, 6, 6) is None
    concave = [(0, 0), (6, 0), (6, 4), (4, 4), (4, 1), (2, 1), (2, 4), (0, 4), (0, 0)]
    assert area(concave, 0, 2, 6, 4) == 8
    hole = [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]
    cut = lines.clip_polygon(line(square, hole), *(F.lit(v) for v in (0.0, 0.0, 2.0, 4.0)))
    assert one(spark, lines.polygon_area(cut)) == 6


def test_douglas_peucker():
    points = np.array([(0, 0), (1, 0.01), (2, 0), (3, 1), (4, 0)], float)
    assert douglas_peucker(points, 0.1).tolist() == [[0, 0], [2, 0], [3, 1], [4, 0]]
    assert douglas_peucker(points, 5).tolist() == [[0, 0], [4, 0]]


def test_header_numbers(spark):
    assert header_numbers.header_number("1020000010") == 11 and header_numbers.header_number(9020000010) == 91
    assert header_numbers.header_numbers(spark).count() == 62
    assert GEOMETRY.startswith("array")
