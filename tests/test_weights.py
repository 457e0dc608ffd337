"""Grid cells, weights and their replay, against rectangle arithmetic."""

import pytest
from pyspark.sql import functions as F

from fluviant.functions import geodesy
from fluviant.functions.lines import box, map_points
from fluviant.operators import validate, weights
from fluviant.plans import fixtures
from fluviant.sources.files import read_axis


def basins(spark, rows):
    """(id, x, y, radius) squares."""
    df = spark.createDataFrame(rows, "LINKNO long, x double, y double, r double")
    return df.select("LINKNO", box(F.col("x"), F.col("y"), 1.0).alias("geometry")) if all(r[3] == 1.0 for r in rows) else df.select("LINKNO", box(F.col("x"), F.col("y"), rows[0][3]).alias("geometry"))


def rectangle(spark, x0, x1, y0, y1):
    y = spark.range(1).select(geodesy.equal_area_y(F.lit(y1)) - geodesy.equal_area_y(F.lit(y0))).first()[0]
    return geodesy.A * 3.141592653589793 / 180 * (x1 - x0) * y


def test_cells_are_midline_rectangles(spark):
    axis = read_axis(spark, [0.0, 1.0, 3.0], [10.0, 9.0])
    cells = {(r["lon_index"], r["lat_index"]): r for r in weights.thiessen_cells(axis, margin=1.0).collect()}
    assert len(cells) == 6
    c = cells[(1, 0)]
    assert (c["x0"], c["x1"], c["y0"], c["y1"], c["lon"]) == (0.5, 2.0, 9.5, 11.0, 1.25)


def test_longitudes_wrap(spark):
    axis = read_axis(spark, [0.0, 90.0, 180.0, 270.0], [0.0, 1.0])
    at = {r["lon_index"]: (r["x0"], r["x1"]) for r in weights.thiessen_cells(axis, margin=5.0).collect()}
    assert at[3] == (-95.0, -45.0) and at[2] == (135.0, 185.0)


def test_basin_over_four_cells_keeps_its_area(spark):
    axis = fixtures.grid_axis(spark)
    found = weights.basin_weights(basins(spark, [(7, 10.125, 20.125, 0.05)]), axis).collect()
    assert {(r["lon_index"], r["lat_index"]) for r in found} == {(40, 279), (41, 279), (40, 280), (41, 280)}
    whole = rectangle(spark, 10.075, 10.175, 20.075, 20.175)
    assert sum(r["area_sqm"] for r in found) == pytest.approx(whole, rel=1e-9)
    quarter = next(r for r in found if (r["lon_index"], r["lat_index"]) == (40, 280))
    assert quarter["area_sqm"] == pytest.approx(rectangle(spark, 10.075, 10.125, 20.075, 20.125), rel=1e-9)


def test_basin_inside_outside_and_at_the_date_line(spark):
    axis = fixtures.grid_axis(spark)
    inside = weights.basin_weights(basins(spark, [(1, 10.0, 20.0, 0.05)]), axis, with_npoints=True).collect()
    assert [(r["lon_index"], r["lat_index"], r["npoints"]) for r in inside] == [(40, 280, 1)]
    local = read_axis(spark, [10.0, 10.25], [20.0, 20.25])
    assert weights.basin_weights(basins(spark, [(1, 50.0, 50.0, 0.05)]), local, margin=0.125).isEmpty()
    border = weights.basin_weights(basins(spark, [(2, -179.95, 0.0, 0.05)]), axis).collect()
    assert sum(r["area_sqm"] for r in border) == pytest.approx(rectangle(spark, -180.0, -179.9, -0.05, 0.05), rel=1e-9)


def test_wide_basin_counts_each_cell_once(spark):
    axis = fixtures.grid_axis(spark)
    found = weights.basin_weights(basins(spark, [(1, 10.3, 20.3, 1.0)]), axis)
    assert found.count() == found.select("lon_index", "lat_index").distinct().count() == 81
    total = found.agg(F.sum("area_sqm")).first()[0]
    assert total == pytest.approx(rectangle(spark, 9.3, 11.3, 19.3, 21.3), rel=1e-9)


def test_window_and_wrapped_window(spark):
    axis = fixtures.grid_axis(spark)
    window = weights.axis_window(axis, (10.0, 20.0, 11.0, 21.0))
    lon = sorted(r["idx"] for r in window.where("axis = 'lon'").collect())
    assert lon == list(range(39, 46))
    wrapped = weights.axis_window(axis, (-0.5, 0.0, 0.5, 0.0))
    lon = {r["idx"] for r in wrapped.where("axis = 'lon'").collect()}
    assert lon == {0, 1, 2, 3, 1437, 1438, 1439}


def test_weights_of_axes_equal_those_of_the_whole_grid(spark):
    axis = fixtures.grid_axis(spark)
    table = basins(spark, [(1, 10.3, 20.3, 0.2), (2, 11.0, 21.1, 0.2)])
    cut = {tuple(r) for r in weights.basin_weights_of_axes(table, axis).collect()}
    assert cut == {tuple(r) for r in weights.basin_weights(table, axis, with_npoints=True).collect()} and cut
    assert weights.basin_weights_of_axes(table.limit(0), axis).isEmpty()


def test_basins_come_in_degrees(spark):
    table = basins(spark, [(1, 10.3, 20.3, 0.2)])
    moved = table.withColumn("geometry", map_points(F.col("geometry"), lambda p: geodesy.mercator_x(p["x"]), lambda p: geodesy.mercator_y(p["y"])))
    back = weights.in_degrees(moved, "EPSG:3857").first()["geometry"][0]
    for a, b in zip(back, table.first()["geometry"][0], strict=True):
        assert (a["x"], a["y"]) == pytest.approx((b["x"], b["y"]), abs=1e-9)
    assert weights.in_degrees(table, "epsg:4326") is table
    with pytest.raises(ValueError, match="reproject"):
        weights.in_degrees(table, "epsg:32633")


def test_null_id_becomes_zero(spark):
    found = weights.basin_weights(basins(spark, [(None, 10.0, 20.0, 0.05)]), fixtures.grid_axis(spark)).first()
    assert found["LINKNO"] == 0


def test_replay(spark):
    full = spark.createDataFrame([(i, 1.0, 0, 0, 0.5, 0.5) for i in range(1, 9)], "LINKNO long, area_sqm double, lon_index int, lat_index int, lon double, lat double")

    def frame(rows, names):
        return spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))

    slim = weights.simplify_weights(
        full,
        [frame([(2, 1)], ("keep", "drop")), frame([(3, 2)], ("keep", "drop"))],
        frame([(5, 4)], ("LINKNO", "LINKTODROP")),
        frame([(8,)], ("drop",)),
        frame([(7, 6), (9, 7), (5, 3)], ("LINKNO", "MergeWith")),
    )
    # 1 and 2 reach 3, and 3 merges into 5 with 4; 6 merges into 7; 9 has no rows, so 7 stays
    assert {r["LINKNO"]: r["area_sqm"] for r in slim.collect()} == {5: 5.0, 7: 2.0}


def test_replay_swaps_ids_and_drops_null_keys(spark):
    full = spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 0), (3, 4.0, None)], "LINKNO long, area_sqm double, lon_index int")
    none = spark.createDataFrame([], "a long, b long")
    slim = weights.simplify_weights(full, [], spark.createDataFrame([(2, 1), (1, 2)], "LINKNO long, LINKTODROP long"), none.select(F.col("a").alias("drop")), none.toDF("LINKNO", "MergeWith"))
    assert {r["LINKNO"]: r["area_sqm"] for r in slim.collect()} == {2: 1.0, 1: 2.0}


def test_validation(spark):
    ids, fewer = spark.range(3).withColumnRenamed("id", "LINKNO"), spark.range(2).withColumnRenamed("id", "LINKNO")
    assert {r["name"]: r["matches"] for r in validate.region_consistency(ids, {"a": ids, "b": fewer}).collect()} == {"master": True, "a": True, "b": False}
    assert validate.outputs_valid({"x": ids}, {"w": ids}).first()["valid"] is True
    assert validate.outputs_valid({"x": ids}, {"w": fewer}).first()["valid"] is False
    assert validate.outputs_valid({"x": ids}, {}).first()["valid"] is False
    names = spark.createDataFrame([("weight_a_full.csv",), ("weight_a.csv",), ("weight_b_full.csv",), ("k.csv",)], "name string")
    assert {r["name"]: r["has_slim"] for r in validate.slim_tables_present(names).collect()} == {"weight_a_full.csv": True, "weight_b_full.csv": False}
