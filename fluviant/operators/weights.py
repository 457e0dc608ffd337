"""Grid cells, basin weights and their replay after network changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geodesy import equal_area_x, equal_area_y, mercator_lat, mercator_lon
from ..functions.lines import bounds, clip_polygon, map_points, polygon_area
from ..session import scratch
from .graph import resolve_chains


def wrapped(lon: Column) -> Column:
    """Longitudes beyond 180 degrees, as negative ones."""
    return F.when(lon > 180, lon - 360).otherwise(lon)


def axis_cells(axis: DataFrame, name: str, margin: float) -> DataFrame:
    """``idx, coord, lo, hi``: each position of an axis and the band of places nearest to it.

    Bands end half way to the neighbours; the outermost ones reach ``margin`` beyond
    the first and last coordinate. Of equal coordinates the first index has the band.
    An axis is as long as a grid is wide, so ordering it in one task is safe."""
    values = axis.where(F.col("axis") == name).select("idx", (wrapped(F.col("coord")) if name == "lon" else F.col("coord")).alias("coord"))
    values = values.groupBy("coord").agg(F.min("idx").alias("idx"))
    order = Window.orderBy("coord")
    before, after = F.lag("coord").over(order), F.lead("coord").over(order)
    lo = F.coalesce((F.col("coord") + before) / 2, F.col("coord") - margin)
    hi = F.coalesce((F.col("coord") + after) / 2, F.col("coord") + margin)
    return values.select("idx", "coord", lo.alias("lo"), hi.alias("hi"))


def grid_margin(axis: DataFrame) -> float:
    """How far the envelope of the outer cells reaches: the larger extent of the grid."""
    at = F.when(F.col("axis") == "lon", wrapped(F.col("coord"))).otherwise(F.col("coord"))
    spans = [r[0] for r in axis.groupBy("axis").agg((F.max(at) - F.min(at)).alias("span")).select("span").collect()]
    return float(max(spans, default=0.0))


def thiessen_cells(axis: DataFrame, margin: float | None = None) -> DataFrame:
    """``lon_index, lat_index, lon, lat, x0, x1, y0, y1``: the nearest-point cells of a grid.

    On a rectilinear grid they are rectangles between the midlines. ``lon`` and
    ``lat`` are the cell's centroid, the indices those of the nearest coordinates."""
    margin = grid_margin(axis) if margin is None else margin
    across, up = axis_cells(axis, "lon", margin), axis_cells(axis, "lat", margin)
    xs = across.select(F.col("idx").alias("lon_index"), ((F.col("lo") + F.col("hi")) / 2).alias("lon"), F.col("lo").alias("x0"), F.col("hi").alias("x1"))
    ys = up.select(F.col("idx").alias("lat_index"), ((F.col("lo") + F.col("hi")) / 2).alias("lat"), F.col("lo").alias("y0"), F.col("hi").alias("y1"))
    cells = xs.crossJoin(F.broadcast(ys))  # the grid itself: every pair of positions is a cell
    return cells.select("lon_index", "lat_index", "lon", "lat", "x0", "x1", "y0", "y1")


def nearest_index(axis: DataFrame, name: str, value: float) -> int:
    """Index of the coordinate nearest to ``value``, the first of equals."""
    at = wrapped(F.col("coord")) if name == "lon" else F.col("coord")
    return axis.where(F.col("axis") == name).agg(F.min_by("idx", F.struct(F.abs(at - value), "idx"))).first()[0]


def axis_window(axis: DataFrame, basin_bounds: tuple[float, float, float, float]) -> DataFrame:
    """The part of the axes around the basins, one resolution wider on each side.

    If the western index lies behind the eastern one, the window wraps: it is the
    end of the axis and its beginning."""
    first = {r["idx"]: r["coord"] for r in axis.where("axis = 'lon' and idx < 2").collect()}
    pad = abs(first[1] - first[0])
    x0, y0, x1, y1 = basin_bounds
    west, east = nearest_index(axis, "lon", x0 - pad), nearest_index(axis, "lon", x1 + pad)
    south, north = sorted((nearest_index(axis, "lat", y0 - pad), nearest_index(axis, "lat", y1 + pad)))
    idx = F.col("idx")
    lon = ((idx >= west) | (idx <= east)) if west > east else idx.between(west, east)
    return axis.where(F.when(F.col("axis") == "lon", lon).otherwise(idx.between(south, north)))


def total_bounds(basins: DataFrame) -> tuple[float, float, float, float]:
    b = basins.select(bounds(F.col("geometry")).alias("b"))
    return tuple(b.agg(F.min("b.x0"), F.min("b.y0"), F.max("b.x1"), F.max("b.y1")).first())


def equal_area(polygon: Column) -> Column:
    """Square metres of a polygon in degrees, on the equal-area cylinder."""
    return polygon_area(map_points(polygon, lambda p: equal_area_x(p["x"]), lambda p: equal_area_y(p["y"])))


def basin_weights(basins: DataFrame, axis: DataFrame, id_col: str = "LINKNO", with_npoints: bool = False, margin: float | None = None) -> DataFrame:
    """``id, area_sqm, lon_index, lat_index, lon, lat`` of each basin and cell that overlap.

    Each basin looks up the bands of longitude and latitude that its bounds meet, an
    equi-join on whole degrees; no theta join. A basin inside one cell is not cut;
    others are cut by the cell's rectangle. Cells that are only touched are left out
    and a null id becomes 0, as the weight files have it. ``with_npoints`` adds the
    number of rows of each id."""
    margin = grid_margin(axis) if margin is None else margin
    shapes = basins.select(F.col(id_col).alias("id"), "geometry", bounds(F.col("geometry")).alias("b"))

    def bands(name: str, keys: tuple[str, str, str, str]) -> DataFrame:
        cells = axis_cells(axis, name, margin)
        whole = F.explode(F.sequence(F.floor(F.greatest("lo", F.lit(-361.0))).cast("int"), F.floor(F.least("hi", F.lit(361.0))).cast("int")))
        return F.broadcast(cells.select(F.col("idx").alias(keys[0]), ((F.col("lo") + F.col("hi")) / 2).alias(keys[1]), F.col("lo").alias(keys[2]), F.col("hi").alias(keys[3]), whole.alias(keys[0] + "_deg")))

    def meet(rows: DataFrame, name: str, lo: str, hi: str, keys: tuple[str, str, str, str]) -> DataFrame:
        degrees = F.sequence(F.floor(lo).cast("int"), F.floor(hi).cast("int"))
        joined = rows.withColumn("deg", F.explode(degrees)).join(bands(name, keys), F.col("deg") == F.col(keys[0] + "_deg"))
        # a band that shares several degrees with the basin counts once: in the first they share
        first = F.greatest(F.floor(lo), F.floor(F.greatest(keys[2], F.lit(-361.0)))).cast("int")
        return joined.where((F.col(keys[2]) < F.col(hi)) & (F.col(keys[3]) > F.col(lo)) & (F.col("deg") == first)).drop("deg", keys[0] + "_deg")

    rows = meet(shapes, "lon", "b.x0", "b.x1", ("lon_index", "lon", "x0", "x1"))
    rows = meet(rows, "lat", "b.y0", "b.y1", ("lat_index", "lat", "y0", "y1"))
    within = (F.col("b.x0") >= F.col("x0")) & (F.col("b.x1") <= F.col("x1")) & (F.col("b.y0") >= F.col("y0")) & (F.col("b.y1") <= F.col("y1"))
    part = F.when(within, F.col("geometry")).otherwise(clip_polygon(F.col("geometry"), F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    found = rows.select(F.coalesce("id", F.lit(0).cast("long")).alias("id"), "lon_index", "lat_index", "lon", "lat", F.coalesce(equal_area(part), F.lit(0.0)).alias("area_sqm"))
    found = found.where("area_sqm > 0")
    found = found.select(F.col("id").alias(id_col), "area_sqm", "lon_index", "lat_index", "lon", "lat")
    if with_npoints:
        counts = found.groupBy(id_col).agg(F.count(F.lit(1)).alias("npoints"))
        found = found.join(counts, id_col).select(id_col, "area_sqm", "lon_index", "lat_index", "npoints", "lon", "lat")
    return found


def basin_weights_of_axes(basins: DataFrame, axis: DataFrame, id_col: str = "LINKNO") -> DataFrame:
    """Weights straight from a grid's axes, cut to the basins' surroundings, with ``npoints``.

    Indices stay those of the whole axes. An empty basin table has no surroundings and
    gives no rows."""
    around = total_bounds(basins)
    if around[0] is None:
        return basin_weights(basins, axis, id_col, with_npoints=True)
    return basin_weights(basins, axis_window(axis, around), id_col, with_npoints=True, margin=grid_margin(axis))


def in_degrees(basins: DataFrame, crs: str) -> DataFrame:
    """Basins in degrees, whatever of the two systems in use they come in."""
    if crs.lower() in ("epsg:4326", "ogc:crs84"):
        return basins
    if crs.lower() != "epsg:3857":
        raise ValueError(f"cannot reproject {crs}")
    return basins.withColumn("geometry", map_points(F.col("geometry"), lambda p: mercator_lon(p["x"]), lambda p: mercator_lat(p["y"])))


def simplify_weights(weights: DataFrame, dissolve_passes: list[DataFrame], prune: DataFrame, drop: DataFrame, merge: DataFrame, id_col: str = "LINKNO") -> DataFrame:
    """Replay the network's changes on a weight table.

    Dissolve labels pass by pass (``keep, drop``), then the prune map once, then the
    drops, then a sum over all other columns, then the merges and a second sum. A
    merge counts only if both ids have rows at that point. Rows with a null in a
    grouping column are dropped by the sums."""
    others = [c for c in weights.columns if c != "area_sqm"]

    def relabel(rows: DataFrame, pairs: DataFrame) -> DataFrame:
        to = pairs.select(F.col(pairs.columns[1]).alias(id_col), F.col(pairs.columns[0]).alias("__to")).distinct()
        return rows.join(to, id_col, "left").withColumn(id_col, F.coalesce("__to", id_col)).drop("__to")

    def total(rows: DataFrame) -> DataFrame:
        return rows.na.drop(subset=others).groupBy(*others).agg(F.sum("area_sqm").alias("area_sqm"))

    rows = weights
    for labels in dissolve_passes:
        rows = relabel(rows, labels.select("keep", "drop"))
    rows = relabel(rows, prune.select("LINKNO", "LINKTODROP"))
    rows = scratch(total(rows.join(drop.select(F.col("drop").alias(id_col)), id_col, "left_anti")), "replayed")
    present = rows.select(id_col).distinct()
    valid = merge.join(present.withColumnRenamed(id_col, "LINKNO"), "LINKNO", "left_semi").join(present.withColumnRenamed(id_col, "MergeWith"), "MergeWith", "left_semi")
    ends = resolve_chains(valid.select(F.col("MergeWith").alias("id"), F.col("LINKNO").alias("target")))
    return total(relabel(rows, ends.select(F.col("final").alias("keep"), F.col("id").alias("drop")))).select(*others, "area_sqm")
