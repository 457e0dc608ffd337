"""Cleaning a network: zero-length segments, order, small watersheds, basins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lines import box, line_centroid
from ..schema import MIN_DRAINAGE_AREA_M2, OUTLET, ZERO_ID_BOX_DEGREES, ZERO_LENGTH_M
from .graph import edges, flow, heights, resolve_chains
from .numbering import numbered_by_group


def zero_length_classes(streams: DataFrame, length_col: str = "LengthGeodesicMeters") -> DataFrame:
    """``id, case`` of each segment of length 0.01 or less.

    1: an outlet that nothing drains into; 2: any segment with a downstream one,
    headwaters too; 3: an outlet with upstream segments. A fourth case cannot occur
    among ids other than -1."""
    short = streams.where(F.col(length_col) <= ZERO_LENGTH_M).select(F.col("LINKNO").alias("id"), "DSLINKNO")
    fed = streams.select(F.col("DSLINKNO").alias("id")).join(short, "id", "left_semi").distinct().withColumn("fed", F.lit(True))
    case = F.when(F.col("DSLINKNO") != OUTLET, 2).when(F.col("fed"), 3).otherwise(1)
    return short.join(fed, "id", "left").select("id", case.cast("int").alias("case"))


def repair_zero_length(streams: DataFrame, classes: DataFrame) -> DataFrame:
    """Remove all classified segments; what drained into one goes on to the next kept
    segment downstream, or becomes an outlet where there is none."""
    removed = classes.select(F.col("id").alias("LINKNO"), "case")
    chained = streams.join(removed, "LINKNO").where("case = 2").select(F.col("LINKNO").alias("id"), F.col("DSLINKNO").alias("target"))
    ends = resolve_chains(chained).select(F.col("id").alias("DSLINKNO"), "final")
    kept = streams.join(removed.select("LINKNO"), "LINKNO", "left_anti").join(ends, "DSLINKNO", "left")
    onward = kept.withColumn("DSLINKNO", F.coalesce("final", "DSLINKNO")).drop("final")
    outlets = removed.where("case = 3").select(F.col("LINKNO").alias("DSLINKNO"), F.lit(True).alias("gone"))
    joined = onward.join(outlets, "DSLINKNO", "left").withColumn("DSLINKNO", F.when(F.col("gone"), F.lit(OUTLET).cast("long")).otherwise(F.col("DSLINKNO")))
    return joined.select(*streams.columns)


def topological_order(streams: DataFrame, region_col: str = "TDXHydroRegion") -> DataFrame:
    """``streams`` with ``TopologicalOrder`` 1..n in each region, upstream first.

    The order is (height, LINKNO); rows with a null in any column are dropped after
    numbering, so gaps are possible. A null region is numbered as a region of its own."""
    leveled = streams.join(heights(streams).withColumnRenamed("id", "LINKNO"), "LINKNO")
    ordered = numbered_by_group(leveled, region_col, ["height", "LINKNO"], "TopologicalOrder", "topological")
    return ordered.select(*streams.columns, "TopologicalOrder").na.drop()


def small_watersheds(streams: DataFrame, least_area_m2: float = MIN_DRAINAGE_AREA_M2) -> DataFrame:
    """``drop``: ids of outlets that drain less than ``least_area_m2``, and of all upstream of them."""
    walked = flow(streams, carry=("DSContArea",))
    return walked.where(F.col("root_DSContArea") < least_area_m2).select(F.col("id").alias("drop"))


def drop_segments(streams: DataFrame, drop: DataFrame) -> DataFrame:
    return streams.join(drop.select(F.col("drop").alias("LINKNO")), "LINKNO", "left_anti")


def zero_id_centroid(streams: DataFrame) -> DataFrame:
    """``LINKNO, centroid_x, centroid_y`` of a segment with id 0; no row without one."""
    at = line_centroid(F.col("geometry"))
    return streams.where("LINKNO = 0").select("LINKNO", at["x"].alias("centroid_x"), at["y"].alias("centroid_y"))


def repair_basins(basins: DataFrame, classes: DataFrame, drop: DataFrame, zero_centroid: DataFrame | None = None) -> DataFrame:
    """Basins without those of zero-length segments and small watersheds; where a
    segment has id 0, with a small square around its centroid as its basin."""
    if zero_centroid is not None:
        square = box(F.col("centroid_x"), F.col("centroid_y"), ZERO_ID_BOX_DEGREES)
        basins = basins.unionByName(zero_centroid.select("LINKNO", square.alias("geometry")), allowMissingColumns=True)
    gone = classes.select(F.col("id").alias("LINKNO")).unionByName(drop.select(F.col("drop").alias("LINKNO")))
    return basins.join(gone, "LINKNO", "left_anti")


__all__ = ["zero_length_classes", "repair_zero_length", "topological_order", "small_watersheds", "drop_segments", "zero_id_centroid", "repair_basins", "edges"]
