"""Routing columns, connectivity, watershed labels and the master table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.routing import musk_k, velocity_factor
from ..schema import DEFAULT_X, LAKE_MIN_K_S, LAKE_X, MASTER_COLUMNS, MIN_VELOCITY, OUTLET
from .graph import roots


def muskingum(network: DataFrame, lakes: DataFrame, default_velocity: float | None = None, least_velocity: float = MIN_VELOCITY, x: float = DEFAULT_X, lake_min_k: int = LAKE_MIN_K_S) -> DataFrame:
    """``network`` with ``velocity_factor``, ``musk_k`` and ``musk_x``; lake segments
    get at least ``lake_min_k`` seconds and the lakes' x."""
    marked = lakes.select("LINKNO").distinct().withColumn("is_lake", F.lit(True))
    rows = network.withColumn("velocity_factor", velocity_factor(F.col("DSContArea"), default_velocity, least_velocity))
    rows = rows.withColumn("musk_k", musk_k(F.col("LengthGeodesicMeters"), F.col("velocity_factor"))).join(marked, "LINKNO", "left")
    lake = F.coalesce("is_lake", F.lit(False))
    rows = rows.withColumn("musk_k", F.when(lake, F.greatest("musk_k", F.lit(lake_min_k).cast("long"))).otherwise(F.col("musk_k")))
    return rows.withColumn("musk_x", F.when(lake, LAKE_X).otherwise(F.lit(x))).select(*network.columns, "velocity_factor", "musk_k", "musk_x")


def terminal_links(network: DataFrame) -> DataFrame:
    """``LINKNO, TerminalLink``: the outlet that each segment drains to."""
    return roots(network).select(F.col("id").alias("LINKNO"), F.col("root").alias("TerminalLink"))


def label_watersheds(network: DataFrame, graph: DataFrame) -> DataFrame:
    """``network`` with ``TerminalLink`` by the connectivity of ``graph``; raises for a
    segment whose way ends at an id that is no outlet of ``network``."""
    outlets = network.where(F.col("DSLINKNO") == OUTLET).select(F.col("LINKNO").alias("TerminalLink"), F.lit(True).alias("known"))
    labeled = network.join(terminal_links(graph), "LINKNO", "left").join(outlets, "TerminalLink", "left")
    label = F.when(F.col("known"), F.col("TerminalLink")).otherwise(F.raise_error(F.concat(F.lit("no outlet for segment "), F.col("LINKNO").cast("string"))).cast("long"))
    return labeled.select(*network.columns, label.alias("TerminalLink"))


def label_by_root(network: DataFrame) -> DataFrame:
    """``network`` with ``TerminalLink``, which is its column ``root``; raises for a segment
    that drains into an id that is not there, as all upstream of it have no outlet then."""
    ids = network.select(F.col("LINKNO").alias("DSLINKNO"), F.lit(True).alias("known"))
    joined = network.join(ids, "DSLINKNO", "left")
    missing = (F.col("DSLINKNO") != OUTLET) & F.col("known").isNull()
    label = F.when(missing, F.raise_error(F.concat(F.lit("no outlet for segment "), F.col("LINKNO").cast("string"))).cast("long")).otherwise(F.col("root"))
    return joined.select(*network.columns, label.alias("TerminalLink"))


def connectivity(network: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``HydroID, NextDownID, CountUpstreamID, UpstreamIDs``: upstream ids as an array in
    the order of the frame (``TopologicalOrder``, then id)."""
    order = order or ["TopologicalOrder", "LINKNO"]
    ups = network.where(F.col("DSLINKNO") != OUTLET).groupBy(F.col("DSLINKNO").alias("HydroID"))
    lists = ups.agg(F.transform(F.sort_array(F.collect_list(F.struct(*order))), lambda s: s["LINKNO"]).alias("UpstreamIDs"))
    rows = network.select(F.col("LINKNO").alias("HydroID"), F.col("DSLINKNO").alias("NextDownID")).join(lists, "HydroID", "left")
    ids = F.coalesce("UpstreamIDs", F.array().cast("array<bigint>"))
    return rows.select("HydroID", "NextDownID", F.size(ids).cast("long").alias("CountUpstreamID"), ids.alias("UpstreamIDs"))


def rapid_connect(network: DataFrame, width: int | None = None) -> DataFrame:
    """The connectivity as columns ``UpstreamID1..N``, padded with 0; N is the largest
    count unless given."""
    rows = connectivity(network)
    if width is None:
        width = rows.agg(F.max("CountUpstreamID")).first()[0] or 0
    ids = [F.coalesce(F.get("UpstreamIDs", F.lit(i)), F.lit(0).cast("long")).alias(f"UpstreamID{i + 1}") for i in range(width)]
    return rows.select("HydroID", "NextDownID", "CountUpstreamID", *ids)


def routing_columns(network: DataFrame) -> DataFrame:
    """One row per river with what the parallel column files hold."""
    zero = F.lit(0)
    return network.select("TopologicalOrder", "LINKNO", "musk_k", "musk_x", zero.alias("lat"), zero.alias("lon"), zero.alias("z"))


class MissingLabelError(RuntimeError):
    """Some terminal segments are in no processing unit."""


def missing_vpu_labels(masters: DataFrame, vpu: DataFrame) -> DataFrame:
    """Rows whose ``TerminalLink`` has no code in the table (``TerminalLink, VPUCode``)."""
    return masters.join(vpu.where("VPUCode is not null").select("TerminalLink"), "TerminalLink", "left_anti").select(*masters.columns)


def global_master(masters: DataFrame, vpu: DataFrame, check: bool = True) -> DataFrame:
    """The master tables of all regions with their unit codes, twelve columns.

    With ``check`` a row without a code raises MissingLabelError; without, it is
    left to the caller to look at ``missing_vpu_labels``."""
    if check and not missing_vpu_labels(masters, vpu).isEmpty():
        raise MissingLabelError("some terminal segments are not in the unit table")
    codes = vpu.select("TerminalLink", F.col("VPUCode").cast("long"))
    return masters.join(codes, "TerminalLink", "left").select(*MASTER_COLUMNS)


def vpu_weights(weights: DataFrame, master: DataFrame, id_col: str = "LINKNO") -> DataFrame:
    """Weight rows of the rivers of a master, with the unit of each.

    Rows are found by id over all regions, so a unit that spans regions is whole."""
    units = master.select(F.col("LINKNO").alias(id_col), "VPUCode")
    return weights.join(units, id_col)


def vpu_streams(lines: DataFrame, master: DataFrame) -> DataFrame:
    """Lines (``LINKNO, geometry`` in degrees) with their master columns, geometry in Mercator metres."""
    from ..functions.geodesy import mercator_x, mercator_y
    from ..functions.lines import map_points

    moved = map_points(F.col("geometry"), lambda p: mercator_x(p["x"]), lambda p: mercator_y(p["y"]))
    return lines.join(master, "LINKNO").withColumn("geometry", moved)
