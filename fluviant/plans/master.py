"""The master pipeline: from a stream table to routing inputs, and all change logs."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import clean, routing_tables, simplify
from ..operators.graph import flow
from ..operators.numbering import numbered_by_group
from ..schema import LAKE_MIN_K_S, MIN_DRAINAGE_AREA_M2, MIN_HEADWATER_ORDER, MIN_K_S, MIN_VELOCITY
from ..session import scratch

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Options:
    """Switches and thresholds of one run; regions with equal options share a run."""

    drop_small_watersheds: bool = True
    dissolve_headwaters: bool = True
    prune_main_stems: bool = True
    merge_short_streams: bool = True
    min_area_m2: float = MIN_DRAINAGE_AREA_M2
    min_stream_order: int = MIN_HEADWATER_ORDER
    default_velocity: float | None = None
    min_velocity: float = MIN_VELOCITY
    min_k: int = MIN_K_S
    lake_min_k: int = LAKE_MIN_K_S


@dataclass
class Master:
    """The master table, its lines, and what was changed on the way.

    ``lines`` (``LINKNO, geometry``) holds each river's own line and all it took in."""

    table: DataFrame
    zero_length: DataFrame
    zero_centroid: DataFrame
    small_trees: DataFrame | None = None
    dissolved: list[DataFrame] = field(default_factory=list)
    pruned: DataFrame | None = None
    merged: DataFrame | None = None
    lines: DataFrame | None = None


@dataclass
class Network:
    """A repaired network without lines, and all that one walk down it tells.

    ``nodes`` (written) has the stream columns, ``TopologicalOrder``, ``root`` and the
    drainage area there, and the segment that absorbs a row when headwaters of order 1
    (``mark2``) and 2 (``mark3``) dissolve. Rows with a null in a stream column keep their
    place in the order but are not in ``table``."""

    nodes: DataFrame
    source: DataFrame
    zero_length: DataFrame

    @property
    def table(self) -> DataFrame:
        return self.nodes.where("complete").drop("complete")

    @property
    def graph(self) -> DataFrame:
        return self.nodes.select("LINKNO", "DSLINKNO")

    def small(self, least_area_m2: float) -> Column:
        """Whether a row is in a tree whose outlet drains less than this."""
        return F.coalesce(F.col("root_DSContArea") < least_area_m2, F.lit(False))

    def labels(self, m: int, rows: DataFrame) -> DataFrame:
        """``keep, drop`` of the pass for order ``m``, of the given rows of ``nodes``."""
        mark = F.col(f"mark{m}")
        return rows.where(mark.isNotNull() & (mark != F.col("LINKNO"))).select(mark.alias("keep"), F.col("LINKNO").alias("drop"))

    def lines_of(self, order: int, rows: DataFrame | None = None) -> DataFrame:
        """``LINKNO, TopologicalOrder, geometry``: the source lines by the segment that has
        absorbed them after all passes up to ``order``; one row for each source line."""
        rows = self.table if rows is None else rows
        marks = [f"mark{m}" for m in range(min(order, 3), 1, -1)]
        base = rows.select("LINKNO", F.coalesce(*marks, "LINKNO").alias("base"), "TopologicalOrder")
        return base.join(self.source.select("LINKNO", "geometry"), "LINKNO").select(F.col("base").alias("LINKNO"), "TopologicalOrder", "geometry")


def prepare(streams: DataFrame) -> Network:
    """Repair zero-length segments and walk the network once.

    Lines stay in ``streams`` (which must be cheap to read) until they are asked for."""
    light = streams.drop("geometry")
    classes = scratch(clean.zero_length_classes(light), "zero-length")
    repaired = clean.repair_zero_length(light, classes)
    whole = reduce(lambda a, c: a & F.col(c).isNotNull(), light.columns, F.lit(True))
    repaired = scratch(repaired.withColumn("complete", whole), "repaired")
    marked = simplify.mark_headwaters(repaired.where("complete"))
    rest = repaired.where("not complete").withColumns({"mark2": F.lit(False), "mark3": F.lit(False)})
    marked = scratch(marked.unionByName(rest), "marked")
    walked = flow(marked.select("LINKNO", "DSLINKNO", "DSContArea", "mark2", "mark3"), marks=("mark2", "mark3"), carry=("DSContArea",), with_height=True).withColumnRenamed("id", "LINKNO")
    # A segment of order 3 absorbs only what no candidate of order 2 farther down has taken.
    third = F.when(F.col("mark2").isNull() | (F.col("at_mark3") > F.col("at_mark2")), F.col("mark3"))
    walked = walked.withColumn("mark3", third).drop("at_mark2", "at_mark3")
    nodes = repaired.join(walked, "LINKNO")
    return Network(scratch(numbered_by_group(nodes, "TDXHydroRegion", ["height", "LINKNO"], "TopologicalOrder", "ordered").drop("height"), "nodes"), streams, classes)


def dissolved(net: Network, order: int, least_area_m2: float | None, up_to: int = 3) -> tuple[DataFrame, list[DataFrame]]:
    """(the network without small trees and with headwaters dissolved for orders 2 to
    ``order``, the labels of each pass). ``least_area_m2`` None keeps small trees."""
    rows = net.nodes if least_area_m2 is None else net.nodes.where(~net.small(least_area_m2))
    network, passes = rows.where("complete").drop("complete"), []
    for m in range(2, min(order, up_to) + 1):
        passes.append(scratch(net.labels(m, rows), f"dissolve-{m}"))
        network = simplify.dissolve_headwaters(network, passes[-1])
    return network, passes


def region_master(streams: DataFrame, lakes: DataFrame, options: Options | None = None) -> Master:
    """Clean, simplify and parametrise a network of one or more regions.

    Zero-length segments are always repaired. Headwaters are dissolved by passes for
    order 2 and 3; for a higher minimum order the network is dissolved no further,
    and neither are the weights. Watersheds are labelled by the connectivity before
    the merges; a segment whose way meets an id that is not there raises an error.

    Order, outlets and the segments that absorb headwaters come from one walk down the
    network (``prepare``), in columns without lines; lines are put together at the end."""
    o = options or Options()
    net = prepare(streams)
    made = Master(net.nodes, net.zero_length, clean.zero_id_centroid(net.source.join(net.graph.where("LINKNO = 0").select("LINKNO"), "LINKNO", "left_semi")))
    if o.drop_small_watersheds:
        made.small_trees = scratch(net.nodes.where(net.small(o.min_area_m2)).select(F.col("LINKNO").alias("drop")), "small-trees")
    if o.dissolve_headwaters and o.min_stream_order > 3:
        log.warning("headwaters are dissolved up to order 3 only")
    order = o.min_stream_order if o.dissolve_headwaters else 1
    network, made.dissolved = dissolved(net, order, o.min_area_m2 if o.drop_small_watersheds else None)
    if o.prune_main_stems:
        network = scratch(network, "dissolved")
        made.pruned = scratch(simplify.prune_pairs(network, net.graph, net.lines_of(order)), "prune")
        network = simplify.prune_branches(network, made.pruned)
    network = routing_tables.muskingum(network, lakes, o.default_velocity, o.min_velocity, lake_min_k=o.lake_min_k)
    network = scratch(network, "routed")
    network = routing_tables.label_by_root(network)
    labels = None
    if o.merge_short_streams:
        made.merged = scratch(simplify.short_stream_pairs(network, o.min_k), "merge")
        labels = scratch(simplify.merge_labels(made.merged), "merge-labels")
        network = simplify.merge_labelled(network, labels)
    made.table = scratch(network.drop("root", "root_DSContArea", "mark2", "mark3"), "table")
    made.lines = _lines(net.lines_of(order), labels, made.table)
    return made


def _lines(parts: DataFrame, merges: DataFrame | None, table: DataFrame) -> DataFrame:
    """``LINKNO, geometry`` of each row of ``table``: all lines that ended up there, upstream first."""
    if merges is not None:
        moved = merges.select(F.col("drop").alias("LINKNO"), "keep")
        parts = parts.join(moved, "LINKNO", "left").withColumn("LINKNO", F.coalesce("keep", "LINKNO")).drop("keep")
    parts = parts.join(table.select("LINKNO"), "LINKNO", "left_semi")
    ordered = F.sort_array(F.collect_list(F.struct("TopologicalOrder", F.col("geometry").alias("g"))))
    return parts.groupBy("LINKNO").agg(F.flatten(F.transform(ordered, lambda s: s["g"])).alias("geometry"))


def options_by_region(table: DataFrame) -> dict[Options, list[str]]:
    """Regions to process, grouped by equal options; the table has a row a region.

    Columns: region_number, process, drop_small_watersheds, dissolve_headwaters,
    prune_main_stems, merge_short_streams, min_area_km2, min_stream_order. Others,
    like fix_taudem_errors, have no effect."""
    groups: dict[Options, list[str]] = {}
    names = {f.name for f in fields(Options)}
    for row in table.where("process").collect():
        given = {k: v for k, v in row.asDict().items() if k in names and v is not None}
        if row["min_area_km2"] is not None:
            given["min_area_m2"] = float(row["min_area_km2"]) * 1e6
        groups.setdefault(Options(**given), []).append(str(row["region_number"]))
    return groups


def run_groups(streams: DataFrame, lakes: DataFrame, groups: dict[Options, list[str]]) -> tuple[dict[Options, Master], dict[Options, Exception]]:
    """A master for each group of regions, and the groups that failed.

    A failure is logged and leaves the other groups alone."""
    done, failed = {}, {}
    for options, regions in groups.items():
        try:
            chosen = streams.where(F.col("TDXHydroRegion").isin(regions))  # 62 regions at most
            done[options] = region_master(chosen, lakes, options)
        except Exception as e:  # noqa: BLE001 - one group's failure must not stop the rest
            log.exception("regions %s failed", regions)
            failed[options] = e
    return done, failed


def run_regions(streams: DataFrame, lakes: DataFrame, table: DataFrame) -> tuple[dict[Options, Master], dict[Options, Exception]]:
    """``run_groups`` for the regions to process in an options table."""
    return run_groups(streams, lakes, options_by_region(table))
