"""The river-network queries registered with the driver."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geodesy import geodesic_length
from ..functions.lines import line_centroid, point
from ..functions.routing import last_plus_max_of_others, scaled_mean
from ..functions.simplify import simplify_line
from ..operators import clean, graph, routing_tables, simplify, validate, weights
from ..schema import MIN_DRAINAGE_AREA_M2
from ..session import scratch, shared_folder, ship_package
from ..sources.header_numbers import header_numbers
from . import fixtures, jobs
from .master import Network, Options, dissolved, prepare, region_master


def _digits(value: Column, n: int) -> Column:
    """Rounded half to even at ``n`` digits, as the SQL does."""
    return F.rint(value * 10**n) / 10**n


def _repaired(spark: SparkSession, d: str) -> DataFrame:
    streams = fixtures.streams(spark, d).drop("geometry")
    return scratch(clean.repair_zero_length(streams, clean.zero_length_classes(streams)), "repaired")


def _dissolved(spark: SparkSession, d: str, order: int) -> tuple[DataFrame, Network]:
    """(network without small watersheds, dissolved for orders 2 to ``order``; all that is known of it)."""
    net = prepare(fixtures.streams(spark, d))
    return dissolved(net, order, MIN_DRAINAGE_AREA_M2)[0], net


def _prune_pairs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    network, net = _dissolved(spark, d, 2)
    network = scratch(network, "dissolved")
    return network, simplify.prune_pairs(network, net.graph, net.lines_of(2))


def _pruned(spark: SparkSession, d: str) -> DataFrame:
    return simplify.prune_branches(*_prune_pairs(spark, d))


def _routed(spark: SparkSession, d: str) -> DataFrame:
    return scratch(routing_tables.muskingum(_pruned(spark, d), fixtures.lakes(spark, d)), "routed")


def _masters(spark: SparkSession, d: str) -> DataFrame:
    """Master rows without simplification: repaired, ordered, routed, labelled."""
    network = scratch(routing_tables.muskingum(prepare(fixtures.streams(spark, d)).table, fixtures.lakes(spark, d)), "routed")
    return routing_tables.label_by_root(network)


def global_ids(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.streams(spark, d).select("LINKNO", "DSLINKNO", "strmOrder", "TDXHydroRegion")


def zero_length_classes(spark: SparkSession, d: str) -> DataFrame:
    return clean.zero_length_classes(fixtures.streams(spark, d))


def zero_length_repair(spark: SparkSession, d: str) -> DataFrame:
    return _repaired(spark, d).select("LINKNO", "DSLINKNO")


def basins_repaired(spark: SparkSession, d: str) -> DataFrame:
    streams = fixtures.streams(spark, d)
    classes = clean.zero_length_classes(streams)
    small = clean.small_watersheds(clean.repair_zero_length(streams.drop("geometry"), classes))
    kept = clean.repair_basins(fixtures.basins(spark, d), classes, small, clean.zero_id_centroid(streams))
    return kept.select("LINKNO")


def topological_order(spark: SparkSession, d: str) -> DataFrame:
    return clean.topological_order(_repaired(spark, d)).select("TDXHydroRegion", "LINKNO", "TopologicalOrder")


def ancestor_pairs(spark: SparkSession, d: str) -> DataFrame:
    return graph.ancestor_pairs(_repaired(spark, d))


def small_watersheds_dropped(spark: SparkSession, d: str) -> DataFrame:
    return _dissolved(spark, d, 1)[0].select("LINKNO", "DSLINKNO", "TopologicalOrder")


def headwater_candidates_o2(spark: SparkSession, d: str) -> DataFrame:
    network, net = _dissolved(spark, d, 1)
    return simplify.headwater_candidates(network, net.graph, 2)


def headwater_candidates_o3(spark: SparkSession, d: str) -> DataFrame:
    network, net = _dissolved(spark, d, 2)
    return simplify.headwater_candidates(network, net.graph, 3)


def _shape(spark: SparkSession, d: str, order: int) -> DataFrame:
    """The dissolved network with the number of lines each segment has then."""
    network, net = _dissolved(spark, d, order)
    lines = net.lines_of(order).groupBy("LINKNO").agg(F.sum(F.size("geometry")).cast("long").alias("n_lines"))
    return network.join(lines, "LINKNO").select("LINKNO", "DSLINKNO", "strmOrder", "TopologicalOrder", _digits(F.col("USContArea"), 0).alias("USContArea"), "n_lines")


def headwaters_dissolved_o2(spark: SparkSession, d: str) -> DataFrame:
    return _shape(spark, d, 2)


def headwaters_dissolved_o3(spark: SparkSession, d: str) -> DataFrame:
    return _shape(spark, d, 3)


def prune_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _prune_pairs(spark, d)[1]


def branches_pruned(spark: SparkSession, d: str) -> DataFrame:
    return _pruned(spark, d).select("LINKNO", "DSLINKNO")


def muskingum_k_x(spark: SparkSession, d: str) -> DataFrame:
    return routing_tables.muskingum(fixtures.streams(spark, d), fixtures.lakes(spark, d)).select("LINKNO", "velocity_factor", "musk_k", "musk_x")


def k_agg_helpers(spark: SparkSession, d: str) -> DataFrame:
    routed = routing_tables.muskingum(fixtures.streams(spark, d), fixtures.lakes(spark, d)).where("DSLINKNO <> -1")
    return routed.groupBy("DSLINKNO").agg(last_plus_max_of_others("musk_k", "LINKNO").alias("last_plus_max"), _digits(scaled_mean("musk_k"), 3).alias("scaled_mean"))


def short_stream_pairs(spark: SparkSession, d: str) -> DataFrame:
    return simplify.short_stream_pairs(_routed(spark, d))


def short_streams_merged(spark: SparkSession, d: str) -> DataFrame:
    network = _routed(spark, d)
    merged = simplify.merge_short_streams(network, scratch(simplify.short_stream_pairs(network), "merge"))
    return merged.select("LINKNO", "DSLINKNO", _digits(F.col("USContArea"), 0).alias("USContArea"), _digits(F.col("DSContArea"), 0).alias("DSContArea"), _digits(F.col("LengthGeodesicMeters"), 3).alias("LengthGeodesicMeters"), "musk_k")


def terminal_links(spark: SparkSession, d: str) -> DataFrame:
    return routing_tables.terminal_links(_repaired(spark, d))


def rapid_connect(spark: SparkSession, d: str) -> DataFrame:
    return routing_tables.rapid_connect(clean.topological_order(_repaired(spark, d)))


def routing_columns(spark: SparkSession, d: str) -> DataFrame:
    return routing_tables.routing_columns(_masters(spark, d))


def global_master(spark: SparkSession, d: str) -> DataFrame:
    found = routing_tables.global_master(scratch(_masters(spark, d), "masters"), fixtures.vpu(spark, d))
    return found.withColumns({c: _digits(F.col(c), 3) for c in ("USContArea", "DSContArea", "LengthGeodesicMeters")})


def missing_vpu_labels(spark: SparkSession, d: str) -> DataFrame:
    return routing_tables.missing_vpu_labels(_masters(spark, d), fixtures.vpu(spark, d, complete=False)).select("LINKNO", "TerminalLink")


def _weights(spark: SparkSession, d: str, with_npoints: bool = False) -> DataFrame:
    return weights.basin_weights(fixtures.basins(spark, d, fixtures.WIDE), fixtures.grid_axis(spark), with_npoints=with_npoints)


def _area(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in ("area_sqm", "lon", "lat")]
    return df.select(*rest, _digits(F.col("area_sqm") / 1e6, 3).alias("area_km2"), _digits(F.col("lon"), 6).alias("lon"), _digits(F.col("lat"), 6).alias("lat"))


def weights_full(spark: SparkSession, d: str) -> DataFrame:
    return _area(_weights(spark, d))


def weights_full_npoints(spark: SparkSession, d: str) -> DataFrame:
    return _area(_weights(spark, d, with_npoints=True))


def weights_simplified(spark: SparkSession, d: str) -> DataFrame:
    made = region_master(fixtures.streams(spark, d), fixtures.lakes(spark, d))
    full = scratch(_weights(spark, d), "weights")
    kept = clean.repair_basins(full, made.zero_length, made.small_trees)
    return _area(weights.simplify_weights(kept, made.dissolved, made.pruned, made.small_trees, made.merged))


def vpu_weights_subset(spark: SparkSession, d: str) -> DataFrame:
    master = routing_tables.global_master(scratch(_masters(spark, d), "masters"), fixtures.vpu(spark, d), check=False)
    return _area(routing_tables.vpu_weights(_weights(spark, d), master))


def vpu_streams_geometry(spark: SparkSession, d: str) -> DataFrame:
    master = routing_tables.global_master(scratch(_masters(spark, d), "masters"), fixtures.vpu(spark, d), check=False)
    moved = routing_tables.vpu_streams(fixtures.streams(spark, d).select("LINKNO", "geometry"), master)
    first = F.col("geometry")[0][0]
    return moved.select("LINKNO", "VPUCode", _digits(first["x"], 1).alias("x0"), _digits(first["y"], 1).alias("y0"))


def thiessen_cells(spark: SparkSession, d: str) -> DataFrame:
    cells = weights.thiessen_cells(fixtures.grid_axis(spark, 2.5))
    return cells.select("lon_index", "lat_index", *[_digits(F.col(c), 6).alias(c) for c in ("lon", "lat", "x0", "x1", "y0", "y1")])


def grid_axis_window(spark: SparkSession, d: str) -> DataFrame:
    return weights.axis_window(fixtures.grid_axis(spark), weights.total_bounds(fixtures.basins(spark, d)))


def geodesic_lengths(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    return fixtures.streams(spark, d).select("LINKNO", _digits(geodesic_length("geometry"), 3).alias("length_m"))


def line_centroids(spark: SparkSession, d: str) -> DataFrame:
    at = line_centroid(F.col("geometry"))
    return fixtures.streams(spark, d).select("LINKNO", _digits(at["x"], 6).alias("cx"), _digits(at["y"], 6).alias("cy"))


def polygon_areas(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.basins(spark, d).select("LINKNO", _digits(weights.equal_area(F.col("geometry")) / 1e6, 4).alias("area_km2"))


def simplified_lines(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    kept = simplify_line(0.05)("geometry")[0]
    slots = F.transform(kept, lambda p: F.rint(p["x"] * 100).cast("int").cast("string"))
    return fixtures.price_lines(spark, d).select("b", F.size(kept).cast("long").alias("n_points"), F.array_join(slots, " ").alias("slots"))


def multi_line_centroids(spark: SparkSession, d: str) -> DataFrame:
    """Lines of two parts, the second with two edges."""
    streams = fixtures.streams(spark, d).select("LINKNO", "geometry", F.col("geometry")[0][0].alias("p"))
    x, y = F.col("p.x"), F.col("p.y")
    at = line_centroid(F.array(F.col("geometry")[0], F.array(point(x, y), point(x + 0.02, y), point(x + 0.02, y + 0.03))))
    return streams.select("LINKNO", _digits(at["x"], 6).alias("cx"), _digits(at["y"], 6).alias("cy"))


def concave_weights(spark: SparkSession, d: str) -> DataFrame:
    return _area(weights.basin_weights(fixtures.elbow_basins(spark, d), fixtures.grid_axis(spark)))


def axis_weights(spark: SparkSession, d: str) -> DataFrame:
    return _area(weights.basin_weights_of_axes(scratch(fixtures.basins(spark, d, fixtures.WIDE), "basins"), fixtures.grid_axis(spark)))


def wrapped_axis_window(spark: SparkSession, d: str) -> DataFrame:
    return weights.axis_window(fixtures.grid_axis(spark), weights.total_bounds(fixtures.meridian_basins(spark, d)))


def zero_id_basin(spark: SparkSession, d: str) -> DataFrame:
    """Ids as the source layer has them: one is 0 and has no basin of its own."""
    streams = fixtures.raw_streams(spark, d)
    basins = fixtures.basins(spark, d).withColumn("LINKNO", F.col("LINKNO") % 10_000_000).where("LINKNO <> 0")
    classes = clean.zero_length_classes(streams.drop("geometry"))
    kept = clean.repair_basins(basins, classes, classes.select(F.col("id").alias("drop")).limit(0), clean.zero_id_centroid(streams))
    return kept.select("LINKNO", _digits(weights.equal_area(F.col("geometry")) / 1e6, 4).alias("area_km2"))


def deep_chain(spark: SparkSession, d: str) -> DataFrame:
    return graph.flow(fixtures.chain(spark, d), marks=("mark",), with_height=True)


def wide_confluence(spark: SparkSession, d: str) -> DataFrame:
    found = routing_tables.connectivity(fixtures.star(spark, d))
    return found.withColumn("UpstreamIDs", F.array_join("UpstreamIDs", ","))


def unit_files(spark: SparkSession, d: str) -> DataFrame:
    """The files of all units as they lie on disk: lines, and a hash of the content."""
    store = jobs.Store(spark, f"{shared_folder(spark)}/fluviant/units-{uuid.uuid4().hex}")
    master = scratch(routing_tables.global_master(scratch(_masters(spark, d), "masters"), fixtures.vpu(spark, d)), "global-master")
    state = jobs.export_units(spark, master, {"weight_grid.csv": scratch(_weights(spark, d), "weights")}, store)
    found = None
    for name in (*jobs.UNIT_FILES, "weight_grid.csv"):
        rows = spark.read.text([store(str(c), name) for c, valid in state.items() if valid], wholetext=True)
        code = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)/[^/]+$", 1).cast("long")
        lines = F.length("value") - F.length(F.replace("value", F.lit("\n"), F.lit("")))
        content = F.lit(None).cast("string") if name.startswith("weight_") else F.md5("value")
        part = rows.select(code.alias("VPUCode"), F.lit(name).alias("name"), lines.cast("long").alias("n_lines"), content.alias("content_md5"))
        found = part if found is None else found.unionByName(part)
    found = scratch(found, "unit-files")
    store.delete(store.root)
    return found


def short_unit_file(spark: SparkSession, d: str) -> DataFrame:
    """Units of which one file lacks some rivers: those with fewer rows are not valid."""
    rows = fixtures.vpu(spark, d).select(F.col("VPUCode").alias("unit"), "TerminalLink")
    counts = [(n, rows) for n in (*jobs.UNIT_FILES, "weight_grid.csv") if n != "k.csv"] + [("k.csv", rows.where("TerminalLink % 1000 <> 0 or unit % 2 = 0"))]
    each = [r.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(n)) for n, r in counts]
    return validate.units_valid(reduce(DataFrame.unionByName, each), jobs.UNIT_FILES)


def region_consistency(spark: SparkSession, d: str) -> DataFrame:
    master = _repaired(spark, d)
    full = fixtures.streams(spark, d)
    return validate.region_consistency(master, {"weight_all.csv": full, "weight_kept.csv": master})


def outputs_valid(spark: SparkSession, d: str) -> DataFrame:
    """Two sets of outputs: one in which all files agree, one in which two lack some rivers."""
    master = _repaired(spark, d).select("LINKNO")
    files = dict.fromkeys(jobs.UNIT_FILES, master)
    short = master.where("LINKNO % 3 <> 0")
    found = [validate.outputs_valid({**files, **fewer}, {"weight_grid.csv": w}).withColumn("outputs", F.lit(name)) for name, fewer, w in (("whole", {}, master), ("short", {"k.csv": short}, short))]
    return found[0].unionByName(found[1])


def slim_tables_present(spark: SparkSession, d: str) -> DataFrame:
    nation = spark.read.parquet(f"{d}/nation.parquet")
    full = nation.select(F.concat(F.lit("weight_"), "n_name", F.lit("_full.csv")).alias("name"))
    slim = nation.where("n_nationkey % 3 <> 0").select(F.concat(F.lit("weight_"), "n_name", F.lit(".csv")).alias("name"))
    return validate.slim_tables_present(full.unionByName(slim))


def master_pipeline(spark: SparkSession, d: str) -> DataFrame:
    made = region_master(fixtures.streams(spark, d), fixtures.lakes(spark, d), Options())
    t = made.table
    return t.select(
        "LINKNO", "DSLINKNO", "strmOrder", "Magnitude", "TDXHydroRegion", "TopologicalOrder", "velocity_factor", "musk_k", "musk_x", "TerminalLink",
        *[_digits(F.col(c), 3).alias(c) for c in ("USContArea", "DSContArea", "LengthGeodesicMeters")],
    )


QUERIES = {
    f.__name__: f
    for f in (
        global_ids, zero_length_classes, zero_length_repair, basins_repaired, topological_order, ancestor_pairs, small_watersheds_dropped,
        headwater_candidates_o2, headwater_candidates_o3, headwaters_dissolved_o2, headwaters_dissolved_o3, prune_pairs, branches_pruned,
        muskingum_k_x, k_agg_helpers, short_stream_pairs, short_streams_merged, terminal_links, rapid_connect, routing_columns,
        global_master, missing_vpu_labels, vpu_weights_subset, vpu_streams_geometry, thiessen_cells, grid_axis_window,
        weights_full, weights_full_npoints, weights_simplified, geodesic_lengths, line_centroids, polygon_areas, simplified_lines,
        region_consistency, outputs_valid, slim_tables_present, master_pipeline,
        multi_line_centroids, concave_weights, axis_weights, wrapped_axis_window, zero_id_basin, deep_chain, wide_confluence, unit_files, short_unit_file,
    )
}

__all__ = ["QUERIES", "header_numbers"]
