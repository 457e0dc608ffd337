"""The jobs of the workflow, from source layers to units on disk.

Each job skips what exists, writes to a staging folder and promotes it only once it
is valid, so that a failed run leaves nothing half written behind.
"""

from __future__ import annotations

import hashlib
import logging
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.simplify import simplify_line
from ..operators import clean, ingest, routing_tables, validate, weights
from ..schema import GEOMETRY, OUTLET, WEIGHT_SCHEMA
from ..session import scratch
from ..sources.files import read_geoparquet, write_geoparquet, write_single_csv
from ..sources.geopackage import unit_packages
from ..sources.netcdf import read_netcdf_axes
from .master import Master, Options, options_by_region, run_groups

log = logging.getLogger(__name__)

#: The files of a unit that must have a row for each river.
UNIT_FILES = ("rapid_connect.csv", "riv_bas_id.csv", "comid_lat_lon_z.csv", "k.csv", "x.csv")


def natural(name: str) -> list:
    """A key by which ``unit_9`` comes before ``unit_10``."""
    return [(0, int(p), "") if p.isdigit() else (1, 0, p) for p in re.split(r"(\d+)", name) if p]


class Store:
    """Paths on any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def __call__(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def _at(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self._conf), at

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def names(self, path: str) -> list[str]:
        """What a folder holds, numbers in names by their value."""
        fs, at = self._at(path)
        found = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(found, key=natural)

    def write(self, path: str, content: bytes) -> None:
        fs, at = self._at(path)
        out = fs.create(at, True)
        try:
            for k in range(0, len(content), 1 << 20):
                out.write(bytearray(content[k : k + (1 << 20)]))
        finally:
            out.close()

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def promote(self, staged: str, path: str) -> None:
        """Move a finished folder to its place."""
        fs, at = self._at(path)
        fs.delete(at, True)
        fs.mkdirs(at.getParent())
        if not fs.rename(self._jvm.org.apache.hadoop.fs.Path(staged), at):
            raise OSError(f"could not move {staged}")


def region_of(path: str) -> str:
    """The region number in a layer's name, e.g. ``streamnet_1020000010_01.gpkg``."""
    numbers = re.findall(r"\d{6,}", path.rsplit("/", 1)[-1])
    if len(numbers) != 1:
        raise ValueError(f"no region number in {path}")
    return numbers[0]


def ingest_layers(layers: dict[str, DataFrame], headers: DataFrame, store: Store, kind: str) -> list[str]:
    """Write the layers (by file name) as GeoParquet, one folder a region; skips what exists.

    ``kind`` is ``streams`` or ``basins``. Layers are paired with regions by number,
    never by their place in a list."""
    written = []
    for name, layer in layers.items():
        region = region_of(name)
        target = store(kind, f"region={region}")
        if store.exists(target):
            continue
        layer = layer.withColumn("TDXHydroRegion", F.lit(region))
        table = ingest.ingest_streams(layer, headers) if kind == "streams" else ingest.ingest_basins(layer, headers)
        write_geoparquet(table, target + ".staged", polygon=kind == "basins")
        store.promote(target + ".staged", target)
        written.append(region)
    return written


def write_master(made: Master, store: Store, group: str) -> None:
    """The master tables by region, the altered lines, and the change logs of one group."""
    made.table.write.mode("overwrite").partitionBy("TDXHydroRegion").parquet(store(group, "master"))
    lines = made.lines.join(made.table.select("LINKNO", "TDXHydroRegion"), "LINKNO").select("LINKNO", "TDXHydroRegion", "geometry")
    write_geoparquet(lines, store(group, "altered_network"), partition_by="TDXHydroRegion")
    logs = {"mod_zero_length_streams": made.zero_length, "mod_basin_zero_centroid": made.zero_centroid, "mod_drop_small_trees": made.small_trees, "mod_prune_streams": made.pruned, "mod_merge_short_streams": made.merged}
    for name, rows in logs.items():
        if rows is not None:
            rows.write.mode("overwrite").parquet(store(group, name))
    for k, rows in enumerate(made.dissolved, 2):
        rows.write.mode("overwrite").parquet(store(group, f"mod_dissolve_headwater_{k}"))


def dissolve_lists(passes: list[DataFrame]) -> DataFrame:
    """``LINKNO, upstream``: each dissolving segment and all it absorbed, as the wide logs have it."""
    pairs = reduce(DataFrame.unionByName, passes)
    return pairs.groupBy(F.col("keep").alias("LINKNO")).agg(F.sort_array(F.collect_set("drop")).alias("upstream"))


def read_master(spark: SparkSession, store: Store, group: str) -> Master:
    """The master and the change logs of a group as they were written."""

    def table(name: str) -> DataFrame | None:
        return spark.read.parquet(store(group, name)) if store.exists(store(group, name)) else None

    def by_region(name: str) -> DataFrame:  # region numbers are strings, also as parts of paths
        rows = spark.read.parquet(store(group, name))
        return rows.withColumn("TDXHydroRegion", F.col("TDXHydroRegion").cast("string"))

    dissolved = [table(f"mod_dissolve_headwater_{k}") for k in (2, 3)]
    return Master(
        by_region("master"), table("mod_zero_length_streams"), table("mod_basin_zero_centroid"), table("mod_drop_small_trees"),
        [d for d in dissolved if d is not None], table("mod_prune_streams"), table("mod_merge_short_streams"),
    )


def group_name(options: Options, regions: list[str]) -> str:
    """A folder name that changes with the options and with the regions they are for."""
    return "group=" + hashlib.md5(repr((options, sorted(regions))).encode()).hexdigest()[:12]


def build_masters(spark: SparkSession, streams: DataFrame, lakes: DataFrame, options: DataFrame, store: Store) -> tuple[list[str], dict[Options, Exception]]:
    """Write the masters of all regions to process; (groups on disk, failures).

    A group that is written already, with the same options and regions, is skipped;
    another is staged and promoted once complete."""
    groups = options_by_region(options)
    names = {o: group_name(o, regions) for o, regions in groups.items()}
    missing = {o: regions for o, regions in groups.items() if not store.exists(store(names[o]))}
    done, failed = run_groups(streams, lakes, missing)
    for o, made in done.items():
        staged = "staged_" + names[o]
        try:
            store.delete(store(staged))
            write_master(made, store, staged)
            store.promote(store(staged), store(names[o]))
        except Exception as e:  # noqa: BLE001 - one group's failure must not stop the rest
            log.exception("group %s failed", names[o])
            failed[o] = e
    return [n for n in names.values() if store.exists(store(n))], failed


def build_weights(made: Master, basins: DataFrame, axis: DataFrame, with_npoints: bool = False) -> tuple[DataFrame, DataFrame]:
    """(full weights, weights after the network's changes) of repaired basins and a grid."""
    empty = made.zero_length.select(F.col("id").alias("drop")).limit(0)
    drop = made.small_trees if made.small_trees is not None else empty
    kept = clean.repair_basins(basins, made.zero_length, drop, made.zero_centroid)
    full = scratch(weights.basin_weights(kept, axis, with_npoints=with_npoints), "weights-full")
    nothing = made.zero_length.select(F.col("id").alias("LINKNO"), F.col("id").alias("LINKTODROP"), F.col("id").alias("MergeWith")).limit(0)
    slim = weights.simplify_weights(full, made.dissolved, made.pruned if made.pruned is not None else nothing.select("LINKNO", "LINKTODROP"), drop, made.merged if made.merged is not None else nothing.select("LINKNO", "MergeWith"))
    return full, slim


def weight_order(full: bool, id_col: str = "LINKNO") -> list[Column]:
    """The customary order of a weight table: ids ascending, areas ascending if full, else descending."""
    return [F.col(id_col).asc(), F.col("area_sqm").asc() if full else F.col("area_sqm").desc()]


def write_weights(rows: DataFrame, path: str, full: bool, id_col: str = "LINKNO") -> None:
    """A weight table as CSV, in its customary order of columns, and of rows over all files
    of the folder."""
    first = [c.split()[0] for c in WEIGHT_SCHEMA.split(", ")]
    columns = [c for c in first if c in rows.columns] + [c for c in rows.columns if c not in first]
    rows.orderBy(*weight_order(full, id_col)).select(*columns).write.mode("overwrite").csv(path, header=True)


def read_weights(spark: SparkSession, *paths: str) -> DataFrame:
    """Weight tables as ``write_weights`` leaves them."""
    return spark.read.csv(list(paths), header=True, schema=WEIGHT_SCHEMA)


def unit_files(unit_rows: DataFrame, weight_tables: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, bool]]:
    """(rows, has a header) of each file of all units: ``VPUCode``, the columns of the file.

    Row i of every file is the same river; weights are in their customary order. Each
    unit's rows are in one partition, in order."""
    order = ["VPUCode", "TopologicalOrder", "LINKNO"]
    connect = routing_tables.connectivity(unit_rows).join(unit_rows.select(F.col("LINKNO").alias("HydroID"), *order), "HydroID")
    width = connect.groupBy("VPUCode").agg(F.max("CountUpstreamID").alias("width"))
    ids = F.concat("UpstreamIDs", F.array_repeat(F.lit(0).cast("long"), (F.col("width") - F.col("CountUpstreamID")).cast("int")))
    line = F.concat_ws(",", "HydroID", "NextDownID", "CountUpstreamID", F.transform(ids, lambda i: i.cast("string")))
    connect = connect.join(F.broadcast(width), "VPUCode").select(*order, line.alias("value"))

    def ordered(rows: DataFrame, by: list, *columns: str) -> DataFrame:
        return rows.repartition("VPUCode").sortWithinPartitions(*by).select("VPUCode", *columns)

    columns = routing_tables.routing_columns(unit_rows).join(unit_rows.select("LINKNO", "VPUCode"), "LINKNO")
    files = {
        "rapid_connect.csv": (ordered(connect, order, "value"), False),
        "riv_bas_id.csv": (ordered(columns, order, "LINKNO"), False),
        "k.csv": (ordered(columns, order, "musk_k"), False),
        "x.csv": (ordered(columns, order, "musk_x"), False),
        "comid_lat_lon_z.csv": (ordered(columns, order, "LINKNO", "lat", "lon", "z"), True),
    }
    for name, rows in weight_tables.items():
        own = routing_tables.vpu_weights(rows, unit_rows)
        files[name] = (ordered(own, [F.col("VPUCode").asc(), *weight_order(False)], *rows.columns), True)
    return files


def _stage(files: dict[str, tuple[DataFrame, bool]], store: Store, folder: str) -> None:
    """Write every file once for all units: ``folder/name/VPUCode=c/part``."""
    for name, (rows, header) in files.items():
        writer = rows.write.mode("overwrite").partitionBy("VPUCode")
        if rows.columns == ["VPUCode", "value"]:
            writer.text(store(folder, name))
        else:
            writer.csv(store(folder, name), header=header)


def units_valid(spark: SparkSession, files: dict[str, list[str]], code: str) -> dict[int, bool]:
    """Which units are valid, by one grouped aggregate over all files.

    ``files`` has the paths of each file name, ``code`` a pattern of the unit's code in a
    path. Valid is a unit with all files, a weight table among them, which all have a row
    for each river: as many lines, or as many ids in weight tables."""
    counts = []
    for name, paths in files.items():
        if not paths:
            continue
        unit = F.regexp_extract(F.col("_metadata.file_path"), code, 1).cast("long").alias("unit")
        if name.startswith("weight_"):
            rows = spark.read.csv(paths, header=True).select(unit, F.col("LINKNO").alias("id")).groupBy("unit").agg(F.count_distinct("id").alias("n"))
        else:
            rows = spark.read.text(paths).select(unit).groupBy("unit").agg((F.count(F.lit(1)) - int(name.startswith("comid"))).alias("n"))
        counts.append(rows.withColumn("name", F.lit(name)))
    if not counts:
        return {}
    table = reduce(DataFrame.unionByName, counts)
    return {r["unit"]: bool(r["valid"]) for r in validate.units_valid(table, UNIT_FILES).collect()}  # a row a unit


def export_units(spark: SparkSession, master: DataFrame, weight_tables: dict[str, DataFrame], store: Store, lines: DataFrame | None = None, packages: Store | None = None) -> dict[int, bool]:
    """Write the units of a global master; True for those that are valid in the end.

    Valid units on disk are kept. The files of all others are written at once, each table
    read and dealt out by unit a single time, and checked by one aggregate; then the valid
    units' files take their places, one file each, by renames. A unit that is not valid is
    logged and leaves nothing behind. With ``lines`` (``LINKNO, geometry`` in degrees) and
    ``packages`` each valid unit without one gets a GeoPackage ``streams_<code>.gpkg``, in
    Mercator metres."""
    codes = sorted(r[0] for r in master.select("VPUCode").distinct().collect())  # units number in the hundreds
    names = [*UNIT_FILES, *weight_tables]
    here = {c: set(store.names(store(str(c)))) for c in codes}
    on_disk = {n: [store(str(c), n) for c in codes if n in here[c]] for n in {*names, *(n for c in codes for n in here[c] if n.startswith("weight_") and "full" not in n)}}
    before = units_valid(spark, on_disk, r"/(\d+)/[^/]+$")
    state = {c: before.get(c, False) for c in codes}
    todo = [c for c in codes if not state[c]]
    if todo:
        staged = "_staged"
        store.delete(store(staged))
        try:
            unit_rows = scratch(master.where(F.col("VPUCode").isin(todo)), "units")
            _stage(unit_files(unit_rows, weight_tables), store, staged)
            found = units_valid(spark, {n: [store(staged, n)] for n in names}, r"/VPUCode=(\d+)/[^/]+$")
            for c in todo:
                state[c] = found.get(c, False)
                store.delete(store(str(c)))
                if not state[c]:
                    log.error("unit %s is not valid", c)
                    continue
                for n in names:
                    folder = store(staged, n, f"VPUCode={c}")
                    (part,) = [p for p in store.names(folder) if p.startswith("part-")]
                    store.promote(f"{folder}/{part}", store(str(c), n))
        finally:
            store.delete(store(staged))
    if lines is not None and packages is not None:
        missing = [c for c in codes if state[c] and not packages.exists(packages(f"streams_{c}.gpkg"))]
        if missing:
            chosen = routing_tables.vpu_streams(lines, master.where(F.col("VPUCode").isin(missing)))
            made = scratch(unit_packages(chosen, "VPUCode", "streams_", srs_id=3857), "packages")
            for row in made.toLocalIterator():  # one unit's package at a time
                target = packages(f"streams_{row['unit']}.gpkg")
                packages.write(target + ".staged", bytes(row["content"]))
                packages.promote(target + ".staged", target)
    return state


def final_streams(spark: SparkSession, line_paths: list[str], master: DataFrame, target: str) -> None:
    """Altered lines of all regions with their master columns, one folder a unit."""
    lines = read_geoparquet(spark, *line_paths).select("LINKNO", "geometry")
    write_geoparquet(lines.join(master, "LINKNO"), target, partition_by="VPUCode")


def simplify_streams(spark: SparkSession, source: Store, target: str, tolerance: float) -> list[str]:
    """Simplify the lines of all layers in a folder into one GeoParquet folder; the layers
    that were read, in natural order. A layer that is there is not made again."""
    layers = [n for n in source.names(source.root) if not n.startswith(("_", "."))]
    if layers and not source.exists(target):
        lines = read_geoparquet(spark, *[source(n) for n in layers]).withColumn("geometry", simplify_line(tolerance)("geometry"))
        write_geoparquet(lines, target + ".staged")
        source.promote(target + ".staged", target)
    return layers


def grids_from_samples(spark: SparkSession, samples: list[str], store: Store) -> dict[str, DataFrame]:
    """The axes of each sample grid, by name; their cells are written as
    ``<name>_thiessen_grid.parquet`` where they are not there yet."""
    axes = {}
    for path in sorted(samples, key=natural):
        name = re.sub(r"\.nc$", "", path.rsplit("/", 1)[-1])
        axes[name] = scratch(read_netcdf_axes(spark, path).drop("path"), "axes")
        target = store(f"{name}_thiessen_grid.parquet")
        if not store.exists(target):
            weights.thiessen_cells(axes[name]).write.mode("overwrite").parquet(target + ".staged")
            store.promote(target + ".staged", target)
    return axes


def checked_global_master(masters: DataFrame, vpu: DataFrame, store: Store) -> DataFrame:
    """The global master; rows without a unit are written to ``missing_vpu_label.csv``
    before the error is raised."""
    missing = scratch(routing_tables.missing_vpu_labels(masters, vpu), "missing-labels")
    if not missing.isEmpty():
        write_single_csv(missing, store("missing_vpu_label.csv"), ["TerminalLink", "LINKNO"])
        raise routing_tables.MissingLabelError(f"some terminal segments are not in the unit table: {store('missing_vpu_label.csv')}")
    return routing_tables.global_master(masters, vpu, check=False)


def workflow(spark: SparkSession, streams: DataFrame, basins: DataFrame, lakes: DataFrame, options: DataFrame, vpu: DataFrame, axes: dict[str, DataFrame], store: Store, basins_crs: str = "EPSG:4326") -> dict[int, bool]:
    """From stream and basin tables to processing units; True for each valid unit.

    Masters first; then, from their change logs on disk, the weights of each group and
    grid, full and slim, as CSV in their customary order; then the global master, the
    units with their packages, and the final streams. Basins in web-map metres come
    to degrees first. What exists is kept."""
    basins = weights.in_degrees(basins, basins_crs)
    groups, _ = build_masters(spark, streams, lakes, options, store)
    slim: dict[str, list[str]] = {name: [] for name in axes}
    for group in groups:
        made = read_master(spark, store, group)
        # A group's weights are those of its own basins: what it kept, and what it folded into those.
        regions = made.table.select("TDXHydroRegion").distinct()
        own = basins.join(streams.join(F.broadcast(regions), "TDXHydroRegion", "left_semi").select("LINKNO"), "LINKNO", "left_semi")
        for name, axis in axes.items():
            target = store(group, f"weight_{name}.csv")
            if not store.exists(target):
                full, few = build_weights(made, own, axis)
                write_weights(full, store(group, f"weight_{name}_full.csv"), True)
                write_weights(few, target + ".staged", False)
                store.promote(target + ".staged", target)
            slim[name].append(target)
    masters = reduce(DataFrame.unionByName, [read_master(spark, store, g).table for g in groups])
    master = scratch(checked_global_master(masters, vpu, store), "global-master")
    master.write.mode("overwrite").parquet(store("global_master"))
    tables = {f"weight_{name}.csv": read_weights(spark, *paths) for name, paths in slim.items()}
    altered = [store(g, "altered_network") for g in groups]
    lines = read_geoparquet(spark, *altered).select("LINKNO", "geometry")
    state = export_units(spark, master, tables, Store(spark, store("units")), lines, Store(spark, store("streams")))
    if not store.exists(store("final_streams")):
        final_streams(spark, altered, master.drop("TDXHydroRegion"), store("final_streams.staged"))
        store.promote(store("final_streams.staged"), store("final_streams"))
    return state


__all__ = ["GEOMETRY", "OUTLET", "Store", "ingest_layers", "build_masters", "read_master", "build_weights", "write_weights", "unit_files", "export_units", "final_streams", "simplify_streams", "grids_from_samples", "dissolve_lists", "workflow"]
