"""Sources and sinks: round trips and the jobs that use them."""

import json
import sqlite3
import struct
from types import SimpleNamespace

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fluviant.operators import ingest
from fluviant.plans import fixtures, jobs
from fluviant.plans.master import Options, region_master
from fluviant.schema import GEOMETRY
from fluviant.sources import files, geopackage, wkb
from fluviant.sources.header_numbers import header_numbers

LINE = [[(0.0, 1.0), (2.0, 3.0)]]
TWO = [[(0.0, 1.0), (2.0, 3.0)], [(2.0, 3.0), (4.0, 5.0), (6.0, 7.0)]]
RINGS = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]


@pytest.mark.parametrize(("parts", "polygon"), [(LINE, False), (TWO, False), (RINGS, True)])
def test_wkb_round_trip(parts, polygon):
    assert wkb.decode(wkb.encode(parts, polygon)) == parts


def test_wkb_of_other_orders_dimensions_and_kinds():
    big = struct.pack(">BII", 0, 2, 2) + struct.pack(">4d", 0, 1, 2, 3)
    assert wkb.decode(big) == LINE
    with_z = struct.pack("<BII", 1, 1002, 2) + struct.pack("<6d", 0, 1, 9, 2, 3, 9)
    assert wkb.decode(with_z) == LINE
    with_srid = struct.pack("<BIII", 1, 0x20000002, 4326, 2) + struct.pack("<4d", 0, 1, 2, 3)
    assert wkb.decode(with_srid) == LINE
    assert wkb.decode(struct.pack("<BI2d", 1, 1, 0, 0)) is None and wkb.decode(b"") is None


def geometry_frame(spark, rows):
    data = [(i, None if g is None else [[{"x": x, "y": y} for x, y in part] for part in g]) for i, g in rows]
    return spark.createDataFrame(data, f"LINKNO long, geometry {GEOMETRY}")


def points(row):
    return None if row is None else [[(p["x"], p["y"]) for p in part] for part in row]


def test_geoparquet_round_trip_and_footer(spark, tmp_path):
    path = str(tmp_path / "lines")
    files.write_geoparquet(geometry_frame(spark, [(1, LINE), (2, TWO), (3, None)]).coalesce(1), path)
    found = {r["LINKNO"]: points(r["geometry"]) for r in files.read_geoparquet(spark, path).collect()}
    assert found == {1: LINE, 2: TWO, 3: None}
    written = list((tmp_path / "lines").glob("*.parquet"))
    assert all(json.loads(pq.read_schema(f).metadata[b"geo"])["primary_column"] == "geometry" for f in written)
    assert sum(pq.read_table(f).num_rows for f in written) == 3 and not list((tmp_path / "lines").glob("_*.geo"))
    assert files.add_geo_footers(spark, path) == len(written)  # a second time changes nothing
    files.write_geoparquet(geometry_frame(spark, [(i, LINE) for i in range(9)]).withColumn("u", F.col("LINKNO") % 2), path + "2", partition_by="u")
    parts = list((tmp_path / "lines2").rglob("*.parquet"))
    assert len(parts) >= 2 and all(b"geo" in pq.read_schema(f).metadata for f in parts) and files.read_geoparquet(spark, path + "2").count() == 9


def test_geopackage_round_trip(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "a.gpkg")
    rows = geometry_frame(spark, [(i, TWO if i % 2 else LINE) for i in range(25)]).withColumns({"name": F.lit("x"), "len": F.lit(1.5)})
    assert geopackage.write_geopackage(rows, path, "streams") == 25
    found = geopackage.read_geopackage(spark, path, "streams")
    assert dict(found.dtypes)["LINKNO"] == "bigint" and dict(found.dtypes)["len"] == "double"
    assert {r["LINKNO"]: points(r["geometry"]) for r in found.collect()} == {i: TWO if i % 2 else LINE for i in range(25)}
    with sqlite3.connect(path) as c:
        assert c.execute("PRAGMA application_id").fetchone()[0] == 1196444487
    with pytest.raises(Exception, match="no layer"):
        geopackage.read_geopackage(spark, path, "other")


def test_geopackage_reads_ranges_of_rows(tmp_path, spark, monkeypatch):
    path = str(tmp_path / "b.gpkg")
    geopackage.write_geopackage(geometry_frame(spark, [(i, LINE) for i in range(10)]), path, "s")
    monkeypatch.setattr(geopackage, "ROWS_PER_TASK", 3)
    reader = geopackage._Reader(path, None, ["LINKNO", "geom"])
    parts = reader.partitions()
    assert len(parts) == 4 and sorted(r[0] for p in parts for r in reader.read(p)) == list(range(10))


def test_tables(spark, tmp_path):
    (tmp_path / "lakes.csv").write_text("a,b\n1,2\n3,\n1,4\n")
    assert {r[0] for r in files.read_lake_table(spark, str(tmp_path / "lakes.csv")).collect()} == {1, 2, 3, 4}
    (tmp_path / "headers.json").write_text('{\n "1020000010": "11",\n "5": "99"\n}')
    assert {tuple(r) for r in files.read_headers(spark, str(tmp_path / "headers.json")).collect()} == {("1020000010", 11), ("5", 99)}
    (tmp_path / "vpu.csv").write_text("TerminalLink,VPUCode\n7,101\n")
    assert files.read_table(spark, str(tmp_path / "vpu.csv"), "TerminalLink long, VPUCode long").first()["VPUCode"] == 101


def test_global_ids_and_unknown_regions(spark):
    layer = spark.createDataFrame([(5, -1, "1020000010"), (6, 5, "9020000010")], "LINKNO int, DSLINKNO int, TDXHydroRegion string")
    found = {tuple(r)[:2] for r in ingest.globalize(layer, header_numbers(spark)).collect()}
    assert found == {(110_000_005, -1), (910_000_006, 910_000_005)}
    with pytest.raises(Exception, match="no header number"):
        ingest.globalize(layer.withColumn("TDXHydroRegion", F.lit("1")), header_numbers(spark)).collect()


def test_region_is_taken_from_the_name():
    assert jobs.region_of("/a/streamnet_1020000010_01.gpkg") == "1020000010"
    with pytest.raises(ValueError, match="no region"):
        jobs.region_of("streams_7.gpkg")


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("orders"))
    spark.range(80).select(F.col("id").alias("o_orderkey"), (F.lit(50_000.0) + F.col("id") * 3000).alias("o_totalprice")).write.parquet(f"{d}/orders.parquet")
    return d


def test_ingest_skips_what_exists(spark, orders, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    layer = fixtures.raw_streams(spark, orders).where("TDXHydroRegion = '1020000010'").drop("TDXHydroRegion", "LengthGeodesicMeters")
    layers = {"streamnet_1020000010_01.gpkg": layer}
    assert jobs.ingest_layers(layers, header_numbers(spark), store, "streams") == ["1020000010"]
    assert jobs.ingest_layers(layers, header_numbers(spark), store, "streams") == []
    written = files.read_geoparquet(spark, store("streams", "region=1020000010"))
    assert written.count() == 40 and written.agg(F.min("LengthGeodesicMeters")).first()[0] == 0.01


def test_units_are_staged_checked_and_kept(spark, orders, tmp_path):
    streams, lakes = fixtures.streams(spark, orders), fixtures.lakes(spark, orders)
    made = region_master(streams, lakes, Options())
    store = jobs.Store(spark, str(tmp_path))
    jobs.write_master(made, store, "group=0")
    assert {"master", "altered_network", "mod_drop_small_trees", "mod_dissolve_headwater_2"} <= set(store.names(store("group=0")))
    full, slim = jobs.build_weights(made, fixtures.basins(spark, orders), fixtures.grid_axis(spark))
    assert full.count() >= slim.count() > 0
    master = jobs.routing_tables.global_master(spark.read.parquet(store("group=0", "master")).withColumn("TDXHydroRegion", F.col("TDXHydroRegion").cast("string")), fixtures.vpu(spark, orders))
    ids = slim.select("LINKNO").distinct()
    units = jobs.Store(spark, str(tmp_path / "units"))
    consistent = master.join(ids, "LINKNO", "left_semi")
    state = jobs.export_units(spark, consistent, {"weight_grid.csv": slim}, units)
    assert state and all(state.values())
    code = next(iter(state))
    connect = spark.read.csv(units(str(code), "rapid_connect.csv"))
    rivers = [r[0] for r in spark.read.csv(units(str(code), "riv_bas_id.csv")).collect()]
    assert [r[0] for r in connect.collect()] == rivers
    import os

    assert sorted(os.listdir(units.root)) == sorted(map(str, state)) and all(os.path.isfile(units(str(c), n)) for c in state for n in (*jobs.UNIT_FILES, "weight_grid.csv"))
    for c in state:
        unit = consistent.where(F.col("VPUCode") == c).orderBy("TopologicalOrder", "LINKNO").collect()
        lines = [x.split(",") for x in open(units(str(c), "rapid_connect.csv")).read().splitlines()]
        assert [int(x[0]) for x in lines] == [r["LINKNO"] for r in unit] and len({len(x) for x in lines}) == 1
        ups = {r["LINKNO"]: [u["LINKNO"] for u in unit if u["DSLINKNO"] == r["LINKNO"]] for r in unit}
        assert all([int(v) for v in x[3:]] == ups[int(x[0])] + [0] * (len(x) - 3 - len(ups[int(x[0])])) for x in lines)
        assert [int(x) for x in open(units(str(c), "k.csv")).read().split()] == [r["musk_k"] for r in unit]
        assert open(units(str(c), "comid_lat_lon_z.csv")).readline().strip() == "LINKNO,lat,lon,z"
        rows = [x.split(",") for x in open(units(str(c), "weight_grid.csv")).read().splitlines()]
        at = rows[0].index("area_sqm")
        keys = [(int(x[0]), -float(x[at])) for x in rows[1:]]
        assert keys == sorted(keys) and {k for k, _ in keys} == {r["LINKNO"] for r in unit}
    assert jobs.export_units(spark, consistent, {"weight_grid.csv": slim}, units) == state
    # a unit whose file has lost a row is made anew, the others are left alone
    stamp = {c: os.stat(units(str(c), "x.csv")).st_mtime_ns for c in state}
    kept = open(units(str(code), "k.csv")).read()
    open(units(str(code), "k.csv"), "w").write(kept.split("\n", 1)[1])
    os.path.exists(units(str(code), ".k.csv.crc")) and os.remove(units(str(code), ".k.csv.crc"))
    assert jobs.export_units(spark, consistent, {"weight_grid.csv": slim}, units) == state
    assert open(units(str(code), "k.csv")).read() == kept
    assert all((os.stat(units(str(c), "x.csv")).st_mtime_ns == stamp[c]) == (c != code) for c in state)
    # packages of units, in Mercator metres, one layer each
    packages = jobs.Store(spark, str(tmp_path / "gpkg"))
    assert jobs.export_units(spark, consistent, {"weight_grid.csv": slim}, units, made.lines, packages) == state
    assert packages.names(packages.root) == [f"streams_{c}.gpkg" for c in sorted(state)]
    layer = geopackage.read_geopackage(spark, packages(f"streams_{code}.gpkg"), f"streams_{code}")
    assert layer.count() == consistent.where(F.col("VPUCode") == code).count() and {"musk_k", "TerminalLink"} <= set(layer.columns)
    assert layer.agg(F.min(F.col("geometry")[0][0]["x"])).first()[0] < -1e7
    # a unit without weights is not valid and leaves nothing behind
    bare = jobs.Store(spark, str(tmp_path / "bare"))
    assert not any(jobs.export_units(spark, consistent, {}, bare).values()) and bare.names(bare.root) == []
    jobs.final_streams(spark, [store("group=0", "altered_network")], master.drop("TDXHydroRegion"), str(tmp_path / "final"))
    assert files.read_geoparquet(spark, str(tmp_path / "final")).count() == master.count()
    lists = jobs.dissolve_lists(made.dissolved).collect()
    assert all(r["upstream"] for r in lists)
    final = jobs.Store(spark, str(tmp_path / "final"))
    simplified = str(tmp_path / "simple")
    assert jobs.simplify_streams(spark, final, simplified, 0.1) == [n for n in final.names(final.root) if n != "_SUCCESS"] != []
    assert files.read_geoparquet(spark, simplified).count() == master.count()


def test_workflow_from_tables_to_units(spark, orders, tmp_path, monkeypatch):
    store = jobs.Store(spark, str(tmp_path))
    table = spark.createDataFrame(
        [(int(r), True, True, True, True, True, 200.0, k) for r, k in (("1020000010", 3), ("1020011530", 2))],
        "region_number long, process boolean, drop_small_watersheds boolean, dissolve_headwaters boolean, prune_main_stems boolean, merge_short_streams boolean, min_area_km2 double, min_stream_order int",
    )
    given = (fixtures.streams(spark, orders), fixtures.basins(spark, orders), fixtures.lakes(spark, orders), table, fixtures.vpu(spark, orders), {"grid": fixtures.grid_axis(spark)})
    state = jobs.workflow(spark, *given, store)
    assert state and all(isinstance(v, bool) for v in state.values())
    groups = [n for n in store.names(store.root) if n.startswith("group=")]
    assert len(groups) == 2 and not [n for n in store.names(store.root) if "staged" in n]
    for g in groups:
        made = jobs.read_master(spark, store, g)
        assert {"LINKNO", "TerminalLink", "musk_k"} <= set(made.table.columns) and made.pruned is not None
    assert {"final_streams", "global_master", "streams", "units"} <= set(store.names(store.root))
    assert len(store.names(store("streams"))) == sum(state.values())
    weights = {n for g in groups for n in store.names(store(g)) if n.startswith("weight")}
    assert weights == {"weight_grid.csv", "weight_grid_full.csv"}
    some = jobs.read_weights(spark, *[store(g, "weight_grid.csv") for g in groups])
    assert some.where("area_sqm is null or lat is null").isEmpty() and some.count() > 0
    # a second run computes no master again
    monkeypatch.setattr(jobs, "run_groups", lambda streams, lakes, groups: ({}, {}) if not groups else pytest.fail("computed again"))
    assert jobs.workflow(spark, *given, store) == state


def test_missing_labels_are_written_before_the_error(spark, tmp_path):
    masters = spark.createDataFrame([(1, 7, "a"), (2, 7, "a"), (3, 8, "a")], "LINKNO long, TerminalLink long, TDXHydroRegion string")
    store = jobs.Store(spark, str(tmp_path))
    with pytest.raises(jobs.routing_tables.MissingLabelError, match="missing_vpu_label.csv"):
        jobs.checked_global_master(masters, spark.createDataFrame([(8, 101)], "TerminalLink long, VPUCode long"), store)
    assert (tmp_path / "missing_vpu_label.csv").read_text().splitlines() == ["LINKNO,TerminalLink,TDXHydroRegion", "1,7,a", "2,7,a"]


def netcdf(variables, version=1, dims=None):
    """A classic file with one-dimensional variables: name -> (type, values)."""
    size, begin = (">q" if version == 5 else ">i"), (">i" if version == 1 else ">q")

    def name(text):
        raw = text.encode()
        return struct.pack(size, len(raw)) + raw + b"\0" * (-len(raw) % 4)

    kinds = {4: ">i4", 5: ">f4", 6: ">f8", 3: ">i2"}
    head = b"CDF" + bytes([version]) + struct.pack(size, 0) + struct.pack(">i", 10) + struct.pack(size, len(variables))
    head += b"".join(name(n) + struct.pack(size, len(v)) for n, (_, v) in variables.items())
    head += struct.pack(">i", 12) + struct.pack(size, 1) + name("title") + struct.pack(">i", 2) + struct.pack(size, 5) + b"grid!\0\0\0"
    head += struct.pack(">i", 11) + struct.pack(size, len(variables))
    entries, data = [], b""
    for i, (n, (kind, values)) in enumerate(variables.items()):
        raw = np.asarray(values, kinds[kind]).tobytes()
        entries.append((name(n) + struct.pack(size, 1) + struct.pack(size, i) + struct.pack(">i", 0) + struct.pack(size, 0) + struct.pack(">i", kind) + struct.pack(size, len(raw)), len(data)))
        data += raw + b"\0" * (-len(raw) % 4)
    total = len(head) + sum(len(e) + struct.calcsize(begin) for e, _ in entries)
    return head + b"".join(e + struct.pack(begin, total + at) for e, at in entries) + data


@pytest.mark.parametrize("version", [1, 2, 5])
def test_netcdf_axes(spark, tmp_path, version):
    from fluviant.sources import netcdf as reader

    content = netcdf({"time": (3, [7]), "longitude": (5, [0.0, 90.0, 270.5]), "lat": (6, [10.25, -10.0])}, version)
    (tmp_path / "era_1.nc").write_bytes(content)
    assert reader.axis_values(content, ("lon", "longitude")) == [0.0, 90.0, 270.5]
    rows = [(r["axis"], r["idx"], r["coord"]) for r in reader.read_netcdf_axes(spark, str(tmp_path / "era_1.nc")).collect()]
    assert sorted(rows) == [("lat", 0, 10.25), ("lat", 1, -10.0), ("lon", 0, 0.0), ("lon", 1, 90.0), ("lon", 2, 270.5)]
    with pytest.raises(ValueError, match="no variable"):
        reader.axis_values(netcdf({"x": (6, [1.0])}, version), reader.ALIASES["lat"])
    with pytest.raises(ValueError, match="format 4"):
        reader.axis_values(b"\x89HDF\r\n", reader.ALIASES["lat"])


def test_grids_from_samples(spark, tmp_path):
    for n in (10, 9):
        (tmp_path / f"era_{n}.nc").write_bytes(netcdf({"lon": (6, [0.0, 1.0, 359.0]), "latitude": (6, [1.0, 0.0][: n - 8] or [1.0])}))
    store = jobs.Store(spark, str(tmp_path / "grids"))
    axes = jobs.grids_from_samples(spark, [str(tmp_path / f"era_{n}.nc") for n in (10, 9)], store)
    assert list(axes) == ["era_9", "era_10"] and store.names(store.root) == ["era_9_thiessen_grid.parquet", "era_10_thiessen_grid.parquet"]
    cells = spark.read.parquet(store("era_10_thiessen_grid.parquet"))
    assert cells.count() == 6 and {r[0] for r in cells.select("lon_index").distinct().collect()} == {0, 1, 2}
    assert jobs.grids_from_samples(spark, [str(tmp_path / "era_9.nc")], store)["era_9"].count() == 4


def test_names_are_sorted_by_their_numbers():
    assert sorted(["u_10", "u_9", "a", "u_9b", "10", "9"], key=jobs.natural) == ["9", "10", "a", "u_9", "u_9b", "u_10"]


def test_option_sheets(spark, tmp_path):
    import zipfile

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rows = [
        '<c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="inlineStr"><is><t>note</t></is></c>',
        '<c r="A2"><v>1020000010</v></c><c r="B2" t="b"><v>1</v></c><c r="D2" t="str"><v>x</v></c>',
        '<c r="A3"><v>5</v></c><c r="B3" t="b"><v>0</v></c>',
    ]
    with zipfile.ZipFile(tmp_path / "o.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>region_number</t></si><si><r><t>pro</t></r><r><t>cess</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>" + "".join(f"<row>{r}</row>" for r in rows) + "</sheetData></worksheet>")
    found = files.read_table(spark, str(tmp_path / "o.xlsx"), "region_number long, process boolean, note string, absent double")
    assert [tuple(r) for r in found.collect()] == [(1020000010, True, "x", None), (5, False, None, None)]
    with pytest.raises(ValueError, match="schema"):
        files.read_table(spark, str(tmp_path / "o.xlsx"))


def test_single_csv_is_a_file(spark, tmp_path):
    path = tmp_path / "a.csv"
    files.write_single_csv(spark.createDataFrame([(2, "b"), (1, "a")], "i int, s string"), str(path), ["i"])
    assert path.is_file() and path.read_text().splitlines() == ["i,s", "1,a", "2,b"] and not (tmp_path / "a.csv.parts").exists()
    files.write_single_csv(spark.createDataFrame([], "i int"), str(path), header=False)
    assert path.is_file() and path.read_text() == ""


def test_tables_are_released_and_clusters_need_a_shared_folder(spark):
    from fluviant import session

    before = session.written_tables(spark)
    a, b = session.scratch(spark.range(3), "a"), session.scratch(spark.range(4), "b")
    session.release(spark, before, b)
    assert session.written_tables(spark) == [*before, b._fluviant_path] and b.count() == 4
    with pytest.raises(Exception):
        a.count()
    session.discard(b)
    assert session.written_tables(spark) == before
    assert session.shared_folder(spark)  # named by the session
    undefined = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(master="spark://host", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: undefined)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=context))


def test_weight_file_order(spark, tmp_path):
    rows = spark.createDataFrame([(2, 1.0), (1, 5.0), (1, 7.0)], "LINKNO long, area_sqm double")
    for full, expected in ((True, [5.0, 7.0, 1.0]), (False, [7.0, 5.0, 1.0])):
        path = str(tmp_path / f"w{full}.csv")
        jobs.write_weights(rows.coalesce(1), path, full)
        assert [r["area_sqm"] for r in spark.read.csv(path, header=True, schema=rows.schema).orderBy("LINKNO", F.col("area_sqm") if full else F.desc("area_sqm")).collect()] == expected
