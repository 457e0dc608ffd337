"""The network operators on the 40-segment template: one block, ids as slots."""

import random

import pytest
from pyspark.sql import functions as F

from fluviant.operators import clean, graph, routing_tables, simplify
from fluviant.plans import fixtures
from fluviant.plans.master import Options, dissolved, options_by_region, prepare, region_master, run_regions
from fluviant.session import scratch

BASE = 11 * 10_000_000
CANDIDATES_2, CANDIDATES_3 = {3, 4, 16, 17, 24}, {1, 2, 15}


@pytest.fixture(scope="module")
def block(spark, tmp_path_factory):
    """One template block; lengths long enough that nothing is short."""
    d = str(tmp_path_factory.mktemp("orders"))
    spark.range(40).select(F.col("id").alias("o_orderkey"), F.lit(250_000.0).alias("o_totalprice")).write.parquet(f"{d}/orders.parquet")
    return d


@pytest.fixture(scope="module")
def cleaned(spark, block):
    """(ordered network without the trees named small in the template's golden values, graph)."""
    streams = fixtures.streams(spark, block)
    repaired = scratch(clean.repair_zero_length(streams, clean.zero_length_classes(streams)), "repaired")
    ordered = scratch(clean.topological_order(repaired), "ordered")
    areas = ordered.withColumn("DSContArea", F.when(F.col("LINKNO").isin([BASE + s for s in (34, 35, 37)]), 1e8).otherwise(F.col("DSContArea")))
    return scratch(clean.drop_segments(ordered, clean.small_watersheds(areas)), "cleaned"), repaired.select("LINKNO", "DSLINKNO")


def slots(df, column="LINKNO"):
    return {r[0] - BASE for r in df.select(column).collect()}


def pairs(df):
    return {(a - BASE, b - BASE) for a, b in df.collect()}


def test_a_short_block_is_kept_and_has_no_loose_ends(spark, block, tmp_path):
    assert fixtures.streams(spark, block).count() == 40
    for n in (3, 45, 54):
        d = str(tmp_path / str(n))
        spark.range(n).select(F.col("id").alias("o_orderkey"), F.lit(250_000.0).alias("o_totalprice")).write.parquet(f"{d}/orders.parquet")
        rows = {r["LINKNO"]: r["DSLINKNO"] for r in fixtures.streams(spark, d).collect()}
        assert len(rows) == n and all(v == -1 or v in rows for v in rows.values())


def test_zero_length_classes(spark, block):
    found = {}
    for r in clean.zero_length_classes(fixtures.streams(spark, block)).collect():
        found.setdefault(r["case"], set()).add(r["id"] - BASE)
    assert found == {1: {32}, 2: {25, 29, 30, 36}, 3: {33}}


def test_repair_rewires_past_every_bridge(spark, block):
    streams = fixtures.streams(spark, block)
    repaired = clean.repair_zero_length(streams, clean.zero_length_classes(streams))
    down = {r["LINKNO"] - BASE: r["DSLINKNO"] for r in repaired.collect()}
    assert {k: down[k] - BASE for k in (27, 28, 31)} == {27: 24, 28: 24, 31: 23}
    assert down[34] == down[35] == -1
    assert not {25, 29, 30, 32, 33, 36} & set(down)
    again = clean.repair_zero_length(repaired, clean.zero_length_classes(repaired))
    assert again.exceptAll(repaired).isEmpty() and repaired.exceptAll(again).isEmpty()


def test_order_puts_upstream_first_and_has_no_gaps(cleaned, spark, block):
    streams = fixtures.streams(spark, block)
    ordered = clean.topological_order(clean.repair_zero_length(streams, clean.zero_length_classes(streams)))
    rows = {r["LINKNO"]: r for r in ordered.collect()}
    assert sorted(r["TopologicalOrder"] for r in rows.values()) == list(range(1, len(rows) + 1))
    assert all(r["TopologicalOrder"] < rows[r["DSLINKNO"]]["TopologicalOrder"] for r in rows.values() if r["DSLINKNO"] != -1)


def test_rows_with_nulls_leave_gaps_in_the_order(spark, block):
    streams = fixtures.streams(spark, block).withColumn("Magnitude", F.when(F.col("LINKNO") != BASE + 5, F.col("Magnitude")))
    numbers = {r[0] for r in clean.topological_order(streams).select("TopologicalOrder").collect()}
    assert len(numbers) == 39 and max(numbers) == 40


def test_small_trees(cleaned):
    network, _ = cleaned
    assert not {34, 35, 37, 38, 39} & slots(network)


def test_candidates_and_survivors(cleaned):
    network, links = cleaned
    found = simplify.headwater_candidates(network, links, 2)
    assert slots(found, "id") == CANDIDATES_2
    two = scratch(simplify.dissolve_headwaters(network, simplify.headwater_labels(links, found)), "two")
    assert slots(two) == {0, 1, 2, 3, 4, 10, 11, 12, 13, 14, 15, 16, 17, 18, 23, 24, 31}
    found = simplify.headwater_candidates(two, links, 3)
    assert slots(found, "id") == CANDIDATES_3
    three = simplify.dissolve_headwaters(two, simplify.headwater_labels(links, found))
    assert slots(three) == {0, 1, 10, 15, 23, 24, 31}
    assert pairs(simplify.prune_pairs(three, links)) == {(1, 10), (24, 31)}


def test_dissolve_sums_upstream_area_and_joins_lines(cleaned):
    network, links = cleaned
    before = {r["LINKNO"] - BASE: r for r in network.collect()}
    labels = simplify.headwater_labels(links, simplify.headwater_candidates(network, links, 2))
    after = {r["LINKNO"] - BASE: r for r in simplify.dissolve_headwaters(network, labels).collect()}
    assert after[4]["USContArea"] == sum(before[s]["USContArea"] for s in (7, 8, 9))
    assert len(after[4]["geometry"]) == 4 and after[10]["USContArea"] == before[10]["USContArea"]
    assert after[4]["DSContArea"] == before[4]["DSContArea"]


@pytest.mark.parametrize(("order", "n", "highest", "n_below", "expected"), [(3, 2, 2, 2, True), (3, 2, 3, 1, False), (3, 3, 3, 0, True), (3, 3, 3, 2, False), (3, 3, 2, 2, True), (3, 3, 2, 3, True), (2, 2, 2, 2, False)])
def test_headwater_rule(spark, order, n, highest, n_below, expected):
    assert spark.range(1).select(simplify.is_headwater(F.lit(order), F.lit(n), F.lit(highest), F.lit(n_below), 3)).first()[0] is expected


def test_prune_takes_higher_order_then_nearest(cleaned):
    network, links = cleaned
    two = scratch(simplify.dissolve_headwaters(network, simplify.headwater_labels(links, simplify.headwater_candidates(network, links, 2))), "two")
    found = simplify.prune_pairs(two, links)
    assert pairs(found) == {(13, 11), (13, 12), (1, 10), (24, 31), (17, 18)}
    assert slots(simplify.prune_branches(two, found)) == {0, 1, 2, 3, 4, 13, 14, 15, 16, 17, 23, 24}


def test_prune_leaves_a_segment_without_sibling_alone(spark):
    line = "array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1D, 'y', 0D)))"
    rows = spark.sql(f"SELECT * FROM VALUES (1L, 2L, 1), (2L, -1L, 2) t(LINKNO, DSLINKNO, strmOrder)").withColumn("geometry", F.expr(line))
    assert simplify.prune_pairs(rows, rows).isEmpty()


def _network(spark, rows):
    """(id, ds, k) rows with areas, lengths and a line."""
    line = "array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1D, 'y', 0D)))"
    df = spark.createDataFrame(rows, "LINKNO long, DSLINKNO long, musk_k long")
    return df.withColumns({"USContArea": F.col("LINKNO") * 1.0, "DSContArea": F.col("LINKNO") * 10.0, "LengthGeodesicMeters": F.lit(100.0), "TopologicalOrder": F.col("LINKNO"), "geometry": F.expr(line)})


def test_short_streams_merge_into_the_smaller_k_and_chains_collapse(spark):
    # 1 -> 2 -> 3 -> 4 (a confluence of 3 and 5); all short but 4
    network = _network(spark, [(1, 2, 100), (2, 3, 200), (3, 4, 300), (5, 4, 100), (4, -1, 5000)])
    found = simplify.short_stream_pairs(network)
    assert {tuple(r) for r in found.collect()} == {(2, 1), (3, 2)}
    merged = {r["LINKNO"]: r for r in simplify.merge_short_streams(network, found).collect()}
    assert set(merged) == {3, 4, 5}
    r = merged[3]
    assert (r["USContArea"], r["DSContArea"], r["LengthGeodesicMeters"], r["musk_k"], r["DSLINKNO"], len(r["geometry"])) == (1.0, 30.0, 300.0, 300, 4, 3)


def test_short_stream_ties_go_upstream_and_outlets_merge_only_upstream(spark):
    network = _network(spark, [(1, 2, 2000), (2, 3, 100), (3, -1, 2000)])
    assert {tuple(r) for r in simplify.short_stream_pairs(network).collect()} == {(2, 1)}
    network = _network(spark, [(1, 2, 2000), (2, 3, 100), (3, -1, 1999)])
    assert {tuple(r) for r in simplify.short_stream_pairs(network).collect()} == {(3, 2)}
    network = _network(spark, [(1, -1, 100)])
    assert simplify.short_stream_pairs(network).isEmpty()


def test_connections_move_onto_the_survivor(spark):
    network = _network(spark, [(1, 3, 2000), (2, 3, 2000), (3, 4, 100), (4, -1, 2000)])
    found = simplify.short_stream_pairs(network)
    assert {tuple(r) for r in found.collect()} == {(4, 3)}
    assert {(r["LINKNO"], r["DSLINKNO"]) for r in simplify.merge_short_streams(network, found).collect()} == {(1, 4), (2, 4), (4, -1)}


def test_deep_chain_and_cycles(spark):
    n = 3000
    chain = spark.range(n).select(F.col("id").alias("LINKNO"), F.when(F.col("id") == n - 1, -1).otherwise(F.col("id") + 1).cast("long").alias("DSLINKNO"))
    roots = graph.roots(chain).select("root").distinct().collect()
    assert [r[0] for r in roots] == [n - 1]
    assert graph.heights(chain).agg(F.max("height")).first()[0] == n - 1
    circle = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "LINKNO long, DSLINKNO long")
    for question in (graph.roots, graph.heights):
        with pytest.raises(graph.CycleError):
            question(circle)


def test_one_walk_tells_what_the_steps_tell(spark, tmp_path):
    """Random trees with random orders, so that rules meet in ways no real network has."""
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        down = -1 if i < 60 or rng.random() < 0.02 else rng.randrange(max(0, i - 400), i)
        rows.append((i, down, rng.choice((1, 1, 1, 2, 2, 3)), rng.choice((1e8, 3e8)), float(rng.randint(1, 99)) if rng.random() < 0.98 else None))
    line = "array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1D, 'y', 0D)))"
    streams = spark.createDataFrame(rows, "LINKNO long, DSLINKNO long, strmOrder int, DSContArea double, USContArea double")
    streams = scratch(streams.withColumns({"LengthGeodesicMeters": F.lit(5.0), "TDXHydroRegion": (F.col("LINKNO") % 3).cast("string"), "geometry": F.expr(line)}), "random")
    net = prepare(streams)
    assert net.table.count() == sum(r[4] is not None for r in rows) < 1500
    ordered = scratch(clean.topological_order(streams.drop("geometry")), "ordered")
    columns = ["LINKNO", "TopologicalOrder"]
    assert sorted(map(tuple, net.table.select(*columns).collect())) == sorted(map(tuple, ordered.select(*columns).collect()))
    small = {r[0] for r in clean.small_watersheds(streams, 2e8).collect()}
    links = streams.select("LINKNO", "DSLINKNO")
    step = scratch(ordered.join(spark.createDataFrame([(x,) for x in small], "LINKNO long"), "LINKNO", "left_anti"), "step")
    for m in (2, 3):
        labels = simplify.headwater_labels(links, simplify.headwater_candidates(step, links, m))
        network, passes = dissolved(net, m, 2e8)
        kept = {tuple(r) for r in labels.collect()}
        assert {tuple(r) for r in passes[-1].collect()} == kept and len(kept) > 20
        step = scratch(simplify.dissolve_headwaters(step, labels), "step")
        shape = ["LINKNO", "DSLINKNO", "strmOrder", "USContArea", "DSContArea"]
        assert {tuple(r) for r in network.select(*shape).collect()} == {tuple(r) for r in step.select(*shape).collect()}


def test_flow_of_loose_ends_and_values_of_roots(spark):
    rows = spark.createDataFrame([(1, 2, True, 5.0), (2, 9, False, 6.0), (3, -1, False, 7.0), (4, 3, True, None), (5, 4, True, 8.0)], "LINKNO long, DSLINKNO long, m boolean, a double")
    found = {r["id"]: (r["root"], r["m"], r["at_m"], r["root_a"], r["height"]) for r in graph.flow(rows, ("m",), ("a",), True).collect()}
    assert found == {1: (9, 1, 0, None, 0), 2: (9, None, None, None, 1), 3: (3, None, None, 7.0, 2), 4: (3, 4, 0, 7.0, 1), 5: (3, 4, 1, 7.0, 0)}
    assert graph.flow(rows.limit(0), ("m",)).isEmpty()


def test_null_regions_are_numbered_on_their_own(spark):
    from fluviant.operators.numbering import numbered_by_group

    rows = spark.createDataFrame([("a", 3), (None, 1), ("a", 1), (None, 2), ("b", 9)], "g string, x int")
    assert {tuple(r) for r in numbered_by_group(rows, "g", ["x"], "n").collect()} == {("a", 1, 1), ("a", 3, 2), (None, 1, 1), (None, 2, 2), ("b", 9, 1)}


def test_last_marked_is_the_farthest_downstream(spark):
    chain = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, -1)], "LINKNO long, DSLINKNO long")
    marks = spark.createDataFrame([(2,), (3,)], "id long")
    assert {tuple(r) for r in graph.last_marked(chain, marks).collect()} == {(1, 3), (2, 3), (3, 3)}


def test_ancestor_pairs(spark):
    tree = spark.createDataFrame([(1, 3), (2, 3), (3, 4), (4, -1)], "LINKNO long, DSLINKNO long")
    found = {(r["LINKNO"], r["ancestor"], r["distance"]) for r in graph.ancestor_pairs(tree).collect()}
    assert found == {(3, 1, 1), (3, 2, 1), (4, 3, 1), (4, 1, 2), (4, 2, 2)}


def test_watershed_labels_and_missing_outlet(spark):
    network = _network(spark, [(1, 2, 1), (2, -1, 1), (3, -1, 1)])
    found = {(r["LINKNO"], r["TerminalLink"]) for r in routing_tables.label_watersheds(network, network.select("LINKNO", "DSLINKNO")).collect()}
    assert found == {(1, 2), (2, 2), (3, 3)}
    with pytest.raises(Exception, match="no outlet"):
        routing_tables.label_watersheds(network.where("LINKNO <> 2"), network.where("LINKNO <> 2").select("LINKNO", "DSLINKNO")).collect()


def test_rapid_connect_pads_with_zero_in_frame_order(spark):
    network = _network(spark, [(2, 9, 1), (1, 9, 1), (9, -1, 1)]).withColumn("TopologicalOrder", 10 - F.col("LINKNO"))
    rows = {r[0]: tuple(r)[1:] for r in routing_tables.rapid_connect(network).collect()}
    assert rows == {9: (-1, 2, 2, 1), 1: (9, 0, 0, 0), 2: (9, 0, 0, 0)}


def test_global_master_guards_labels(spark):
    master = spark.createDataFrame([(1, 7)], "LINKNO long, TerminalLink long")
    for c in ("DSLINKNO", "strmOrder", "USContArea", "DSContArea", "TDXHydroRegion", "TopologicalOrder", "LengthGeodesicMeters", "musk_k", "musk_x"):
        master = master.withColumn(c, F.lit(1))
    empty = spark.createDataFrame([], "TerminalLink long, VPUCode long")
    with pytest.raises(routing_tables.MissingLabelError):
        routing_tables.global_master(master, empty)
    labeled = routing_tables.global_master(master, spark.createDataFrame([(7, 101)], "TerminalLink long, VPUCode long"))
    assert labeled.columns == ["LINKNO", "DSLINKNO", "strmOrder", "USContArea", "DSContArea", "TDXHydroRegion", "VPUCode", "TopologicalOrder", "LengthGeodesicMeters", "TerminalLink", "musk_k", "musk_x"]
    assert labeled.first()["VPUCode"] == 101


def test_zero_id_gets_a_box(spark):
    line = "array(array(named_struct('x', 1D, 'y', 2D), named_struct('x', 3D, 'y', 2D)))"
    streams = spark.createDataFrame([(0, -1, 5.0)], "LINKNO long, DSLINKNO long, LengthGeodesicMeters double").withColumn("geometry", F.expr(line))
    centroid = clean.zero_id_centroid(streams)
    assert tuple(centroid.first()) == (0, 2.0, 2.0)
    basins = spark.createDataFrame([], "LINKNO long, geometry array<array<struct<x:double,y:double>>>")
    none = spark.createDataFrame([], "id long, case int")
    kept = clean.repair_basins(basins, none, none.select(F.col("id").alias("drop")), centroid).collect()
    assert len(kept) == 1 and kept[0]["geometry"][0][0]["x"] == pytest.approx(2 - 0.015)


def test_pipeline_options(spark, block):
    streams, lakes = fixtures.streams(spark, block), fixtures.lakes(spark, block)
    plain = region_master(streams, lakes, Options(drop_small_watersheds=False, dissolve_headwaters=False, prune_main_stems=False, merge_short_streams=False))
    assert plain.table.count() == 34 and plain.pruned is None and plain.dissolved == []
    full = region_master(streams, lakes, Options(min_area_m2=2e8)).table
    ids = {r["LINKNO"] for r in full.collect()}
    assert all(r["DSLINKNO"] == -1 or r["DSLINKNO"] in ids for r in full.collect())
    assert full.where("DSLINKNO = -1 and TerminalLink <> LINKNO").isEmpty()
    lake = plain.table.where(F.col("LINKNO") == BASE + 23).first()
    assert lake["musk_x"] == 0.01 and lake["musk_k"] >= 3600


def test_regions_share_runs_and_failures_stay_apart(spark, block):
    table = spark.createDataFrame(
        [(1020000010, True, True, True, True, True, True, 200.0, 3), (1020011530, True, True, True, True, True, True, 200.0, 3), (2020000010, False, True, True, True, True, True, 1.0, 2)],
        "region_number long, process boolean, fix_taudem_errors boolean, drop_small_watersheds boolean, dissolve_headwaters boolean, prune_main_stems boolean, merge_short_streams boolean, min_area_km2 double, min_stream_order int",
    )
    groups = options_by_region(table)
    assert list(groups.values()) == [["1020000010", "1020011530"]] and next(iter(groups)).min_area_m2 == 2e8
    bad = fixtures.streams(spark, block).withColumn("DSLINKNO", F.col("LINKNO"))
    done, failed = run_regions(bad, fixtures.lakes(spark, block), table)
    assert not done and len(failed) == 1
