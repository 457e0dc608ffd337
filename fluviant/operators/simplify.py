"""Simplifying a network: dissolve headwaters, prune side branches, merge short segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lines import distance, line_centroid
from ..schema import MIN_K_S, OUTLET
from ..session import scratch
from .graph import last_marked, resolve_chains


def is_headwater(order: Column, n: Column, highest: Column, n_below: Column, m: int) -> Column:
    """Whether a segment of order ``m`` is where headwaters of order m - 1 meet.

    With two predecessors both must have order m - 1. With more, only one pattern is
    refused: two or more of order m - 1 beside a higher one. (So [m, 1, 1] passes for
    m = 3: the rule is kept as the data users rely on it.)"""
    two = (n == 2) & (n_below == 2)
    more = (n > 2) & ~((highest != m - 1) & (n_below >= 2))
    return (order == m) & (two | more)


def _predecessors(network: DataFrame, graph: DataFrame, orders: tuple[int, ...]) -> DataFrame:
    """``id, n, highest`` and ``n_<o>`` for each order in ``orders``, of the predecessors by
    ``graph`` that are in ``network``."""
    known = network.select(F.col("LINKNO"), F.col("strmOrder").alias("o"))
    preds = graph.where(F.col("DSLINKNO") != OUTLET).select("LINKNO", F.col("DSLINKNO").alias("id")).join(known, "LINKNO")
    return preds.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("o").alias("highest"), *[F.count_if(F.col("o") == o).alias(f"n_{o}") for o in orders])


def headwater_candidates(network: DataFrame, graph: DataFrame, m: int) -> DataFrame:
    """``id`` of the segments of order ``m`` that absorb their headwaters.

    Predecessors come from ``graph``, the network before any dissolving; their
    orders from ``network``, as it is now."""
    found = network.select(F.col("LINKNO").alias("id"), "strmOrder").where(F.col("strmOrder") == m).join(_predecessors(network, graph, (m - 1,)), "id")
    return found.where(is_headwater(F.col("strmOrder"), F.col("n"), F.col("highest"), F.col(f"n_{m - 1}"), m)).select("id")


def mark_headwaters(network: DataFrame) -> DataFrame:
    """``network`` with ``mark2`` and ``mark3``: whether a segment of order 2 or 3 meets the
    rule before anything is dissolved.

    Of order 2 these are the candidates. Of order 3 a segment is one if, besides, no
    candidate of order 2 lies on its way down or is itself: else it or all its
    predecessors are gone by then, and with none there, all of them are."""
    stats = _predecessors(network, network, (1, 2)).withColumnRenamed("id", "LINKNO")
    rules = {f"mark{m}": F.coalesce(is_headwater(F.col("strmOrder"), F.col("n"), F.col("highest"), F.col(f"n_{m - 1}"), m), F.lit(False)) for m in (2, 3)}
    return network.join(stats, "LINKNO", "left").withColumns(rules).select(*network.columns, *rules)


def headwater_labels(graph: DataFrame, candidates: DataFrame) -> DataFrame:
    """``keep, drop``: each segment upstream of candidates and the candidate farthest
    downstream, which absorbs it."""
    marks = last_marked(graph, candidates)
    return marks.where("id <> mark").select(F.col("mark").alias("keep"), F.col("id").alias("drop"))


def _fold(network: DataFrame, pairs: DataFrame, sums: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, aggregates of the rows folded into each ``keep``).

    Only the rows that go are grouped; the others keep all their columns. Lines are
    gathered if ``network`` has them."""
    goes = pairs.select(F.col("drop").alias("LINKNO"), "keep").distinct()
    if "geometry" in network.columns:
        parts = F.sort_array(F.collect_list(F.struct("TopologicalOrder", F.col("geometry").alias("g"))))
        sums = [*sums, F.flatten(F.transform(parts, lambda s: s["g"])).alias("parts")]
    folded = network.join(goes, "LINKNO").groupBy(F.col("keep").alias("LINKNO")).agg(*sums)
    return network.join(goes.select("LINKNO"), "LINKNO", "left_anti"), folded


def _taken_in(network: DataFrame) -> dict[str, Column]:
    """The line of a segment with those folded into it, if ``network`` has lines."""
    if "geometry" not in network.columns:
        return {}
    return {"geometry": F.when(F.col("parts").isNull(), F.col("geometry")).otherwise(F.concat("parts", "geometry"))}


def dissolve_headwaters(network: DataFrame, labels: DataFrame) -> DataFrame:
    """Fold the labelled segments into the ones that absorb them.

    The absorbing segment keeps its values, except that ``USContArea`` becomes the sum
    of those it absorbed, and that its line, if the table has lines, takes theirs in."""
    stays, folded = _fold(network, labels, [F.sum("USContArea").alias("us")])
    joined = stays.join(folded, "LINKNO", "left").withColumns({"USContArea": F.coalesce("us", "USContArea"), **_taken_in(network)})
    return joined.select(*network.columns)


def prune_pairs(network: DataFrame, graph: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """``LINKNO, LINKTODROP``: a sibling for each order-1 segment that drains into order 2 or more.

    The only sibling; or, if one sibling has order 1 and another a higher one, the
    first of higher order; else the one whose line is nearest to the segment's
    centroid, in degrees. First means smallest id; a segment without a sibling in the
    network is left alone. ``lines`` (``LINKNO, geometry``) holds the lines of the
    segments, in one row or several each; without it they are columns of ``network``.
    They are read for siblings only among which the distance decides."""
    lines = network.select("LINKNO", "geometry") if lines is None else lines
    higher = network.where("strmOrder >= 2").select(F.col("LINKNO").alias("DSLINKNO"))
    side = network.where("strmOrder = 1").join(higher, "DSLINKNO", "left_semi").select(F.col("LINKNO").alias("drop"), "DSLINKNO")
    sibling = graph.where(F.col("DSLINKNO") != OUTLET).select(F.col("LINKNO").alias("s"), "DSLINKNO")
    known = network.select(F.col("LINKNO").alias("s"), F.col("strmOrder").alias("o"))
    pairs = scratch(side.join(sibling, "DSLINKNO").where("s <> drop").join(known, "s").select("drop", "s", "o"), "siblings")
    chosen = pairs.groupBy("drop").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("only"), F.min("o").alias("lo"), F.max("o").alias("hi"), F.min(F.when(F.col("o") > 1, F.col("s"))).alias("first_higher"))
    keep = F.when(F.col("n") == 1, F.col("only")).when((F.col("lo") == 1) & (F.col("hi") > 1), F.col("first_higher"))
    chosen = scratch(chosen.select("drop", keep.alias("keep")), "siblings-chosen")
    tied = chosen.where("keep is null").select("drop")
    close = pairs.join(tied, "drop")
    at = lines.join(tied.select(F.col("drop").alias("LINKNO")), "LINKNO").groupBy(F.col("LINKNO").alias("drop")).agg(line_centroid(F.flatten(F.collect_list("geometry"))).alias("at"))
    near = close.join(at, "drop").join(lines.withColumnRenamed("LINKNO", "s"), "s")
    nearest = near.groupBy("drop").agg(F.min(F.struct(distance(F.col("geometry"), F.col("at")).alias("d"), F.col("s")))["s"].alias("nearest"))
    return chosen.join(nearest, "drop", "left").select(F.coalesce("keep", "nearest").alias("LINKNO"), F.col("drop").alias("LINKTODROP"))


def prune_branches(network: DataFrame, pairs: DataFrame) -> DataFrame:
    return network.join(pairs.select(F.col("LINKTODROP").alias("LINKNO")), "LINKNO", "left_anti")


def short_stream_pairs(network: DataFrame, least_k: int = MIN_K_S) -> DataFrame:
    """``LINKNO, MergeWith``: downstream and upstream segment of each merge.

    A segment with k below ``least_k`` may merge with its only upstream one, or with
    its downstream one if that has no other upstream; it takes the one with the
    smaller k, the upstream one of equals. ``MergeWith`` is the one that goes."""
    rows = network.select("LINKNO", "DSLINKNO", F.col("musk_k").alias("k"))
    ups = rows.where(F.col("DSLINKNO") != OUTLET).groupBy(F.col("DSLINKNO").alias("LINKNO")).agg(F.count(F.lit(1)).alias("n"), F.min("LINKNO").alias("u"), F.min("k").alias("uk")).where("n = 1")
    short = rows.where(F.col("k") < least_k).join(ups.select("LINKNO", "u", "uk"), "LINKNO", "left")
    # The downstream one counts if this is its only upstream one; it must be in the table.
    down = ups.select(F.col("LINKNO").alias("DSLINKNO"), F.lit(True).alias("alone")).join(rows.select(F.col("LINKNO").alias("DSLINKNO"), F.col("k").alias("dk")), "DSLINKNO")
    options = short.join(down, "DSLINKNO", "left")
    takes_up = F.col("u").isNotNull() & (F.col("dk").isNull() | (F.col("uk") <= F.col("dk")))
    up = options.where(takes_up).select("LINKNO", F.col("u").alias("MergeWith"))
    below = options.where(~takes_up & F.col("dk").isNotNull()).select(F.col("DSLINKNO").alias("LINKNO"), F.col("LINKNO").alias("MergeWith"))
    return up.unionByName(below).distinct()


def merge_short_streams(network: DataFrame, pairs: DataFrame) -> DataFrame:
    """Collapse each run of merged segments into its farthest downstream member.

    It takes the least upstream area, the largest downstream area, the sum of lengths
    and all lines, if the table has lines; its k, x, order and place in the order stay
    as they were."""
    return merge_labelled(network, merge_labels(pairs))


def merge_labels(pairs: DataFrame) -> DataFrame:
    """``keep, drop``: each segment that goes and the end of its run of merges."""
    ends = resolve_chains(pairs.select(F.col("MergeWith").alias("id"), F.col("LINKNO").alias("target")))
    return ends.select(F.col("final").alias("keep"), F.col("id").alias("drop"))


def merge_labelled(network: DataFrame, labels: DataFrame) -> DataFrame:
    """``merge_short_streams`` with the ends of the runs known."""
    stays, folded = _fold(network, labels, [F.min("USContArea").alias("us"), F.max("DSContArea").alias("ds"), F.sum("LengthGeodesicMeters").alias("len")])
    joined = stays.join(folded, "LINKNO", "left")
    joined = joined.withColumns({
        "USContArea": F.least("USContArea", "us"),
        "DSContArea": F.greatest("DSContArea", "ds"),
        "LengthGeodesicMeters": F.col("LengthGeodesicMeters") + F.coalesce("len", F.lit(0.0)),
        **_taken_in(network),
    })
    moved = labels.select(F.col("drop").alias("DSLINKNO"), F.col("keep").alias("onto"))
    joined = joined.join(moved, "DSLINKNO", "left").withColumn("DSLINKNO", F.coalesce("onto", "DSLINKNO"))
    return joined.select(*network.columns)
