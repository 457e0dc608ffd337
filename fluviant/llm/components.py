"""Connected components by union-find, and by star contraction beyond one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, scratch, ship_package

#: Edges one task may hold for the final union-find.
EDGES_PER_TASK = 100_000


def union_find(pairs: list[tuple[int, int]]) -> dict[int, int]:
    """The least vertex of the component of each vertex."""
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        top = v
        while (p := parent.setdefault(top, top)) != top:
            top = p
        while parent[v] != top:
            parent[v], v = top, parent[v]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {v: root(v) for v in list(parent)}


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = [p for b in batches for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    found = [(v, r) for v, r in union_find(pairs).items() if v != r]
    yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], names=["v", "root"])


def _contract(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step: same components, closer to stars around the least vertices."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    small = down.join(least, "a")
    return small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """``v, root`` for each vertex that is not the least of its component.

    ``edges`` (``a, b`` long, any order, repeats allowed) must be a written table.
    While there are more edges than one task may hold, star contraction goes on in
    all tasks until nothing changes; fewer edges are solved by one union-find."""
    ship_package(edges.sparkSession)
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    before = own = None
    while True:
        n, total = edges.agg(F.count(F.lit(1)), mark).first()
        if n <= edges_per_task:
            return edges.coalesce(1).mapInArrow(_solve, "v long, root long")
        if before == (n, total):  # all stars: each vertex points to its root
            return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
        before = (n, total)
        edges, done = scratch(_contract(edges), "stars", settle=True), own
        own = edges
        if done is not None:
            discard(done)
