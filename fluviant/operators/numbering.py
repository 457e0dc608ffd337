"""Consecutive numbers over an order, without bringing all rows into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch


def numbered(rows: DataFrame, order: list[str], name: str = "numbered") -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` 0..N-1 in the given order, and N.

    Range partitions are sorted on their own and numbered from the counts of the
    partitions before; only one count a partition reaches the driver. Rows equal
    in every ordering column are interchangeable."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = scratch(ranged.withColumn("__pos", F.monotonically_increasing_id()), name)
    part = F.shiftright("__pos", 33)
    counts = {r[0]: r[1] for r in ranged.groupBy(part.alias("p")).count().collect()}
    before, total = {}, 0
    for p in sorted(counts):
        before[p], total = total, total + counts[p]
    offsets = rows.sparkSession.createDataFrame(list(before.items()), "__part long, __before long")
    at = F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1))
    joined = ranged.join(F.broadcast(offsets), part == F.col("__part"))
    return joined.withColumn("row_number", F.col("__before") + at).drop("__pos", "__part", "__before"), total


def numbered_by_group(rows: DataFrame, group: str, order: list[str], column: str, name: str = "numbered") -> DataFrame:
    """``rows`` with ``column`` 1..n in the given order within each group.

    The number of groups must be small (regions): one count for each group and range
    partition reaches the driver, and their offsets are broadcast. A null group is a
    group of its own."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = scratch(ranged.withColumn("__pos", F.monotonically_increasing_id()), name)
    part = F.shiftright("__pos", 33)
    pieces = ranged.groupBy(part.alias("__part"), F.col(group).alias("__group")).agg(F.count(F.lit(1)).alias("n"), F.min("__pos").alias("first")).collect()
    before: dict = {}
    shifts = []
    for r in sorted(pieces, key=lambda r: r["first"]):
        shifts.append((r["__part"], r["__group"], before.get(r["__group"], 0) - r["first"] + 1))
        before[r["__group"]] = before.get(r["__group"], 0) + r["n"]
    kind = ranged.schema[group].dataType.simpleString()
    offsets = rows.sparkSession.createDataFrame(shifts, f"__part long, __group {kind}, __shift long")
    joined = ranged.join(F.broadcast(offsets), (part == F.col("__part")) & F.col(group).eqNullSafe(F.col("__group")))
    return joined.withColumn(column, F.col("__pos") + F.col("__shift")).select(*rows.columns, column)
