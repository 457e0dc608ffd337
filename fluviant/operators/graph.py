"""Questions about a forest of downstream pointers, answered by pointer doubling.

A round joins each pointer with the pointers of its targets, three times over, so
that a pointer gets four times as long and paths of any depth take a logarithmic
number of joins. All joins of a round read the same table, whose exchange Spark
reuses. Every round is written to the shared folder, which keeps plans small and
survives lost executors.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import OUTLET
from ..session import discard, scratch


#: Joins of a round; a pointer gets one more than this times as long.
HOPS = 3


class CycleError(ValueError):
    """The pointers run in a circle."""


def edges(network: DataFrame, id_col: str = "LINKNO", ds_col: str = "DSLINKNO") -> DataFrame:
    """``id, target`` of each segment that has a downstream one."""
    return network.where(F.col(ds_col) != OUTLET).select(F.col(id_col).alias("id"), F.col(ds_col).alias("target"))


def _rounds(n: int) -> int:
    """Rounds after which every pointer has left a forest of n segments."""
    return math.ceil(math.log(max(n, 2), HOPS + 1)) + 2


def resolve_chains(links: DataFrame) -> DataFrame:
    """``id, final``: where following ``links`` (``id, target``) from each id ends.

    ``final`` is the first target that is no id itself. Raises CycleError."""
    state = scratch(links.select("id", "target"), "chain-0")
    for k in range(_rounds(state.count())):
        onward = state.select(F.col("id").alias("target"), F.col("target").alias("next"))
        ahead = state.select("id", "target")
        for _ in range(HOPS):
            ahead = ahead.join(onward, "target", "left").select("id", F.coalesce("next", "target").alias("target"), F.col("next").isNull().alias("done"))
        state, before = scratch(ahead, f"chain-{k + 1}"), state
        discard(before)
        if state.where("not done").isEmpty():
            return state.select("id", F.col("target").alias("final"))
    raise CycleError("downstream pointers form a cycle")


def flow(network: DataFrame, marks: tuple[str, ...] = (), carry: tuple[str, ...] = (), with_height: bool = False, id_col: str = "LINKNO", ds_col: str = "DSLINKNO") -> DataFrame:
    """What all segments learn from the way down, in one doubling state that is written once a round.

    ``id, root`` of every segment: the outlet of its tree, itself for an outlet, or the
    first id on the way that is not in the table. For each boolean column in ``marks``:
    that name, the marked segment farthest down the way, the segment itself included,
    and ``at_`` + name, the steps to it; both null without one. For each column in
    ``carry``: ``root_`` + name, the root's value, null if the root is not in the table.
    ``with_height``: ``height``, the edges on the longest path from a headwater.

    A round follows each way HOPS times as far as the ways are long by then. ``last`` is
    where the way has got to and ``to`` what comes next. Raises CycleError."""
    one = F.lit(0).cast("long")
    state = network.select(
        F.col(id_col).alias("id"), F.when(F.col(ds_col) != OUTLET, F.col(ds_col)).alias("to"), F.col(id_col).alias("last"), one.alias("height"),
        *[c for m in marks for c in (F.when(F.col(m), F.col(id_col)).alias(m), F.when(F.col(m), one).alias("at_" + m))],
        *[F.col(c).alias("root_" + c) for c in carry],
    )
    state = scratch(state, "flow-0")
    for k in range(_rounds(state.count())):
        if state.where("to is not null").isEmpty():
            return state.select("id", F.col("last").alias("root"), *["height"] * with_height, *[c for m in marks for c in (m, "at_" + m)], *["root_" + c for c in carry])
        seen = [c for c in state.columns if c not in ("id", "height")]
        onward = state.select(F.col("to").alias("next"), F.col("id").alias("to"), F.lit(True).alias("known"), *[F.col(c).alias("next_" + c) for c in seen if c != "to"])
        ahead, arrivals, length = state, [], (HOPS + 1) ** k
        for j in range(1, HOPS + 1):
            arrivals.append(ahead.where("to is not null").select(F.col("to").alias("id"), (F.col("height") + j * length).alias("from_above")))
            joined = ahead.join(onward, "to", "left")
            ahead = joined.select(
                "id", F.col("next").alias("to"), F.coalesce("next_last", "to", "last").alias("last"), "height",
                *[c for m in marks for c in (F.coalesce("next_" + m, m).alias(m), F.when(F.col("next_" + m).isNotNull(), F.col("next_at_" + m) + j * length).otherwise(F.col("at_" + m)).alias("at_" + m))],
                *[F.when(F.col("known") | F.col("to").isNull(), F.when(F.col("known"), F.col("next_root_" + c)).otherwise(F.col("root_" + c))).alias("root_" + c) for c in carry],
            )
        if with_height:
            reached = reduce(DataFrame.unionByName, arrivals).groupBy("id").agg(F.max("from_above").alias("from_above"))
            ahead = ahead.join(reached, "id", "left").withColumn("height", F.greatest("height", F.coalesce("from_above", F.lit(0)))).drop("from_above")
        state, before = scratch(ahead.select(*state.columns), f"flow-{k + 1}"), state
        discard(before)
    raise CycleError("downstream pointers form a cycle")


def roots(network: DataFrame, id_col: str = "LINKNO", ds_col: str = "DSLINKNO") -> DataFrame:
    """``id, root`` for every segment: the outlet of its tree, itself for an outlet."""
    return flow(network, id_col=id_col, ds_col=ds_col)


def last_marked(network: DataFrame, marked: DataFrame) -> DataFrame:
    """``id, mark``: the marked segment (``id``) farthest down the path from each id,
    the id itself included; ids without one are left out."""
    named = network.join(marked.select(F.col("id").alias("LINKNO"), F.lit(True).alias("mark")).distinct(), "LINKNO", "left")
    return flow(named, marks=("mark",)).where("mark is not null").select("id", "mark")


def heights(network: DataFrame) -> DataFrame:
    """``id, height``: edges on the longest path from a headwater down to each id."""
    return flow(network, with_height=True).select("id", "height")


def ancestor_pairs(network: DataFrame) -> DataFrame:
    """``LINKNO, ancestor, distance`` for each segment and all segments upstream of it."""
    step = scratch(edges(network), "jump-0")
    pairs = scratch(step.select(F.col("id").alias("ancestor"), F.col("target").alias("LINKNO"), F.lit(1).cast("long").alias("distance")), "pairs-0")
    for k in range(2 * _rounds(step.count())):
        if step.isEmpty():
            return pairs
        beyond = step.select(F.col("id").alias("start"), F.col("target").alias("ancestor")).join(pairs, "ancestor")
        beyond = beyond.select(F.col("start").alias("ancestor"), "LINKNO", (F.col("distance") + (1 << k)).alias("distance"))
        longer = scratch(pairs.unionByName(beyond), f"pairs-{k + 1}")
        onward = step.select(F.col("id").alias("target"), F.col("target").alias("next"))
        further = scratch(step.join(onward, "target").select("id", F.col("next").alias("target")), f"jump-{k + 1}")
        discard(pairs)
        discard(step)
        pairs, step = longer, further
    raise CycleError("downstream pointers form a cycle")
