"""Shuffled shards: a Feistel permutation over global row numbers.

Rows get a global number (their rank by id), the number goes through a keyed
permutation of 0..N-1, and shard and slot follow by arithmetic: shard is the
permuted number modulo the shard count, slot the quotient. Any row's place can
be computed from (number, N, seed, shards) alone, shard sizes differ by one at
most, and slots have no gaps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from ..session import scratch

#: Rounds of the permutation.
ROUNDS = 4


def _keyed(value: Column, seed: int, k: int) -> Column:
    """60 bits of a hash of the value under a round's key; any engine can compute it."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{k}:"), value.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _feistel(x: Column, side: int, seed: int, rounds: int) -> Column:
    """A permutation of 0..side*side-1: Feistel rounds that add modulo ``side``."""
    left, right = F.floor(x / side).cast("long"), F.pmod(x, F.lit(side))
    for k in range(rounds):
        left, right = right, F.pmod(left + F.pmod(_keyed(right, seed, k), F.lit(side)), F.lit(side))
    return left * side + right


def permuted(x: Column, n: int, seed: int = 0, rounds: int = ROUNDS) -> Column:
    """Feistel permutation of 0..n-1 with cycle walking.

    The domain is the square of ceil(sqrt(n)), so about 2/sqrt(n) of the numbers
    leave 0..n-1 at first; those walk on until they are back. A walk cannot be
    longer than the number of outside cells, which bounds the loop exactly."""
    side = max(1, math.isqrt(max(n - 1, 0)) + 1)
    outside = side * side - n

    def step(v: Column) -> Column:
        return _feistel(v, side, seed, rounds)

    once = step(x)
    if outside <= 0:
        return once
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(outside)), once, lambda v, _: F.when(v < n, v).otherwise(step(v)))
    return F.when(once < n, once).otherwise(walk)


def feistel_shards(docs: DataFrame, shards: int = 24, seed: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``:
    ``doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number``.

    * ``size`` is the text's UTF-8 bytes plus 8; a null text has none, so 8, and
      its ``text_crc32`` is that of the empty text, 0.
    * The law is ``rows``: shard sizes are at most one row apart; ``grown_shard``
      is null.
    * The global number is the rank by (id, crc, size), nulls first; equal rows
      are interchangeable, so the multiset of results is the same on every run.
    * Other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    light = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    # Written first: the sample for the ranges then reads the light rows, not the texts again.
    rows, n = numbered(scratch(light, "shard-light"), ["doc_id", "text_crc32", "size"], "shard-rows")
    placed = rows.withColumn("place", permuted(F.col("row_number"), max(n, 1), seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
