"""Exact duplicates: group by a 128-bit content hash, keep the smallest id, and
compare bytes inside the groups so that a collision never merges two texts.

Plan. One scan writes a light table (id, 128-bit hash, 256-bit digest; no text).
Hashes that occur more than once go into a bit map of bounded size, which is
broadcast. Only rows whose hash may repeat come back with their text and are
grouped by (hash, text): the aggregation compares the bytes, and partial
aggregation collapses a group of copies inside each task before the shuffle, so
a group that holds a third of all rows costs one row a task. The verdicts come back
by ``lookup``: rows of large groups meet theirs by a broadcast of at most 2,000
groups, so no group is the work of one task. Texts that occur once are not shuffled,
but for those that share a place of the bit map with a repeated hash: at most a
sixteenth up to 67 million repeated hashes, and more beyond, where the map is full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch
from ._common import TMP, bitmap_of, bitmap_size, lookup, split_by_bitmap

#: White space that counts as one space when texts are compared.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def _hash128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _groups(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, int, DataFrame | None]:
    """(light rows, groups of two rows or more, bit map of their hashes, its bits, texts
    that share all hashes with another text: none, as long as no two texts do)."""
    text = normalised(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("norm"))
    light = scratch(keyed.select("id", _hash128(F.col("norm")).alias("h"), _digest(F.col("norm")).alias("sha")), "exact-light")
    repeated = scratch(light.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "exact-repeated", settle=True)
    bits = bitmap_size(repeated.count())
    bitmap = bitmap_of(repeated, F.xxhash64("h"), bits)
    maybe, _ = split_by_bitmap(keyed.select("id", "norm", _hash128(F.col("norm")).alias("h")), F.xxhash64("h"), bitmap, bits)
    # Grouping by the text itself is the comparison of bytes inside a hash group.
    by_bytes = maybe.groupBy("h", "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n")).select("h", "norm", _digest(F.col("norm")).alias("sha"), "keep_id", "n")
    groups = by_bytes.groupBy("h", "sha").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).where("n > 1")
    groups = scratch(groups, "exact-groups", settle=True)
    shared = groups.where("texts > 1").select("h", "sha")
    if shared.isEmpty():
        return light, groups.drop("texts"), bitmap, bits, None
    return light, groups.where("texts = 1").drop("texts"), bitmap, bits, scratch(by_bytes.join(shared, ["h", "sha"]), "exact-shared")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    * Texts are equal if identical after each run of white space became one space.
    * A null text is the empty text; all empty texts are one group.
    * ``keep_id`` is the smallest id of the group, nulls last, in the order of the id's
      own type; ``kept`` is ``doc_id <=> keep_id``. Rows that repeat both id and text
      are one document: each counts in ``group_size`` and all carry the same verdict.
    * Two texts that share all their hashes are still told apart: they are joined by
      the texts themselves.
    * Other columns of ``docs`` are ignored, so their names cannot clash. An
      empty table gives an empty result.
    """
    light, groups, _, _, shared = _groups(docs, id_col, text_col)
    joined = light
    if shared is not None:
        joined = light.join(shared.select("h", "sha").distinct(), ["h", "sha"], "left_anti")
    joined = lookup(joined, groups, ("h", "sha"), "n", light.count(), "left").select("id", "sha", "keep_id", "n")
    if shared is not None:
        rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm")).withColumn("h", _hash128(F.col("norm")))
        joined = joined.unionAll(rows.join(shared, ["h", "norm"]).select("id", "sha", "keep_id", "n"))
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged.

    The row with the smallest id stays (nulls last); of rows that repeat both id
    and text one stays. Rows whose text occurs once pass without a shuffle."""
    light, groups, bitmap, bits, shared = _groups(docs, id_col, text_col)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    h, sha, keep, n, text = (TMP + name for name in ("h", "sha", "keep", "n", "text"))
    norm = normalised(F.col(f"`{text_col}`"))
    maybe, alone = split_by_bitmap(docs.withColumn(h, _hash128(norm)), F.xxhash64(h), bitmap, bits)
    maybe = maybe.withColumn(sha, _digest(norm))
    out = alone.select(*columns)
    if shared is not None:
        own = shared.select(F.col("h").alias(h), F.col("sha").alias(sha), F.col("norm").alias(text), F.col("keep_id").alias(keep))
        among = maybe.withColumn(text, norm).join(own, [h, sha, text])
        out = out.unionAll(among.where(F.col(f"`{id_col}`").eqNullSafe(F.col(keep))).dropDuplicates([h, sha, text]).select(*columns))
        maybe = maybe.join(own.select(h, sha).distinct(), [h, sha], "left_anti")
    renamed = groups.select(F.col("h").alias(h), F.col("sha").alias(sha), F.col("keep_id").alias(keep), F.col("n").alias(n))
    found = lookup(maybe, renamed, (h, sha), n, light.count(), "left")
    first = found.where(F.col(n).isNotNull() & F.col(f"`{id_col}`").eqNullSafe(F.col(keep)))
    return out.unionAll(found.where(F.col(n).isNull()).select(*columns)).unionAll(first.dropDuplicates([h, sha]).select(*columns))
