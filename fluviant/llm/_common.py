"""Shared helpers of the text operators: bit maps and the hold-out rule."""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prefix of every helper column, so that columns of the caller never clash.
TMP = "__fluviant_"

#: Bits in one row of a bit map, fixed by Spark's bitmap_* functions.
BITS_PER_ROW = 32768


T = TypeVar("T")
_resident: dict = {}


def resident(key: tuple, build: Callable[[], T]) -> T:
    """What a Python worker keeps from task to task for one operator.

    Workers outlive operators, so another operator's tables are let go first: a
    worker holds those of one operator at a time."""
    if key not in _resident:
        _resident.clear()
        _resident[key] = build()
    return _resident[key]


def held_out(doc_id: Column) -> Column:
    """True for rows no model may learn from: crc32(id as text) mod 4 is 2.
    A null id is never held out, and never learnt from either (see callers)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bitmap_size(n_keys: int, least: int = 20, most: int = 30) -> int:
    """Bits for ``n_keys`` keys: 16 a key, between 2**least and 2**most.

    2**30 bits are 128 MB, the proven bound of the broadcast."""
    return 1 << min(most, max(least, math.ceil(math.log2(16 * max(n_keys, 1)))))


def bitmap_of(keys: DataFrame, hashed: Column, bits: int) -> DataFrame:
    """Bit map of the hashes of ``keys``: at most bits / 32768 rows of 4 KB."""
    slot = F.pmod(hashed, F.lit(bits))
    return keys.groupBy(F.bitmap_bucket_number(slot).alias(TMP + "map_row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias(TMP + "map")
    )


def split_by_bitmap(df: DataFrame, hashed: Column, bitmap: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose hash may be in the bit map, rows whose hash is surely not).

    The map is broadcast; its size is fixed by ``bits`` whatever the data, so
    neither side of ``df`` is shuffled."""
    slot = F.pmod(F.coalesce(hashed, F.lit(0)), F.lit(bits))
    joined = df.join(F.broadcast(bitmap), F.bitmap_bucket_number(slot) == F.col(TMP + "map_row"), "left")
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col(TMP + "map"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_in = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return joined.where(is_in).select(*_quoted(df)), joined.where(~is_in).select(*_quoted(df))


#: Rows with one key up to which they may share a task, whatever the number of rows.
FEW_ROWS = 256


def lookup(rows: DataFrame, table: DataFrame, keys: str | tuple[str, ...], size_col: str, total: int, how: str) -> DataFrame:
    """``rows`` joined with ``table``, a written table with one row for each key.

    ``size_col`` of ``table`` says how many of the ``total`` rows have the key. Keys of
    more than a 2,000th of all rows are at most 2,000 in number: those are broadcast,
    and their rows stay where they are. The others are joined by a shuffle, in which
    no key is large. ``how`` is ``inner`` or ``left``. Null keys match nothing."""
    names = [keys] if isinstance(keys, str) else list(keys)
    most = max(FEW_ROWS, total // 2_000)
    hot = table.where(F.col(size_col) > most)
    if hot.isEmpty():
        return rows.join(table, names, how)
    large = rows.join(F.broadcast(hot), names)
    rest = rows.join(F.broadcast(hot.select(*names)), names, "left_anti")
    return large.unionByName(rest.join(table.where(F.col(size_col) <= most), names, how))


def _quoted(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]
