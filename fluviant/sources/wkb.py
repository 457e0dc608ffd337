"""Well-known binary: lines and polygons as arrays of points, and back."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ARROW_GEOMETRY, GEOMETRY

#: Codes of geometry kinds.
LINE, POLYGON, MULTI_LINE, MULTI_POLYGON = 2, 3, 5, 6

Parts = list[list[tuple[float, float]]]


def decode(data: bytes) -> Parts | None:
    """Parts of a line or rings of a polygon; other dimensions than x and y are left out.

    A multi-polygon's rings follow one another. Points and collections give None."""
    if not data:
        return None
    parts: Parts = []
    at = 0

    def read(fmt: str, order: str) -> tuple:
        nonlocal at
        values = struct.unpack_from(order + fmt, data, at)
        at += struct.calcsize(order + fmt)
        return values

    def geometry() -> bool:
        nonlocal at
        order = "<" if data[at] == 1 else ">"
        at += 1
        (code,) = read("I", order)
        if code & 0x20000000:
            read("I", order)
        wide = 2 + bool(code & 0x80000000 or code // 1000 % 10 in (1, 3)) + bool(code & 0x40000000 or code // 1000 % 10 in (2, 3))
        kind = (code & 0xFFFF) % 1000
        if kind not in (LINE, POLYGON, MULTI_LINE, MULTI_POLYGON):
            return False
        (n,) = read("I", order)
        if kind in (MULTI_LINE, MULTI_POLYGON):
            return all([geometry() for _ in range(n)])
        for count in [n] if kind == LINE else range(n):
            size = count if kind == LINE else read("I", order)[0]
            xy = np.frombuffer(data, order + "f8", size * wide, at).reshape(size, wide)[:, :2]
            at += 8 * size * wide
            parts.append([tuple(p) for p in xy.tolist()])
        return True

    return parts if geometry() else None


def encode(parts: Parts, polygon: bool = False) -> bytes:
    """One part as a line or ring, several as a multi-line; a polygon's parts are its rings."""

    def points(part) -> bytes:
        return struct.pack("<I", len(part)) + np.asarray(part, "<f8").tobytes()

    if polygon:
        return struct.pack("<BII", 1, POLYGON, len(parts)) + b"".join(map(points, parts))
    lines = [struct.pack("<BI", 1, LINE) + points(p) for p in parts]
    return lines[0] if len(lines) == 1 else struct.pack("<BII", 1, MULTI_LINE, len(lines)) + b"".join(lines)


def geopackage_blob(blob: bytes) -> bytes:
    """The geometry in a GeoPackage value, without its header."""
    if blob[:2] != b"GP":
        return blob
    return blob[8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7] :]


def _decode_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for values in batches:
        found = [None if v is None else decode(v) for v in values.to_pylist()]
        yield pa.array([None if p is None else [[{"x": x, "y": y} for x, y in part] for part in p] for p in found], ARROW_GEOMETRY)


def from_wkb(column: Column | str) -> Column:
    return F.arrow_udf(_decode_all, GEOMETRY)(column)


def to_wkb(column: Column | str, polygon: bool = False) -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            yield pa.array([None if v is None else encode([[(p["x"], p["y"]) for p in part] for part in v], polygon) for v in values.to_pylist()], pa.binary())

    return F.arrow_udf(run, "binary")(column)
