"""Coordinate axes of classic NetCDF files (formats 1, 2 and 5), read without a library.

The header names dimensions, attributes and variables; a variable that is not of
the record dimension lies in one piece, big-endian. Files of format 4 are HDF5
inside: for those any library that gives two lists will do, see ``read_axis``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

#: Fixed values of the public format: tags of lists, and numpy types by type number.
_DIMENSION, _VARIABLE, _ATTRIBUTE = 10, 11, 12
_TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}

#: Names an axis goes by.
ALIASES = {"lon": ("lon", "longitude"), "lat": ("lat", "latitude")}


class _Header:
    def __init__(self, data: bytes):
        if data[:3] != b"CDF" or data[3] not in (1, 2, 5):
            raise ValueError("not a classic NetCDF file" + (" but one of format 4" if data[:4] == b"\x89HDF" else ""))
        self.data, self.at = data, 4
        self.size = ">q" if data[3] == 5 else ">i"
        self.begin = ">i" if data[3] == 1 else ">q"
        self.number(self.size)  # records
        self.dimensions = [(self.name(), self.number(self.size)) for _ in range(self.many(_DIMENSION))]
        self.attributes()
        self.variables: dict[str, tuple[list[int], int, int]] = {}
        for _ in range(self.many(_VARIABLE)):
            name = self.name()
            dims = [self.number(self.size) for _ in range(self.number(self.size))]
            self.attributes()
            kind = self.number(">i")
            self.number(self.size)  # bytes a record
            self.variables[name] = (dims, kind, self.number(self.begin))

    def number(self, form: str) -> int:
        (value,) = struct.unpack_from(form, self.data, self.at)
        self.at += struct.calcsize(form)
        return value

    def many(self, tag: int) -> int:
        found, n = self.number(">i"), self.number(self.size)
        if found not in (0, tag):
            raise ValueError("a list of the header is not where it should be")
        return n

    def name(self) -> str:
        n = self.number(self.size)
        text = self.data[self.at : self.at + n].decode()
        self.at += -(-n // 4) * 4
        return text

    def attributes(self) -> None:
        for _ in range(self.many(_ATTRIBUTE)):
            self.name()
            kind, n = self.number(">i"), self.number(self.size)
            self.at += -(-n * np.dtype(_TYPES[kind]).itemsize // 4) * 4


def axis_values(data: bytes, aliases: tuple[str, ...]) -> list[float]:
    """The values of the first variable of the file that goes by one of the names."""
    header = _Header(data)
    name = next((n for n in header.variables if n in aliases), None)
    if name is None:
        raise ValueError(f"no variable {' or '.join(aliases)}")
    dims, kind, begin = header.variables[name]
    if len(dims) != 1 or header.dimensions[dims[0]][1] == 0:
        raise ValueError(f"{name} is no axis of fixed length")
    n = header.dimensions[dims[0]][1]
    return np.frombuffer(data, _TYPES[kind], n, begin).astype(float).tolist()


def _axes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for axis, aliases in ALIASES.items():
                values = axis_values(content, aliases)
                n = len(values)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array([axis] * n, pa.string()), pa.array(range(n), pa.int32()), pa.array(values, pa.float64())], names=["path", "axis", "idx", "coord"])


def read_netcdf_axes(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, axis, idx, coord`` of sample grids, wherever Spark can read them.

    ``lon`` or ``longitude`` and ``lat`` or ``latitude``, whichever the file has. A
    sample is read as one value, so it must be smaller than 2 GB."""
    ship_package(spark)
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return files.mapInArrow(_axes, "path string, axis string, idx int, coord double")
