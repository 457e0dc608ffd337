"""GeoPackage layers, read as a Python data source and written by table.

A GeoPackage is an SQLite file, so one task reads one range of row ids. SQLite opens
it by its path: a source layer must lie where the driver and all executors see it.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .wkb import encode, geopackage_blob

#: Rows of one reading task.
ROWS_PER_TASK = 200_000

_KINDS = {"INTEGER": "long", "INT": "long", "MEDIUMINT": "long", "SMALLINT": "long", "TINYINT": "long", "BIGINT": "long", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BOOLEAN": "boolean"}


class _Range(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def _layer(connection: sqlite3.Connection, wanted: str | None) -> tuple[str, str]:
    """(table, geometry column) of the named layer, or of the first."""
    rows = connection.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY table_name").fetchall()
    for table, column in rows:
        if wanted in (None, table):
            return table, column
    raise ValueError(f"no layer {wanted!r}")


class GeoPackageSource(DataSource):
    """``spark.read.format("geopackage").option("layer", ...).load(path)``; geometry as WKB."""

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True)

    def schema(self) -> str:
        with self._open() as c:
            table, geometry = _layer(c, self.options.get("layer"))
            columns = c.execute(f'PRAGMA table_info("{table}")').fetchall()
        return ", ".join(f"`{name}` " + ("binary" if name == geometry else _KINDS.get(kind.split("(")[0].upper(), "string")) for _, name, kind, *_ in columns)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("layer"), schema.names)


class _Reader(DataSourceReader):
    def __init__(self, path: str, layer: str | None, names: list[str]):
        self.path, self.layer, self.names = path, layer, names

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self._open() as c:
            table, _ = _layer(c, self.layer)
            lo, hi = c.execute(f'SELECT min(rowid), max(rowid) FROM "{table}"').fetchone()
        return [] if lo is None else [_Range(a, min(a + ROWS_PER_TASK - 1, hi)) for a in range(lo, hi + 1, ROWS_PER_TASK)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition is None:
            return
        with self._open() as c:
            table, geometry = _layer(c, self.layer)
            at = self.names.index(geometry) if geometry in self.names else -1
            columns = ", ".join(f'"{n}"' for n in self.names)
            for row in c.execute(f'SELECT {columns} FROM "{table}" WHERE rowid BETWEEN ? AND ?', (partition.first, partition.last)):
                yield tuple(geopackage_blob(v) if i == at and v is not None else v for i, v in enumerate(row))


def read_geopackage(spark: SparkSession, path: str, layer: str | None = None, geometry_col: str = "geometry") -> DataFrame:
    """A layer with its geometry as arrays of points, in ``geometry_col``."""
    from ..session import ship_package
    from .wkb import from_wkb

    ship_package(spark)
    spark.dataSource.register(GeoPackageSource)
    reader = spark.read.format("geopackage")
    df = (reader.option("layer", layer) if layer else reader).load(path)
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as c:
        _, column = _layer(c, layer)
    return df.withColumn(column, from_wkb(column)).withColumnRenamed(column, geometry_col)


def _fill(c: sqlite3.Connection, layer: str, columns: list[tuple[str, str]], rows: Iterator[tuple], polygon: bool, srs_id: int) -> int:
    """Make a package with one layer of (geometry, other values) rows; their number."""
    c.execute("PRAGMA application_id = 1196444487")
    c.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT)")
    c.executemany("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, 'undefined', NULL)", [("undefined", -1, "NONE", -1), ("undefined geographic", 0, "NONE", 0), (f"EPSG:{srs_id}", srs_id, "EPSG", srs_id)])
    c.execute("CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT, description TEXT, last_change TEXT, min_x REAL, min_y REAL, max_x REAL, max_y REAL, srs_id INTEGER)")
    c.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z TINYINT, m TINYINT, PRIMARY KEY (table_name, column_name))")
    c.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, '', strftime('%Y-%m-%dT%H:%M:%fZ', 'now'), NULL, NULL, NULL, NULL, ?)", (layer, layer, srs_id))
    c.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', ?, ?, 0, 0)", (layer, "POLYGON" if polygon else "GEOMETRY", srs_id))
    c.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, geom BLOB' + "".join(f', "{name}" {kind}' for name, kind in columns) + ")")
    head = b"GP" + struct.pack("<BBi", 0, 1, srs_id)
    marks = ", ".join("?" * (len(columns) + 1))
    names = ", ".join(f'"{name}"' for name in ("geom", *(n for n, _ in columns)))
    n = 0
    for g, *values in rows:
        blob = None if g is None else head + encode([[(p["x"], p["y"]) for p in part] for part in g], polygon)
        c.execute(f'INSERT INTO "{layer}" ({names}) VALUES ({marks})', (blob, *values))
        n += 1
    c.commit()
    return n


def _columns(df: DataFrame, geometry_col: str, leave_out: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    sql_kind = {"long": "INTEGER", "bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "boolean": "BOOLEAN"}
    return [(f.name, sql_kind.get(f.dataType.simpleString(), "TEXT")) for f in df.schema if f.name not in (geometry_col, *leave_out)]


def write_geopackage(df: DataFrame, path: str, layer: str, geometry_col: str = "geometry", polygon: bool = False, srs_id: int = 4326) -> int:
    """Write one layer to a file of the driver's machine; returns its rows.

    Rows come to the driver partition by partition, never all at once. Units are
    written by ``unit_packages``, in the tasks."""
    Path(path).unlink(missing_ok=True)
    columns = _columns(df, geometry_col)
    c = sqlite3.connect(path)
    try:
        return _fill(c, layer, columns, ((row[geometry_col], *(row[name] for name, _ in columns)) for row in df.toLocalIterator()), polygon, srs_id)
    finally:
        c.close()


def unit_packages(df: DataFrame, unit_col: str, layer_prefix: str, geometry_col: str = "geometry", srs_id: int = 4326) -> DataFrame:
    """``unit, content``: a package for each unit with the layer ``layer_prefix`` + unit.

    Each is made in memory by the task that holds the unit: no file of the task's own,
    and no more in memory than one unit, which one program is to open and which must
    stay below 2 GB."""
    from ..session import ship_package

    ship_package(df.sparkSession)
    columns = _columns(df, geometry_col)

    def make(table: pa.Table) -> pa.Table:
        unit = table.column(unit_col)[0].as_py()
        c = sqlite3.connect(":memory:")
        try:
            values = zip(*(table.column(n).to_pylist() for n in (geometry_col, *(name for name, _ in columns))), strict=True)
            _fill(c, f"{layer_prefix}{unit}", columns, values, False, srs_id)
            return pa.table({"unit": pa.array([unit], pa.int64()), "content": pa.array([c.serialize()], pa.binary())})
        finally:
            c.close()

    return df.withColumn(unit_col, F.col(unit_col).cast("long")).groupBy(unit_col).applyInArrow(make, "unit long, content binary")
