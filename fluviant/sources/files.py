"""Reading and writing the tables of the workflow."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .wkb import from_wkb, to_wkb
from .xlsx import read_sheet


def read_geoparquet(spark: SparkSession, *paths: str, geometry_col: str = "geometry") -> DataFrame:
    """GeoParquet files with their geometry as arrays of points.

    Folders are read one by one, so that each may be partitioned on its own; a column
    that one of them lacks is null there."""
    ship_package(spark)
    tables = [spark.read.parquet(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables).withColumn(geometry_col, from_wkb(geometry_col))


#: Files that get their footer at the same time.
FOOTERS_AT_ONCE = 8


def write_geoparquet(df: DataFrame, path: str, geometry_col: str = "geometry", polygon: bool = False, partition_by: str | None = None) -> None:
    """A folder of GeoParquet files: WKB geometry, and the ``geo`` footer in each file.

    Spark writes the files; its writer takes no footer, so each is copied once with one
    (``add_geo_footers``)."""
    ship_package(df.sparkSession)
    writer = df.withColumn(geometry_col, to_wkb(geometry_col, polygon)).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    add_geo_footers(df.sparkSession, path, geometry_col, polygon)


def add_geo_footers(spark: SparkSession, folder: str, geometry_col: str = "geometry", polygon: bool = False) -> int:
    """Give each Parquet file under ``folder`` a GeoParquet 1.0 footer (EPSG:4326); their number.

    Row groups are copied as they are, by the driver's JVM on the folder's own file
    system, a few files at a time; nothing is decoded. A copy takes the file's place by
    a rename, and files that have a footer already are left alone."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    geo = {"version": "1.0.0", "primary_column": geometry_col, "columns": {geometry_col: {"encoding": "WKB", "geometry_types": ["Polygon"] if polygon else ["LineString", "MultiLineString"]}}}
    hadoop, parquet = jvm.org.apache.hadoop.fs, jvm.org.apache.parquet
    root = hadoop.Path(folder)
    fs = root.getFileSystem(conf)
    files, found = fs.listFiles(root, True), []
    while files.hasNext():
        at = files.next().getPath()
        if at.getName().endswith(".parquet"):
            found.append(at)

    def copy(at) -> None:
        source = parquet.hadoop.util.HadoopInputFile.fromPath(at, conf)
        reader = parquet.hadoop.ParquetFileReader.open(source)
        about = reader.getFooter().getFileMetaData()
        schema, extra = about.getSchema(), jvm.java.util.HashMap(about.getKeyValueMetaData())
        reader.close()
        if extra.containsKey("geo"):
            return
        extra.put("geo", json.dumps(geo))
        staged = hadoop.Path(at.getParent(), "_" + at.getName() + ".geo")
        mode = parquet.hadoop.ParquetFileWriter.Mode.OVERWRITE
        writer = parquet.hadoop.ParquetFileWriter(parquet.hadoop.util.HadoopOutputFile.fromPath(staged, conf), schema, mode, 128 << 20, 0)
        writer.start()
        writer.appendFile(source)
        writer.end(extra)
        fs.delete(at, False)
        if not fs.rename(staged, at):
            raise OSError(f"could not move {staged}")

    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        list(pool.map(copy, found))
    return len(found)


def read_table(spark: SparkSession, path: str, schema: str | None = None, header: bool = True) -> DataFrame:
    """CSV with an explicit schema, an Excel sheet, or Parquet, by the ending. Option sheets
    come as any of them; an Excel sheet needs the schema."""
    if path.endswith(".xlsx"):
        if schema is None:
            raise ValueError("an Excel sheet is read with a schema")
        return read_sheet(spark, path, schema)
    if path.endswith(".csv"):
        return spark.read.csv(path, header=header, schema=schema) if schema else spark.read.csv(path, header=header, inferSchema=True)
    return spark.read.parquet(path)


def read_lake_table(spark: SparkSession, path: str) -> DataFrame:
    """``LINKNO``: every cell of the table is the id of a lake segment."""
    raw = spark.read.csv(path, header=True)
    cells = F.explode(F.array(*[F.col(f"`{c}`").cast("double").cast("long") for c in raw.columns]))
    return raw.select(cells.alias("LINKNO")).where("LINKNO is not null").distinct()


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """``region_number, header`` from a JSON object of strings."""
    text = spark.read.text(path, wholetext=True)
    entries = F.explode(F.from_json("value", "map<string,string>"))
    return text.select(entries.alias("region_number", "header")).select("region_number", F.col("header").cast("long").alias("header"))


def read_axis(spark: SparkSession, lon: list[float], lat: list[float]) -> DataFrame:
    """``axis, idx, coord`` from two lists of coordinates, as any library gives them.

    Classic NetCDF files are read by ``read_netcdf_axes``."""
    rows = [("lon", i, float(v)) for i, v in enumerate(lon)] + [("lat", i, float(v)) for i, v in enumerate(lat)]
    return spark.createDataFrame(rows, "axis string, idx int, coord double")


def write_single_csv(df: DataFrame, path: str, order: list[str] | None = None, header: bool = True, columns: list[str] | None = None) -> None:
    """One CSV file at ``path``, in the given order: a file, not a folder.

    One task writes it. Meant for files that one program reads, such as a list of
    missing labels."""
    spark = df.sparkSession
    rows = df.coalesce(1).sortWithinPartitions(*order) if order else df.coalesce(1)
    staged = path + ".parts"
    rows.select(*(columns or df.columns)).write.mode("overwrite").csv(staged, header=header)
    jvm = spark.sparkContext._jvm
    at, folder = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(staged)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    fs.delete(at, True)
    if len(parts) == 1 and not fs.rename(parts[0], at):
        raise OSError(f"could not move {parts[0]}")
    if not parts:  # no rows and no header: an empty file
        fs.create(at).close()
    fs.delete(folder, True)
