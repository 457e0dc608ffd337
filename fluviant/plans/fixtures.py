"""A river network stamped from the driver's ``orders`` table.

A template of 40 segments is repeated for each block of 40 orders; lengths come
from the order's price. The last block may be short: a segment whose parent it lacks
is an outlet. ``SQL`` holds the same tables for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lines import box, point
from ..session import spread
from ..sources.header_numbers import header_numbers

#: Slot, parent slot, Strahler order, magnitude, zero length.
TEMPLATE = [
    (0, -1, 3, 15, 0), (1, 0, 3, 13, 0), (2, 14, 3, 8, 0), (3, 2, 2, 3, 0), (4, 2, 2, 4, 0), (5, 3, 1, 1, 0), (6, 3, 1, 1, 0), (7, 4, 1, 1, 0),
    (8, 4, 1, 1, 0), (9, 4, 1, 1, 0), (10, 0, 1, 1, 0), (11, 1, 1, 1, 0), (12, 1, 1, 1, 0), (13, 1, 3, 10, 0), (14, 13, 3, 9, 0), (15, -1, 3, 8, 0),
    (16, 15, 2, 3, 0), (17, 15, 2, 3, 0), (18, 15, 1, 1, 0), (19, 16, 1, 1, 0), (20, 16, 1, 1, 0), (21, 17, 1, 1, 0), (22, 17, 1, 1, 0), (23, -1, 2, 10, 0),
    (24, 23, 2, 5, 0), (25, 24, 2, 3, 1), (26, 24, 1, 1, 0), (27, 25, 1, 1, 0), (28, 25, 1, 1, 0), (29, 23, 1, 3, 1), (30, 29, 1, 2, 1), (31, 30, 1, 1, 0),
    (32, -1, 1, 1, 1), (33, -1, 2, 3, 1), (34, 33, 1, 1, 0), (35, 33, 1, 1, 0), (36, 23, 1, 1, 1), (37, -1, 2, 3, 0), (38, 37, 1, 1, 0), (39, 37, 1, 1, 0),
]

#: Half-width of a basin in degrees; of the wide basins that meet several grid cells.
HALF_WIDTH, WIDE = 0.005, 0.1


def _x(block: Column, slot: Column) -> Column:
    return -120.0 + 0.5 * (block % 50) + 0.01 * (slot % 8)


def _y(block: Column, slot: Column) -> Column:
    return 40.0 + 0.5 * F.floor(block / 50) + 0.01 * F.floor(slot / 8)


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks, slots and template values of all ``orders``."""
    orders = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice"))
    n = orders.count()
    shape = spark.createDataFrame(TEMPLATE, "slot long, parent long, strmOrder int, magn long, zero int")
    rows = orders.withColumn("b", F.floor(F.col("o_orderkey") / 40)).withColumn("slot", F.col("o_orderkey") % 40).join(F.broadcast(shape), "slot")
    there = 40 * F.col("b") + F.col("parent") < n
    return rows.withColumns({"parent": F.when(there, F.col("parent")).otherwise(F.lit(-1).cast("long")), "h": 11 + F.col("b") % 5})


def raw_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source layer: local ids within a region, as they are before ids become global."""
    b, slot, parent = F.col("b"), F.col("slot"), F.col("parent")
    scale = F.col("magn") * 6e7 * (10 + b % 7) / 10
    own = point(_x(b, slot), _y(b, slot))
    to = F.when(F.col("zero") == 1, own).when(parent == -1, point(_x(b, slot), _y(b, slot) - 0.01)).otherwise(point(_x(b, parent), _y(b, parent)))
    regions = F.broadcast(header_numbers(spark).withColumnRenamed("region_number", "TDXHydroRegion"))
    return stamped(spark, sf_dir).join(regions, F.col("h") == F.col("header")).select(
        F.col("o_orderkey").alias("LINKNO"),
        F.when(parent == -1, F.lit(-1).cast("long")).otherwise(40 * b + parent).alias("DSLINKNO"),
        "strmOrder",
        F.col("magn").alias("Magnitude"),
        ((F.col("magn") - 1) * 6e7 * (10 + b % 7) / 10).alias("USContArea"),
        scale.alias("DSContArea"),
        F.when(F.col("zero") == 1, 0.01).otherwise(F.col("o_totalprice") / 500).alias("LengthGeodesicMeters"),
        "TDXHydroRegion",
        F.array(F.array(own, to)).alias("geometry"),
    )


def streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream table with global ids."""
    from ..operators.ingest import globalize

    return globalize(raw_streams(spark, sf_dir), header_numbers(spark))


def basins(spark: SparkSession, sf_dir: str, half_width: float = HALF_WIDTH) -> DataFrame:
    """A square basin around each segment's own position."""
    b, slot = F.col("b"), F.col("slot")
    link = F.col("h") * 10_000_000 + F.col("o_orderkey")
    return stamped(spark, sf_dir).select(link.alias("LINKNO"), box(_x(b, slot), _y(b, slot), half_width).alias("geometry"))


def elbow_basins(spark: SparkSession, sf_dir: str, radius: float = 0.2) -> DataFrame:
    """Concave basins: a square around each segment's position without its north-east quarter."""
    b, slot = F.col("b"), F.col("slot")
    x, y, r = _x(b, slot), _y(b, slot), radius
    ring = [(x - r, y - r), (x + r, y - r), (x + r, y), (x, y), (x, y + r), (x - r, y + r), (x - r, y - r)]
    link = F.col("h") * 10_000_000 + F.col("o_orderkey")
    return stamped(spark, sf_dir).select(link.alias("LINKNO"), F.array(F.array(*[point(a, c) for a, c in ring])).alias("geometry"))


def meridian_basins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Square basins on both sides of the zero meridian."""
    b, slot = F.col("b"), F.col("slot")
    return stamped(spark, sf_dir).select(F.col("o_orderkey").alias("LINKNO"), box((_x(b, slot) + 120) / 100 - 0.1, _y(b, slot), HALF_WIDTH).alias("geometry"))


def price_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``b, geometry``: a line of up to 40 points for each block, its ordinates the orders' prices."""
    rows = stamped(spark, sf_dir).select("b", "slot", (F.col("slot") * 0.01).alias("x"), (F.col("o_totalprice") / 1e6).alias("y"))
    points = F.transform(F.sort_array(F.collect_list(F.struct("slot", "x", "y"))), lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y")))
    return rows.groupBy("b").agg(F.array(points).alias("geometry"))


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One path through all customers, each draining into the next; every seventh is marked."""
    keys = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("long").alias("LINKNO"))
    last = keys.agg(F.max("LINKNO")).first()[0]
    return keys.select("LINKNO", F.when(F.col("LINKNO") == last, F.lit(-1).cast("long")).otherwise(F.col("LINKNO") + 1).alias("DSLINKNO"), (F.col("LINKNO") % 7 == 3).alias("mark"))


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers draining into the first, their order shuffled."""
    key = F.col("s_suppkey").cast("long")
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(key.alias("LINKNO"))
    first = rows.agg(F.min("LINKNO")).first()[0]
    down = F.when(F.col("LINKNO") == first, F.lit(-1)).otherwise(F.lit(first)).cast("long")
    return rows.select("LINKNO", down.alias("DSLINKNO"), (F.col("LINKNO") * 7 % 1009).alias("TopologicalOrder"))


def lakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stamped(spark, sf_dir).where((F.col("b") % 3 == 0) & F.col("slot").isin(14, 23))
    return rows.select((F.col("h") * 10_000_000 + F.col("o_orderkey")).alias("LINKNO"))


def vpu(spark: SparkSession, sf_dir: str, complete: bool = True) -> DataFrame:
    """Unit codes of all segments that are outlets once zero-length ones are gone."""
    rows = stamped(spark, sf_dir).where((F.col("parent") == -1) | F.col("slot").isin(34, 35))
    if not complete:
        rows = rows.where(F.col("b") % 11 != 0)
    return rows.select((F.col("h") * 10_000_000 + F.col("o_orderkey")).alias("TerminalLink"), (100 + F.col("b") % 7).alias("VPUCode"))


def grid_axis(spark: SparkSession, step: float = 0.25) -> DataFrame:
    """Axes of a global grid: longitudes 0..360, latitudes 90..-90."""
    lon = spark.range(round(360 / step)).select(F.lit("lon").alias("axis"), F.col("id").cast("int").alias("idx"), (F.col("id") * step).alias("coord"))
    lat = spark.range(round(180 / step) + 1).select(F.lit("lat").alias("axis"), F.col("id").cast("int").alias("idx"), (90.0 - F.col("id") * step).alias("coord"))
    return lon.unionByName(lat)


_ROWS = ", ".join(str(r) for r in TEMPLATE)

#: The same tables as common table expressions for DuckDB.
SQL = f"""
    tmpl(slot, parent, so, magn, zero) AS (VALUES {_ROWS}),
    reg(h, region) AS (VALUES (11, '1020000010'), (12, '1020011530'), (13, '1020018110'), (14, '1020021940'), (15, '1020027430')),
    st AS (SELECT o.o_orderkey AS k, o.o_totalprice AS price, o.o_orderkey // 40 AS b, o.o_orderkey % 40 AS i,
                  CASE WHEN 40 * (o.o_orderkey // 40) + t.parent < (SELECT count(*) FROM orders) THEN t.parent ELSE -1 END AS parent, t.so, t.magn, t.zero, 11 + (o.o_orderkey // 40) % 5 AS h
           FROM orders o JOIN tmpl t ON t.slot = o.o_orderkey % 40),
    streams AS (SELECT CAST(h * 10000000 + k AS BIGINT) AS LINKNO, CAST(CASE WHEN parent = -1 THEN -1 ELSE h * 10000000 + 40 * b + parent END AS BIGINT) AS DSLINKNO,
                       so AS strmOrder, CAST(magn AS BIGINT) AS Magnitude, (magn - 1) * 6e7 * (10 + b % 7) / 10 AS USContArea, magn * 6e7 * (10 + b % 7) / 10 AS DSContArea,
                       CASE WHEN zero = 1 THEN 1e-2 ELSE price / 500e0 END AS LengthGeodesicMeters, region AS TDXHydroRegion, b, i,
                       -120e0 + 5e-1 * (b % 50) + 1e-2 * (i % 8) AS x, 40e0 + 5e-1 * (b // 50) + 1e-2 * (i // 8) AS y,
                       CASE WHEN zero = 1 OR parent = -1 THEN -120e0 + 5e-1 * (b % 50) + 1e-2 * (i % 8) ELSE -120e0 + 5e-1 * (b % 50) + 1e-2 * (parent % 8) END AS px,
                       CASE WHEN zero = 1 THEN 40e0 + 5e-1 * (b // 50) + 1e-2 * (i // 8) WHEN parent = -1 THEN 40e0 + 5e-1 * (b // 50) + 1e-2 * (i // 8) - 1e-2
                            ELSE 40e0 + 5e-1 * (b // 50) + 1e-2 * (parent // 8) END AS py
                FROM st JOIN reg USING (h)),
    lakes AS (SELECT LINKNO FROM streams WHERE b % 3 = 0 AND i IN (14, 23)),
    vpu AS (SELECT LINKNO AS TerminalLink, CAST(100 + b % 7 AS BIGINT) AS VPUCode, b FROM streams WHERE DSLINKNO = -1 OR i IN (34, 35))
"""
