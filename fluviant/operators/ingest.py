"""From source layers to stream and basin tables with global ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geodesy import geodesic_length
from ..schema import ID_SPACE, OUTLET, STREAM_COLUMNS
from ..session import ship_package


def globalize(layer: DataFrame, headers: DataFrame, region_col: str = "TDXHydroRegion") -> DataFrame:
    """The layer with ids shifted by its region's header; -1 stays -1.

    Works for streams (``LINKNO, DSLINKNO``) and basins (``LINKNO``). Rows of a region
    without a header number raise an error."""
    known = F.broadcast(headers.select(F.col("region_number").cast("string").alias(region_col), F.col("header").alias("__header")))
    shift = F.when(F.col("__header").isNull(), F.raise_error(F.concat(F.lit("no header number for region "), F.coalesce(region_col, F.lit("null")))).cast("long"))
    shift = shift.otherwise(F.col("__header").cast("long") * ID_SPACE)
    joined = layer.join(known, region_col, "left").withColumn("LINKNO", F.col("LINKNO").cast("long") + shift)
    if "DSLINKNO" in layer.columns:
        ds = F.col("DSLINKNO").cast("long")
        joined = joined.withColumn("DSLINKNO", F.when(ds == OUTLET, ds).otherwise(ds + shift))
    return joined.select(*layer.columns)


def ingest_streams(layer: DataFrame, headers: DataFrame) -> DataFrame:
    """Stream columns with global ids, an integer order and geodesic lengths."""
    ship_package(layer.sparkSession)
    rows = globalize(layer, headers).withColumn("strmOrder", F.col("strmOrder").cast("int"))
    return rows.withColumn("LengthGeodesicMeters", geodesic_length("geometry")).select(*STREAM_COLUMNS)


def ingest_basins(layer: DataFrame, headers: DataFrame) -> DataFrame:
    """All columns but the source's own id and region, with global ids; streams name a basin by ``streamID`` there."""
    return globalize(layer, headers).drop("streamID", "TDXHydroRegion")
