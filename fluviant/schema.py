"""Column names and constants of the river-network tables."""

from __future__ import annotations

import pyarrow as pa

#: No downstream segment.
OUTLET = -1

#: Ids of a region start at header x this.
ID_SPACE = 10_000_000

#: Fixed values of the workload.
ZERO_LENGTH_M = 0.01
MIN_DRAINAGE_AREA_M2 = 200_000_000.0
MIN_HEADWATER_ORDER = 3
MIN_VELOCITY = 0.25
MIN_K_S, LAKE_MIN_K_S, MAX_K_S = 900, 3_600, 100_000
DEFAULT_X, LAKE_X = 0.25, 0.01
ZERO_ID_BOX_DEGREES = 0.015

STREAM_COLUMNS = ["LINKNO", "DSLINKNO", "strmOrder", "Magnitude", "USContArea", "DSContArea", "LengthGeodesicMeters", "TDXHydroRegion", "geometry"]
MASTER_COLUMNS = [
    "LINKNO", "DSLINKNO", "strmOrder", "USContArea", "DSContArea", "TDXHydroRegion", "VPUCode", "TopologicalOrder",
    "LengthGeodesicMeters", "TerminalLink", "musk_k", "musk_x",
]

#: Columns of a weight table, in the order of its files.
WEIGHT_SCHEMA = "LINKNO long, area_sqm double, lon_index int, lat_index int, lon double, lat double"

#: Lines are arrays of parts, a part an array of points; polygons are arrays of rings.
GEOMETRY = "array<array<struct<x:double,y:double>>>"
ARROW_GEOMETRY = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
