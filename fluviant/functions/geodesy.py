"""WGS84: geodesic lengths, the equal-area cylinder, spherical Mercator."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the WGS84 ellipsoid.
A = 6378137.0
FLATTENING = 1 / 298.257223563
B = A * (1 - FLATTENING)
E2 = FLATTENING * (2 - FLATTENING)
E1 = math.sqrt(E2)

#: Lengths below the first are set to the second, metres.
LEAST_LENGTH, SHORT_LENGTH = 1e-7, 0.01


def geodesic_distance(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Vincenty's inverse formula for arrays of points in degrees; metres.

    Nearly antipodal points, where it does not converge, do not occur on streams;
    they keep the value of the last round."""
    u1, u2 = (np.arctan((1 - FLATTENING) * np.tan(np.radians(v))) for v in (lat1, lat2))
    span = np.radians(lon2 - lon1)
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = span.copy()
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(60):
            sl, cl = np.sin(lam), np.cos(lam)
            sin_s = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
            cos_s = s1 * s2 + c1 * c2 * cl
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s > 0, c1 * c2 * sl / sin_s, 0.0)
            cos2a = 1 - sin_a**2
            cos2m = np.where(cos2a > 1e-15, cos_s - 2 * s1 * s2 / cos2a, 0.0)
            c = FLATTENING / 16 * cos2a * (4 + FLATTENING * (4 - 3 * cos2a))
            new = span + (1 - c) * FLATTENING * sin_a * (sigma + c * sin_s * (cos2m + c * cos_s * (2 * cos2m**2 - 1)))
            settled = np.abs(new - lam).max(initial=0.0) < 1e-13
            lam = new
            if settled:
                break
    u = cos2a * (A**2 - B**2) / B**2
    k = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
    m = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    swing = m * sin_s * (cos2m + m / 4 * (cos_s * (2 * cos2m**2 - 1) - m / 6 * cos2m * (4 * sin_s**2 - 3) * (4 * cos2m**2 - 3)))
    return np.where(sin_s > 0, B * k * (sigma - swing), 0.0)


def _lengths(lines: pa.Array) -> np.ndarray:
    """Metres of each line, all edges of the batch at once."""
    parts = lines.flatten()
    owner = np.repeat(np.arange(len(lines)), lines.value_lengths().fill_null(0).to_numpy())
    sizes = parts.value_lengths().fill_null(0).to_numpy()
    points = parts.flatten()
    if len(points) < 2:
        return np.zeros(len(lines))
    x, y = (points.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    part = np.repeat(np.arange(len(sizes)), sizes)
    edge = np.flatnonzero(part[1:] == part[:-1])
    metres = geodesic_distance(x[edge], y[edge], x[edge + 1], y[edge + 1])
    return np.bincount(owner[part[edge]], metres, len(lines))


def _geodesic_lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for lines in batches:
        length = _lengths(lines)
        yield pa.array(np.where(length < LEAST_LENGTH, SHORT_LENGTH, length))


def geodesic_length(line: Column | str) -> Column:
    """Metres along all parts of a line; practically zero becomes 0.01; a null line is zero long."""
    return F.arrow_udf(_geodesic_lengths, "double")(line)


def _q(sin_lat: Column) -> Column:
    es = E1 * sin_lat
    return (1 - E2) * (sin_lat / (1 - es * es) - F.log((1 - es) / (1 + es)) / (2 * E1))


def equal_area_x(lon: Column) -> Column:
    """Metres east on the equal-area cylinder with its standard parallel at the equator."""
    return A * F.radians(lon)


def equal_area_y(lat: Column) -> Column:
    """Metres north on the equal-area cylinder."""
    return A * _q(F.sin(F.radians(lat))) / 2


def mercator_x(lon: Column) -> Column:
    return A * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    """Spherical Mercator, as web maps use it."""
    return A * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))


def mercator_lon(x: Column) -> Column:
    """Degrees east of spherical Mercator metres."""
    return F.degrees(x / A)


def mercator_lat(y: Column) -> Column:
    """Degrees north of spherical Mercator metres."""
    return F.degrees(2 * F.atan(F.exp(y / A)) - math.pi / 2)
