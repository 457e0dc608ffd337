"""Line simplification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..schema import ARROW_GEOMETRY, GEOMETRY


def douglas_peucker(points: np.ndarray, tolerance: float) -> np.ndarray:
    """The points that keep every dropped one within ``tolerance`` of the line; ends stay."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        way, mid = points[b] - points[a], points[a + 1 : b] - points[a]
        square = way @ way
        along = np.clip(mid @ way / square, 0, 1) if square > 0 else np.zeros(len(mid))
        off = np.hypot(*(mid - along[:, None] * way).T)
        far = int(off.argmax())
        if off[far] > tolerance:
            keep[a + 1 + far] = True
            todo += [(a, a + 1 + far), (a + 1 + far, b)]
    return points[keep]


def simplify_line(tolerance: float):
    """A function of a geometry column that simplifies each part."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lines in batches:
            out = []
            for line in lines.to_pylist():
                parts = [np.array([(p["x"], p["y"]) for p in part], float).reshape(-1, 2) for part in line or ()]
                parts = [douglas_peucker(p, tolerance) if len(p) > 2 else p for p in parts]
                out.append(None if line is None else [[{"x": x, "y": y} for x, y in p.tolist()] for p in parts])
            yield pa.array(out, ARROW_GEOMETRY)

    return F.arrow_udf(run, GEOMETRY)
