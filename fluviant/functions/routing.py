"""Muskingum parameters and small numeric helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MAX_K_S, MIN_VELOCITY


def velocity_factor(area_m2: Column, default: float | None = None, least: float = MIN_VELOCITY) -> Column:
    """Metres a second from the drainage area, rounded half to even at 3 digits, at
    least ``least``; null stays null, an area of 0 gives ``least``, a negative one
    raises. With ``default`` the area is not looked at."""
    if default is not None:
        return F.lit(max(float(default), least))
    raw = F.when(area_m2 < 0, F.raise_error(F.lit("negative drainage area")).cast("double")).when(area_m2 == 0, F.lit(0.0))
    raw = raw.otherwise(F.rint(F.exp(0.16842 * F.log(area_m2) - 4.68) * 1000) / 1000)
    return F.when(area_m2.isNotNull(), F.greatest(raw, F.lit(least)))


def musk_k(length_m: Column, velocity: Column) -> Column:
    """Travel time in whole seconds, half to even, within 0..100,000."""
    return F.least(F.greatest(F.rint(length_m / velocity).cast("long"), F.lit(0).cast("long")), F.lit(MAX_K_S).cast("long"))


def last_plus_max_of_others(value: str, order: str) -> Column:
    """Aggregate: the last value by ``order`` plus the largest of the others; the value itself if alone."""
    packed = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(value))))
    values = F.transform(packed, lambda s: s[value])
    others = F.slice(values, 1, F.greatest(F.size(values) - 1, F.lit(0)))
    return F.when(F.size(values) > 1, F.element_at(values, -1) + F.array_max(others)).otherwise(F.element_at(values, 1))


def scaled_mean(value: str, factor: float = 3.5) -> Column:
    """Aggregate: ``factor`` times the mean; the value itself if alone."""
    return F.when(F.count(value) > 1, F.avg(value) * factor).otherwise(F.max(value))
