"""Distance and zone expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; null if any coordinate is null."""
    p1, l1, p2, l2 = (F.radians(_c(x)) for x in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    # clamp rounding overshoot above 1; ``least`` would skip a null and turn
    # missing coordinates into half the Earth's circumference
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(a > 1.0, F.lit(1.0)).otherwise(a)))


def city_zone(lat, lon) -> Column:
    """Broad zone from restaurant coordinates; the first matching rule wins."""
    la, lo = _c(lat), _c(lon)
    return (
        F.when(la.isNull() | lo.isNull() | F.isnan(la) | F.isnan(lo), "unknown")
        .when(la.between(12.96, 13.01) & lo.between(77.58, 77.65), "central")
        .when(la > 13.01, "north")
        .when(la < 12.91, "south")
        .when(lo > 77.68, "east")
        .otherwise("west")
    )
