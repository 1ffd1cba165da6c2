"""Time-of-day expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.dims import RUSH_HOURS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def order_time_parts(col) -> dict[str, Column]:
    """hour, Monday=0 weekday and weekend flag; unparsable -> 0, 0, 0."""
    c = _c(col)
    ts = F.coalesce(c.try_cast("timestamp"), F.try_to_timestamp(c.cast("string")))
    dow = F.weekday(ts)
    return {
        "order_hour": F.coalesce(F.hour(ts), F.lit(0)).cast("bigint"),
        "day_of_week": F.coalesce(dow, F.lit(0)).cast("bigint"),
        "is_weekend": F.when(dow >= 5, 1).otherwise(0).cast("bigint"),
    }


def is_rush_hour(hour) -> Column:
    return F.when(_c(hour).isin(RUSH_HOURS), 1).otherwise(0).cast("bigint")


def cyclical_sin(col, period: float) -> Column:
    return F.sin(_c(col).cast("double") * F.lit(2 * math.pi / period))


def cyclical_cos(col, period: float) -> Column:
    return F.cos(_c(col).cast("double") * F.lit(2 * math.pi / period))


def hour_bucket(hour) -> Column:
    h = _c(hour)
    return (
        F.when(h.isNull(), "unknown")
        .when((h >= 5) & (h < 11), "breakfast")
        .when((h >= 11) & (h < 16), "lunch")
        .when((h >= 16) & (h < 21), "evening")
        .otherwise("late_night")
    )


def age_bucket(age) -> Column:
    a = _c(age).try_cast("double") if not isinstance(age, Column) else age.cast("double")
    return (
        F.when(a.isNull() | (a <= 0), "mid")
        .when(a <= 25, "young")
        .when(a <= 35, "mid")
        .when(a <= 45, "senior")
        .otherwise("veteran")
    )
