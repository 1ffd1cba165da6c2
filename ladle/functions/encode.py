"""Small encodings."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.dims import TRAFFIC_CODES, WEATHER_CODES


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lookup(mapping: dict, key: Column) -> Column:
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return m[key]


def cost_bucket(col) -> Column:
    """Right-closed bins (0,200] ... (2000,inf); <= 0 or null -> null."""
    c = _c(col)
    return (
        F.when(c.isNull() | (c <= 0), F.lit(None).cast("string"))
        .when(c <= 200, "budget")
        .when(c <= 500, "affordable")
        .when(c <= 1000, "moderate")
        .when(c <= 2000, "premium")
        .otherwise("luxury")
    )


def cuisine_count(col) -> Column:
    return F.coalesce(F.size(F.split(_c(col), ",")), F.lit(1)).cast("bigint")


def yes_no_flag(col) -> Column:
    return F.when(_c(col) == "Yes", 1).otherwise(0).cast("bigint")


festival_flag = yes_no_flag


def votes_log(col) -> Column:
    return F.log1p(F.coalesce(_c(col).cast("double"), F.lit(0.0)))


def traffic_ordinal(col) -> Column:
    return F.coalesce(_lookup(TRAFFIC_CODES, _c(col)), F.lit(1)).cast("bigint")


def weather_ordinal(col) -> Column:
    return F.coalesce(_lookup(WEATHER_CODES, F.lower(_c(col))), F.lit(1)).cast("bigint")


def reliability_band(col) -> Column:
    c = _c(col)
    return F.when(c >= 0.7, "high").when(c >= 0.4, "moderate").otherwise("low")
