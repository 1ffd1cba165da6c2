"""Delivery features (D1-D16): one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.encode import festival_flag, traffic_ordinal, weather_ordinal
from ladle.functions.geo import city_zone, haversine_km
from ladle.functions.time import (
    age_bucket, cyclical_cos, cyclical_sin, hour_bucket, is_rush_hour, order_time_parts,
)

ETA_FEATURES = [
    "haversine_distance_km", "city_zone", "order_hour", "day_of_week", "is_weekend", "is_rush_hour",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "order_hour_bucket", "traffic_ordinal", "is_festival",
    "weather_encoded", "distance_traffic_interaction", "distance_festival_interaction",
    "delivery_person_age", "delivery_person_ratings", "vehicle_condition", "delivery_person_age_bucket",
]
ETA_CATEGORICAL = ["city_zone", "order_hour_bucket", "delivery_person_age_bucket"]
ETA_NUMERIC = [c for c in ETA_FEATURES if c not in ETA_CATEGORICAL]


def _first(cols, *names):
    for n in names:
        if n in cols:
            return n
    return None


def add_delivery_features(df: DataFrame, date_col: str = "order_date", age_col: str = "delivery_person_age",
                          drop_incomplete: bool = True) -> DataFrame:
    """D1-D13, each guarded by column presence, in a single select."""
    cols = list(df.columns)
    new: dict[str, Column] = {}
    rlat = _first(cols, "restaurant_latitude")
    rlon = _first(cols, "restaurant_longitude")
    dlat = _first(cols, "delivery_location_latitude", "delivery_latitude")
    dlon = _first(cols, "delivery_location_longitude", "delivery_longitude")
    if rlat and rlon and dlat and dlon:
        new["haversine_distance_km"] = haversine_km(rlat, rlon, dlat, dlon)
        new["city_zone"] = city_zone(rlat, rlon)
    if date_col in cols:
        parts = order_time_parts(date_col)
        h, d = parts["order_hour"], parts["day_of_week"]
        new.update(parts)
        new["is_rush_hour"] = is_rush_hour(h)
        new["hour_sin"], new["hour_cos"] = cyclical_sin(h, 24), cyclical_cos(h, 24)
        new["dow_sin"], new["dow_cos"] = cyclical_sin(d, 7), cyclical_cos(d, 7)
        new["order_hour_bucket"] = hour_bucket(h)
    if "festival" in cols:
        new["is_festival"] = festival_flag("festival")
    if "road_traffic_density" in cols:
        new["traffic_ordinal"] = traffic_ordinal("road_traffic_density")
    weather = [c for c in cols if "weather" in c.lower()]
    if weather:
        new["weather_encoded"] = weather_ordinal(weather[0])
    dist = new.get("haversine_distance_km")
    if dist is not None and "traffic_ordinal" in new:
        new["distance_traffic_interaction"] = dist * (new["traffic_ordinal"] + 1)
    if dist is not None and "is_festival" in new:
        new["distance_festival_interaction"] = dist * new["is_festival"]
    if age_col in cols:
        age = F.col(age_col).try_cast("double")
        new[age_col] = age
        new["delivery_person_age_bucket"] = age_bucket(age)
    if dist is not None and "time_taken_min" in cols:
        new["speed_kmh"] = F.try_divide(dist, F.col("time_taken_min") / 60)
    out = df.withColumns(new) if new else df
    if drop_incomplete:
        key = ["time_taken_min"] + (["haversine_distance_km"] if dist is not None else [])
        key = [k for k in key if k in out.columns]
        if key:
            out = out.na.drop(subset=key)
    return out


def eta_contract(df: DataFrame) -> DataFrame:
    """The 20 model columns in order; numeric nulls -> 0 (missing ones added as 0)."""
    sel = []
    for c in ETA_FEATURES:
        if c in df.columns:
            sel.append(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in ETA_NUMERIC else F.col(c))
        else:
            sel.append((F.lit(0.0) if c in ETA_NUMERIC else F.lit("unknown")).alias(c))
    return df.select(*[c for c in df.columns if c not in ETA_FEATURES], *sel)


REQUEST_INPUTS = ["distance_km", "traffic_level", "is_festival", "delivery_person_age", "delivery_person_rating",
                  "vehicle_condition", "order_hour", "day_of_week", "weather_encoded", "city_zone"]


def eta_request_features(requests: DataFrame, now_hour: int, now_dow: int) -> DataFrame:
    """Request rows -> the full ETA feature vector.

    Inputs (all optional but distance_km): traffic_level, is_festival,
    delivery_person_age, delivery_person_rating, vehicle_condition,
    order_hour, day_of_week, weather_encoded, city_zone. Null means "use the
    default" (age 30, rating 4.0, vehicle 1, weather 1, zone unknown,
    traffic 1, hour / weekday = the given 'now', so runs repeat). Other
    request columns (ids) are kept.
    """
    cols = set(requests.columns)
    g = lambda c, d: F.coalesce(F.col(c), F.lit(d)) if c in cols else F.lit(d)
    dist = F.col("distance_km").cast("double")
    hour = g("order_hour", now_hour).cast("bigint")
    dow = g("day_of_week", now_dow).cast("bigint")
    traffic = g("traffic_level", 1).cast("bigint")
    fest = F.when(g("is_festival", False).cast("boolean"), 1).otherwise(0).cast("bigint")
    age = g("delivery_person_age", 30.0).cast("double")
    keep = [c for c in requests.columns if c not in REQUEST_INPUTS]
    return requests.select(
        *keep,
        dist.alias("haversine_distance_km"),
        g("city_zone", "unknown").alias("city_zone"),
        hour.alias("order_hour"),
        dow.alias("day_of_week"),
        F.when(dow >= 5, 1).otherwise(0).cast("bigint").alias("is_weekend"),
        is_rush_hour(hour).alias("is_rush_hour"),
        cyclical_sin(hour, 24).alias("hour_sin"), cyclical_cos(hour, 24).alias("hour_cos"),
        cyclical_sin(dow, 7).alias("dow_sin"), cyclical_cos(dow, 7).alias("dow_cos"),
        hour_bucket(hour).alias("order_hour_bucket"),
        traffic.alias("traffic_ordinal"),
        fest.alias("is_festival"),
        g("weather_encoded", 1).cast("bigint").alias("weather_encoded"),
        (dist * (traffic + 1)).alias("distance_traffic_interaction"),
        (dist * fest).alias("distance_festival_interaction"),
        age.alias("delivery_person_age"),
        g("delivery_person_rating", 4.0).cast("double").alias("delivery_person_ratings"),
        g("vehicle_condition", 1).cast("bigint").alias("vehicle_condition"),
        age_bucket(age).alias("delivery_person_age_bucket"),
    )
