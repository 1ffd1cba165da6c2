"""Column expressions (JVM-side, codegen-friendly); no Python UDFs here."""

from ladle.functions.parse import parse_cost, parse_minutes, parse_rating, to_double_strict
from ladle.functions.geo import city_zone, haversine_km
from ladle.functions.time import (
    age_bucket, cyclical_cos, cyclical_sin, hour_bucket, is_rush_hour, order_time_parts,
)
from ladle.functions.encode import (
    cost_bucket, cuisine_count, festival_flag, reliability_band, traffic_ordinal,
    votes_log, weather_ordinal, yes_no_flag,
)

__all__ = [
    "parse_cost", "parse_minutes", "parse_rating", "to_double_strict", "city_zone", "haversine_km",
    "age_bucket", "cyclical_cos", "cyclical_sin", "hour_bucket", "is_rush_hour", "order_time_parts",
    "cost_bucket", "cuisine_count", "festival_flag", "reliability_band", "traffic_ordinal",
    "votes_log", "weather_ordinal", "yes_no_flag",
]
