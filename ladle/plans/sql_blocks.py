"""Reusable oracle SQL fragments (DuckDB dialect), as named CTE bodies.

They restate, in plain SQL, what the Spark operators compute, so the oracle
is an independent second implementation.
"""

from __future__ import annotations

NUM = r"'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'"


def strict_double(expr: str) -> str:
    return f"CASE WHEN regexp_full_match({expr}, {NUM}) THEN TRY_CAST({expr} AS DOUBLE) END"


def mode_of(col: str, src: str) -> str:
    return (f"(SELECT v FROM (SELECT CAST({col} AS VARCHAR) AS v, count(*) AS c FROM {src} "
            f"WHERE {col} IS NOT NULL GROUP BY 1) ORDER BY c DESC, v ASC LIMIT 1)")


def median_of(col: str, src: str) -> str:
    return f"(SELECT quantile_cont({col}, 0.5) FROM {src})"


RATE = strict_double(r"regexp_extract(trim(rate), '^([0-9.]+)\s*/\s*5', 1)")
COST = strict_double("regexp_replace(cost_text, '[, ₹]', '', 'g')")
MINUTES = strict_double("regexp_replace(trim(time_text), '[^0-9.]', '', 'g')")


def restaurants_clean() -> dict[str, str]:
    """CTEs ending in ``restaurants_clean`` (needs ``restaurants_raw``)."""
    return {
        "rc_p": f"""SELECT restaurant_id, name, {RATE} AS rate, {COST} AS cost_for_two, cuisines, location,
 online_order, votes FROM (SELECT DISTINCT * FROM restaurants_raw)""",
        "rc_f": "SELECT * FROM rc_p WHERE rate IS NOT NULL",
        "restaurants_clean": f"""SELECT
 coalesce(restaurant_id, CAST({median_of('restaurant_id', 'rc_f')} AS BIGINT)) AS restaurant_id,
 coalesce(name, {mode_of('name', 'rc_f')}, 'Unknown') AS name,
 rate,
 coalesce(cost_for_two, {median_of('cost_for_two', 'rc_f')}) AS cost_for_two,
 coalesce(cuisines, {mode_of('cuisines', 'rc_f')}, 'Unknown') AS cuisines,
 coalesce(location, {mode_of('location', 'rc_f')}, 'Unknown') AS location,
 coalesce(online_order, {mode_of('online_order', 'rc_f')}, 'Unknown') AS online_order,
 coalesce(votes, CAST({median_of('votes', 'rc_f')} AS BIGINT)) AS votes
FROM rc_f""",
    }


def deliveries_clean() -> dict[str, str]:
    """CTEs ending in ``deliveries_clean`` (needs ``deliveries_raw``)."""
    return {
        "dc_p": f"""SELECT order_id, user_id, order_ts, {MINUTES} AS time_taken_min,
 restaurant_latitude, restaurant_longitude, delivery_latitude, delivery_longitude,
 trim(festival) AS festival, trim(road_traffic_density) AS road_traffic_density, courier_age
FROM (SELECT DISTINCT * FROM deliveries_raw)""",
        "dc_f": """SELECT * FROM dc_p WHERE
 (restaurant_latitude IS NULL OR restaurant_latitude BETWEEN 6 AND 37) AND
 (delivery_latitude IS NULL OR delivery_latitude BETWEEN 6 AND 37) AND
 (restaurant_longitude IS NULL OR restaurant_longitude BETWEEN 68 AND 98) AND
 (delivery_longitude IS NULL OR delivery_longitude BETWEEN 68 AND 98) AND
 time_taken_min IS NOT NULL AND time_taken_min > 0 AND time_taken_min <= 120""",
        "deliveries_clean": f"""SELECT order_id, user_id, order_ts, time_taken_min,
 restaurant_latitude, restaurant_longitude, delivery_latitude, delivery_longitude,
 coalesce(festival, {mode_of('festival', 'dc_f')}, 'Unknown') AS festival,
 coalesce(road_traffic_density, {mode_of('road_traffic_density', 'dc_f')}, 'Unknown') AS road_traffic_density,
 courier_age
FROM dc_f""",
    }


def bayes(src: str = "restaurants_clean") -> dict[str, str]:
    """``bayes_stats`` (C, m) and ``restaurants_bayes`` with bayesian_rating."""
    return {
        "bayes_stats": f"SELECT avg(rate) AS c, quantile_cont(votes, 0.25) AS m FROM {src}",
        "restaurants_bayes": f"""SELECT r.*, CASE WHEN coalesce(r.votes,0) + s.m = 0 THEN NULL ELSE
 coalesce(r.votes,0) / (coalesce(r.votes,0) + s.m) * coalesce(r.rate, s.c) + s.m / (coalesce(r.votes,0) + s.m) * s.c END
 AS bayesian_rating FROM {src} r, bayes_stats s""",
    }
