"""Queries for the cleaning operators (B) and the flagship top-10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions.parse import parse_cost, parse_minutes, parse_rating
from ladle.operators import clean as C
from ladle.operators.recommend import bayesian_rating
from ladle.plans.catalog import finish, register
from ladle.plans.scale import materialize
from ladle.plans.sql_blocks import COST, MINUTES, RATE, bayes, deliveries_clean, median_of, mode_of, restaurants_clean
from ladle.plans.views_sql import with_views
from ladle.sources.fixtures import deliveries_raw, restaurants_raw


def clean_restaurants_df(spark, sf):
    return C.clean_restaurants(restaurants_raw(spark, sf))


def clean_deliveries_df(spark, sf):
    return C.clean_deliveries(deliveries_raw(spark, sf))


@register("top_restaurants_bayes", with_views(
    """SELECT restaurant_id, name, rate, votes, round(bayesian_rating, 6) AS bayesian_rating
FROM restaurants_bayes ORDER BY bayesian_rating DESC, restaurant_id LIMIT 10""",
    "restaurants_raw", extra={**restaurants_clean(), **bayes()}))
def top_restaurants_bayes(spark, sf):
    """Flagship: raw listings -> clean -> Bayesian rating -> top 10."""
    df = bayesian_rating(materialize(clean_restaurants_df(spark, sf)))
    top = df.orderBy(F.desc("bayesian_rating"), "restaurant_id").limit(10)
    return finish(top.select("restaurant_id", "name", "rate", "votes", "bayesian_rating"))


@register("parse_rating", with_views(
    f"SELECT restaurant_id, rate AS rate_text, round({RATE}, 6) AS rate FROM restaurants_raw", "restaurants_raw"))
def q_parse_rating(spark, sf):
    r = restaurants_raw(spark, sf)
    return finish(r.select("restaurant_id", F.col("rate").alias("rate_text"), parse_rating("rate").alias("rate")))


@register("parse_cost", with_views(
    f"SELECT restaurant_id, cost_text, round({COST}, 6) AS cost_for_two FROM restaurants_raw", "restaurants_raw"))
def q_parse_cost(spark, sf):
    r = restaurants_raw(spark, sf)
    return finish(r.select("restaurant_id", "cost_text", parse_cost("cost_text").alias("cost_for_two")))


@register("parse_minutes", with_views(
    f"SELECT order_id, time_text, round({MINUTES}, 6) AS time_taken_min FROM deliveries_raw", "deliveries_raw"))
def q_parse_minutes(spark, sf):
    d = deliveries_raw(spark, sf)
    return finish(d.select("order_id", "time_text", parse_minutes(F.trim("time_text")).alias("time_taken_min")))


@register("dedupe_rows", with_views(
    "SELECT DISTINCT festival, road_traffic_density, courier_age FROM deliveries_raw", "deliveries_raw"))
def q_dedupe(spark, sf):
    d = deliveries_raw(spark, sf).select("festival", "road_traffic_density", "courier_age")
    return finish(C.dedupe_rows(d))


@register("drop_missing_rating", with_views(
    f"SELECT restaurant_id, round(rate, 6) AS rate FROM (SELECT restaurant_id, {RATE} AS rate FROM restaurants_raw) "
    "WHERE rate IS NOT NULL", "restaurants_raw"))
def q_drop_missing(spark, sf):
    r = restaurants_raw(spark, sf).select("restaurant_id", parse_rating("rate").alias("rate"))
    return finish(C.drop_missing_target(r, "rate"))


@register("fill_mode", with_views(
    f"""SELECT restaurant_id, coalesce(cuisines, {mode_of('cuisines', 'restaurants_raw')}, 'Unknown') AS cuisines,
 coalesce(online_order, {mode_of('online_order', 'restaurants_raw')}, 'Unknown') AS online_order,
 coalesce(rate, {mode_of('rate', 'restaurants_raw')}, 'Unknown') AS rate FROM restaurants_raw""", "restaurants_raw"))
def q_fill_mode(spark, sf):
    r = restaurants_raw(spark, sf).select("restaurant_id", "cuisines", "online_order", "rate")
    return finish(C.fill_mode(r, ["cuisines", "online_order", "rate"]))


@register("fill_median", with_views(
    f"""SELECT restaurant_id, round(coalesce(cost_for_two, {median_of('cost_for_two', 'p')}), 6) AS cost_for_two,
 round(coalesce(rate, {median_of('rate', 'p')}), 6) AS rate FROM p""", "restaurants_raw",
    extra={"p": f"SELECT restaurant_id, {COST} AS cost_for_two, {RATE} AS rate FROM restaurants_raw"}))
def q_fill_median(spark, sf):
    r = restaurants_raw(spark, sf).select(
        "restaurant_id", parse_cost("cost_text").alias("cost_for_two"), parse_rating("rate").alias("rate"))
    return finish(C.fill_median(r, ["cost_for_two", "rate"]))


@register("normalize_columns", with_views(
    "SELECT restaurant_id AS restaurant_id, rate AS rate, cost_text AS approx_cost_for_two_people, "
    "online_order AS online_order FROM restaurants_raw", "restaurants_raw"))
def q_normalize(spark, sf):
    r = restaurants_raw(spark, sf).select(
        F.col("restaurant_id").alias(" Restaurant ID "), F.col("rate").alias("Rate"),
        F.col("cost_text").alias("approx_cost(for two people)"), F.col("online_order").alias("Online Order"))
    return finish(C.normalize_columns(r))


@register("trim_strings", with_views(
    "SELECT order_id, trim(time_text) AS time_text, trim(festival) AS festival, "
    "trim(road_traffic_density) AS road_traffic_density FROM deliveries_raw", "deliveries_raw"))
def q_trim(spark, sf):
    d = deliveries_raw(spark, sf).select(
        "order_id", F.concat(F.lit("  "), "time_text", F.lit(" ")).alias("time_text"), "festival",
        "road_traffic_density")
    return finish(C.trim_strings(d))


@register("filter_geo_range", with_views(
    """SELECT order_id, round(restaurant_latitude, 6) AS restaurant_latitude,
 round(delivery_longitude, 6) AS delivery_longitude FROM
 (SELECT order_id, CASE WHEN order_id % 13 = 0 THEN restaurant_latitude * 10 ELSE restaurant_latitude END AS restaurant_latitude,
   CASE WHEN order_id % 17 = 0 THEN NULL ELSE delivery_longitude END AS delivery_longitude FROM deliveries_raw)
WHERE (restaurant_latitude IS NULL OR restaurant_latitude BETWEEN 6 AND 37)
  AND (delivery_longitude IS NULL OR delivery_longitude BETWEEN 68 AND 98)""", "deliveries_raw"))
def q_geo(spark, sf):
    d = deliveries_raw(spark, sf)
    # every 13th latitude is pushed out of range and every 17th longitude
    # blanked, so both the drop and the null-passes rule are exercised
    d = d.select(
        "order_id",
        F.when(F.col("order_id") % 13 == 0, F.col("restaurant_latitude") * 10)
        .otherwise(F.col("restaurant_latitude")).alias("restaurant_latitude"),
        F.when(F.col("order_id") % 17 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("delivery_longitude")).alias("delivery_longitude"))
    return finish(C.filter_geo_range(d))


@register("filter_duration", with_views(
    f"""SELECT order_id, round(time_taken_min, 6) AS time_taken_min FROM
 (SELECT order_id, {MINUTES} AS time_taken_min FROM deliveries_raw)
 WHERE time_taken_min IS NOT NULL AND time_taken_min > 0 AND time_taken_min <= 120""", "deliveries_raw"))
def q_duration(spark, sf):
    d = deliveries_raw(spark, sf).select("order_id", parse_minutes("time_text").alias("time_taken_min"))
    return finish(C.filter_duration(d))


@register("clean_restaurants", with_views(
    """SELECT restaurant_id, name, round(rate, 6) AS rate, round(cost_for_two, 6) AS cost_for_two, cuisines,
 location, online_order, votes FROM restaurants_clean""", "restaurants_raw", extra=restaurants_clean()))
def q_clean_restaurants(spark, sf):
    return finish(clean_restaurants_df(spark, sf))


@register("clean_deliveries", with_views(
    """SELECT order_id, user_id, CAST(order_ts AS VARCHAR) AS order_ts, round(time_taken_min, 6) AS time_taken_min,
 round(restaurant_latitude, 6) AS restaurant_latitude, round(restaurant_longitude, 6) AS restaurant_longitude,
 round(delivery_latitude, 6) AS delivery_latitude, round(delivery_longitude, 6) AS delivery_longitude,
 festival, road_traffic_density, courier_age FROM deliveries_clean""", "deliveries_raw", extra=deliveries_clean()))
def q_clean_deliveries(spark, sf):
    return finish(clean_deliveries_df(spark, sf))
