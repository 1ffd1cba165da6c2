"""Queries over the stored tables and exploratory aggregates (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.dims import CUISINES
from ladle.operators import lookups as LK
from ladle.plans.catalog import finish, register
from ladle.plans.common import STORED_SQL, deliveries, delivery_orders, restaurants, stored_restaurants
from ladle.plans.q_features import cuisine_sql
from ladle.plans.sql_blocks import deliveries_clean, restaurants_clean
from ladle.plans.views_sql import with_views


def rs(body: str, extra: dict | None = None) -> str:
    return with_views(body, "restaurants_raw", "interactions", extra={**restaurants_clean(), **STORED_SQL, **(extra or {})})


def ds(body: str, extra: dict | None = None) -> str:
    return with_views(body, "restaurants_raw", "interactions", "deliveries_raw",
                      extra={**restaurants_clean(), **deliveries_clean(), **STORED_SQL, **(extra or {})})


@register("list_restaurants", rs(
    """SELECT restaurant_id, name, CAST((SELECT count(*) FROM sr) AS BIGINT) AS total FROM sr
ORDER BY name, restaurant_id LIMIT 20 OFFSET 20"""))
def q_list(spark, sf):
    return finish(LK.list_restaurants(stored_restaurants(spark, sf), 20, 20).select("restaurant_id", "name", "total"))


@register("restaurant_by_id", rs("SELECT restaurant_id, name, location FROM sr WHERE restaurant_id = 42"))
def q_by_id(spark, sf):
    return finish(LK.restaurant_by_id(stored_restaurants(spark, sf), 42).select("restaurant_id", "name", "location"))


@register("restaurant_by_name", rs(
    "SELECT restaurant_id, name FROM sr WHERE name ILIKE '%blue%' ORDER BY restaurant_id LIMIT 1"))
def q_by_name(spark, sf):
    return finish(LK.restaurant_by_name(stored_restaurants(spark, sf), "BLUE").select("restaurant_id", "name"))


@register("by_cuisine", rs(
    """SELECT restaurant_id, name, round(bayesian_rating, 6) + 0.0 AS bayesian_rating FROM sr WHERE cuisines ILIKE '%biryani%'
ORDER BY bayesian_rating DESC NULLS LAST, restaurant_id LIMIT 20"""))
def q_by_cuisine(spark, sf):
    return finish(LK.by_cuisine(stored_restaurants(spark, sf), "Biryani").select("restaurant_id", "name", "bayesian_rating"))


@register("count_restaurants", rs("SELECT CAST(count(*) AS BIGINT) AS n_restaurants FROM sr"))
def q_count(spark, sf):
    return finish(LK.count_restaurants(stored_restaurants(spark, sf)))


@register("recent_orders", ds(
    "SELECT order_id, CAST(created_at AS VARCHAR) AS created_at FROM dord2 ORDER BY created_at DESC, order_id DESC LIMIT 50"))
def q_recent(spark, sf):
    o = LK.recent_orders(delivery_orders(spark, sf), 50)
    return finish(o.select("order_id", F.col("created_at").cast("timestamp_ntz").alias("created_at")))


@register("orders_by_restaurant", ds(
    """SELECT o.restaurant_id, o.order_id, CAST(o.rank AS BIGINT) AS rank, r.name, r.location FROM
 (SELECT *, row_number() OVER (PARTITION BY restaurant_id ORDER BY created_at DESC, order_id DESC) AS rank FROM dord2) o
 LEFT JOIN sr r USING (restaurant_id) WHERE o.rank <= 5"""))
def q_orders_by_restaurant(spark, sf):
    o = LK.orders_by_restaurant(delivery_orders(spark, sf), stored_restaurants(spark, sf), 5, ("name", "location"))
    return finish(o.select("restaurant_id", "order_id", "rank", "name", "location"))


@register("restaurant_feature_frame", rs(
    "SELECT restaurant_id, " + ", ".join(cuisine_sql(c) for c in CUISINES)
    + ", round(coalesce(ln(1 + coalesce(CAST(votes AS DOUBLE), 0)), 0), 6) + 0.0 AS votes_log, "
      "CAST(0 AS BIGINT) AS book_table_binary FROM sr"))
def q_feature_frame(spark, sf):
    f = LK.restaurant_feature_frame(stored_restaurants(spark, sf))
    from ladle.operators.restaurant_features import cuisine_column
    return finish(f.select("restaurant_id", *[cuisine_column(c) for c in CUISINES], "votes_log", "book_table_binary"))


@register("search", rs(
    """SELECT restaurant_id, name FROM sr WHERE name ILIKE '%bolt%' ORDER BY restaurant_id LIMIT 1"""))
def q_search(spark, sf):
    return finish(LK.search(stored_restaurants(spark, sf), "bolt").select("restaurant_id", "name"))


@register("search_by_cuisine", rs(
    """SELECT restaurant_id, name FROM sr WHERE cuisines ILIKE '%mughlai%'
ORDER BY bayesian_rating DESC NULLS LAST, restaurant_id LIMIT 10"""))
def q_search_cuisine(spark, sf):
    return finish(LK.search(stored_restaurants(spark, sf), "mughlai").select("restaurant_id", "name"))


@register("value_counts", rs(
    """SELECT location, CAST(count(*) AS BIGINT) AS count FROM sr GROUP BY location
ORDER BY count DESC, location NULLS LAST LIMIT 20"""))
def q_value_counts(spark, sf):
    return finish(LK.value_counts(stored_restaurants(spark, sf), "location"))


@register("histogram", rs(
    """WITH s AS (SELECT min(cost_for_two) AS lo, max(cost_for_two) AS hi FROM sr),
c AS (SELECT CASE WHEN hi = lo THEN 1 ELSE least(floor((cost_for_two - lo) / ((hi - lo) / 20)) + 1, 20) END AS bin,
 count(*) AS n FROM sr, s WHERE cost_for_two IS NOT NULL GROUP BY 1)
SELECT CAST(g.bin AS BIGINT) AS bin, round(lo + (g.bin - 1) * ((hi - lo) / 20), 6) + 0.0 AS bin_start,
 round(lo + g.bin * ((hi - lo) / 20), 6) + 0.0 AS bin_end, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM range(1, 21) g(bin) CROSS JOIN s LEFT JOIN c ON c.bin = g.bin"""))
def q_histogram(spark, sf):
    return finish(LK.histogram(stored_restaurants(spark, sf), "cost_for_two", 20))


@register("mean_by", ds(
    """SELECT festival, round(avg(time_taken_min), 6) + 0.0 AS mean_time_taken_min, CAST(count(*) AS BIGINT) AS n
FROM deliveries_clean GROUP BY festival"""))
def q_mean_by(spark, sf):
    return finish(LK.mean_by(deliveries(spark, sf), "festival", "time_taken_min"))


@register("box_stats", ds(
    """WITH q AS (SELECT road_traffic_density, count(time_taken_min) AS n, quantile_cont(time_taken_min, 0.25) AS q1,
 quantile_cont(time_taken_min, 0.5) AS median, quantile_cont(time_taken_min, 0.75) AS q3 FROM deliveries_clean
 GROUP BY road_traffic_density),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.road_traffic_density, CAST(f.n AS BIGINT) AS n, round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median,
 round(q3, 6) + 0.0 AS q3, round(iqr, 6) + 0.0 AS iqr, round(lower_fence, 6) + 0.0 AS lower_fence,
 round(upper_fence, 6) + 0.0 AS upper_fence,
 round(min(CASE WHEN d.time_taken_min >= lower_fence THEN d.time_taken_min END), 6) + 0.0 AS whisker_low,
 round(max(CASE WHEN d.time_taken_min <= upper_fence THEN d.time_taken_min END), 6) + 0.0 AS whisker_high,
 CAST(count(CASE WHEN d.time_taken_min < lower_fence OR d.time_taken_min > upper_fence THEN 1 END) AS BIGINT) AS outliers
FROM f JOIN deliveries_clean d USING (road_traffic_density)
GROUP BY ALL"""))
def q_box(spark, sf):
    return finish(LK.box_stats(deliveries(spark, sf), "road_traffic_density", "time_taken_min"))


@register("correlation", ds(
    """SELECT 'time_taken_min' AS col_a, 'courier_age' AS col_b, round(corr(time_taken_min, courier_age), 6) + 0.0 AS corr FROM deliveries_clean
UNION ALL SELECT 'time_taken_min', 'delivery_latitude', round(corr(time_taken_min, delivery_latitude), 6) + 0.0 FROM deliveries_clean
UNION ALL SELECT 'courier_age', 'delivery_latitude', round(corr(courier_age, delivery_latitude), 6) + 0.0 FROM deliveries_clean"""))
def q_corr(spark, sf):
    return finish(LK.correlation(deliveries(spark, sf), ["time_taken_min", "courier_age", "delivery_latitude"]))


@register("describe", ds(
    """SELECT road_traffic_density, CAST(count(time_taken_min) AS BIGINT) AS count, round(avg(time_taken_min), 6) + 0.0 AS mean,
 round(stddev_samp(time_taken_min), 6) + 0.0 AS std, round(min(time_taken_min), 6) + 0.0 AS min,
 round(max(time_taken_min), 6) + 0.0 AS max, round(quantile_cont(time_taken_min, 0.25), 6) + 0.0 AS p25,
 round(quantile_cont(time_taken_min, 0.5), 6) + 0.0 AS p50, round(quantile_cont(time_taken_min, 0.75), 6) + 0.0 AS p75
FROM deliveries_clean GROUP BY road_traffic_density"""))
def q_describe(spark, sf):
    return finish(LK.describe(deliveries(spark, sf), "time_taken_min", "road_traffic_density"))
