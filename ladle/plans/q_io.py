"""Queries for sources and sinks (A): file round trips, profile, stored tables, upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators.clean import clean_restaurants
from ladle.plans.catalog import finish, register
from ladle.plans.common import delivery_orders, restaurants, stored_restaurants
from ladle.plans.q_lookup import ds, rs
from ladle.plans.views_sql import with_views
from ladle.sources import io as IO
from ladle.sources import tables as TB
from ladle.sources.fixtures import restaurants_raw


def raw_csv(spark, sf) -> str:
    """restaurants_raw written as the original header CSV (all text)."""
    r = restaurants_raw(spark, sf).select(
        F.col("restaurant_id").cast("string").alias("restaurant_id"), "name", "rate",
        F.col("cost_text").alias("approx_cost(for two people)"), "cuisines", "location",
        F.col("votes").cast("string").alias("votes"), "online_order")
    return IO.write_table(r, IO.scratch_path(spark, "restaurants-csv"), fmt="csv")


_RAW_TXT = """SELECT CAST(restaurant_id AS VARCHAR) AS restaurant_id, name, rate, cost_text AS "approx_cost(for two people)",
 cuisines, location, CAST(votes AS VARCHAR) AS votes, online_order FROM restaurants_raw"""


@register("read_csv", with_views(_RAW_TXT, "restaurants_raw"))
def q_read_csv(spark, sf):
    """A1/A2: header CSV read with an all-text schema."""
    return finish(IO.read_restaurants(spark, raw_csv(spark, sf)))


@register("read_with_fallback", with_views(_RAW_TXT, "restaurants_raw"))
def q_fallback(spark, sf):
    """A5: the stored table is empty here, so the CSV source is used."""
    empty = stored_restaurants(spark, sf).where(F.lit(False))
    return finish(IO.read_with_fallback(empty, lambda: IO.read_restaurants(spark, raw_csv(spark, sf))))


_PROFILE_COLS = [("restaurant_id", "bigint"), ("name", "string"), ("rate", "string"), ("cost_text", "string"),
                 ("cuisines", "string"), ("location", "string"), ("online_order", "string"), ("votes", "bigint")]


@register("profile", with_views(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, '{t}' AS type, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls, "
        f"CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM "
        f"(SELECT location, online_order, cuisines FROM restaurants_raw))) AS BIGINT) AS duplicate_rows FROM restaurants_raw"
        for c, t in _PROFILE_COLS).replace(
        "(SELECT location, online_order, cuisines FROM restaurants_raw)", "restaurants_raw"), "restaurants_raw"))
def q_profile(spark, sf):
    """Per column type and null count, with row and duplicate counts."""
    return finish(IO.profile(restaurants_raw(spark, sf)))


@register("write_processed", rs(
    """SELECT restaurant_id, name, round(rate, 6) + 0.0 AS rate, round(cost_for_two, 6) + 0.0 AS cost_for_two,
 cuisines, location, online_order, votes FROM restaurants_clean"""))
def q_write(spark, sf):
    """Cleaned restaurants written as Parquet partitioned by location, read back."""
    path = IO.write_table(restaurants(spark, sf), IO.scratch_path(spark, "processed"), partition_by=["location"])
    return finish(spark.read.parquet(path).select("restaurant_id", "name", "rate", "cost_for_two", "cuisines",
                                                  "location", "online_order", "votes"))


@register("restaurants_frame", rs(
    "SELECT restaurant_id, name, round(bayesian_rating, 6) + 0.0 AS bayesian_rating, votes FROM sr"))
def q_restaurants_frame(spark, sf):
    """A3 (+A13 conform): serving projection of the stored table."""
    return finish(TB.restaurants_frame(stored_restaurants(spark, sf)).select("restaurant_id", "name", "bayesian_rating", "votes"))


@register("orders_from_deliveries", ds(
    """SELECT order_id, (order_id * 7 + user_id) % (SELECT max(p_partkey) + 1 FROM part) AS restaurant_id,
 round(coalesce(time_taken_min, 30.0), 6) + 0.0 AS predicted_eta, coalesce(time_taken_min, 30.0) > 40 AS is_at_risk,
 time_taken_min > 40 AS actual_late FROM deliveries_clean"""))
def q_orders(spark, sf):
    """Delivery features -> stored orders with SLA flags."""
    o = delivery_orders(spark, sf)
    return finish(o.select("order_id", "restaurant_id", "predicted_eta", "is_at_risk", "actual_late"))


@register("orders_frame", ds(
    """SELECT order_id, round(time_taken_min, 6) + 0.0 AS time_taken_min FROM deliveries_clean"""))
def q_orders_frame(spark, sf):
    """A4: orders projected for modelling; minutes = actual else predicted."""
    return finish(TB.orders_frame(delivery_orders(spark, sf)).select("order_id", "time_taken_min"))


def upsert_batch(spark, sf):
    """A batch of listing updates: every third stored restaurant comes three
    times, with one, two and three more votes in an order of ``seq`` that is not
    that of the votes (cuisines blanked on even ids, which must not overwrite;
    the last row's votes are blank on ids divisible by 9), and the raw listings
    dropped by cleaning (no rating) arrive as new names."""
    st = stored_restaurants(spark, sf)
    rid, more = F.col("restaurant_id"), F.col("more")
    upd = st.where(rid % 3 == 0).withColumn("more", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).withColumn("seq", (rid + more * 2) % 3).select(
        "name", F.when((rid % 9 == 0) & (F.col("seq") == 2), F.lit(None)).otherwise(F.col("votes") + more).alias("votes"),
        F.when(rid % 2 == 0, F.lit(None)).otherwise(F.col("cuisines")).alias("cuisines"), "seq")
    raw = restaurants_raw(spark, sf)
    new = raw.join(st.select("restaurant_id"), "restaurant_id", "left_anti").select("name", "votes", "cuisines", F.lit(1).cast("bigint").alias("seq"))
    return upd.unionByName(new)


@register("upsert_restaurants", rs(
    """WITH u AS (SELECT name, restaurant_id, CASE WHEN restaurant_id % 9 = 0 AND (restaurant_id + m * 2) % 3 = 2 THEN NULL ELSE votes + m END AS votes,
 CASE WHEN restaurant_id % 2 = 0 THEN NULL ELSE cuisines END AS cuisines, (restaurant_id + m * 2) % 3 AS seq
 FROM sr, (VALUES (1), (2), (3)) t(m) WHERE restaurant_id % 3 = 0),
b AS (SELECT name, arg_max(votes, seq) FILTER (votes IS NOT NULL) AS votes, arg_max(cuisines, seq) FILTER (cuisines IS NOT NULL) AS cuisines FROM u GROUP BY name
 UNION ALL SELECT r.name, r.votes, r.cuisines FROM restaurants_raw r WHERE r.restaurant_id NOT IN (SELECT restaurant_id FROM sr)),
j AS (SELECT t.restaurant_id, coalesce(t.name, b.name) AS name, coalesce(b.votes, t.votes) AS votes, coalesce(b.cuisines, t.cuisines) AS cuisines,
 t.name IS NULL AS is_new FROM sr t FULL OUTER JOIN b ON t.name = b.name)
SELECT name, votes, cuisines, is_new, CASE WHEN is_new THEN NULL ELSE restaurant_id END AS old_id,
 CAST(count(*) OVER () AS BIGINT) AS distinct_ids, (SELECT max(restaurant_id) FROM sr) + (SELECT count(*) FROM j WHERE is_new) AS highest_id FROM j"""))
def q_upsert(spark, sf):
    """Merge by name; null cells never overwrite; new names inserted."""
    st = stored_restaurants(spark, sf)
    now = F.lit("2024-03-01 00:00:00").cast("timestamp")
    from ladle.plans.scale import materialize, with_stats
    merged = materialize(TB.upsert_by_name(st, upsert_batch(spark, sf), "seq", now).withColumn("is_new", F.col("created_at") == now))
    ids = with_stats(merged, merged.agg(F.count_distinct("restaurant_id").alias("n"), F.max("restaurant_id").alias("hi")), "_i")
    return finish(ids.select("name", "votes", "cuisines", "is_new", F.when(~F.col("is_new"), F.col("restaurant_id")).alias("old_id"),
                             F.col("_i.n").alias("distinct_ids"), F.col("_i.hi").alias("highest_id")))


@register("replace_all", ds(
    """SELECT CAST(count(*) AS BIGINT) AS rows, 'restaurants' AS table_name FROM restaurants_clean
UNION ALL SELECT CAST(count(*) AS BIGINT), 'orders' FROM deliveries_clean"""))
def q_replace(spark, sf):
    """A10: both stored tables written to one fresh version folder; row counts read back."""
    paths = IO.replace_all({"restaurants": stored_restaurants(spark, sf), "orders": delivery_orders(spark, sf)},
                           IO.scratch_path(spark, "stored"))
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(t))
             for t, p in paths.items()]
    return finish(parts[0].unionByName(parts[1]))


@register("full_import", ds(
    """SELECT CAST(count(*) AS BIGINT) AS rows, 'restaurants' AS table_name FROM restaurants_clean
UNION ALL SELECT CAST(count(*) AS BIGINT), 'orders' FROM deliveries_clean"""))
def q_full_import(spark, sf):
    """Raw CSV -> clean -> features -> stored restaurants, and deliveries -> stored orders."""
    raw = IO.read_restaurants(spark, raw_csv(spark, sf)).select(
        F.col("restaurant_id").cast("bigint").alias("restaurant_id"), "name", "rate",
        F.col("approx_cost(for two people)").alias("cost_text"), "cuisines", "location", "online_order",
        F.col("votes").cast("bigint").alias("votes"))
    from ladle.operators.recommend import bayesian_rating
    from ladle.operators.restaurant_features import add_restaurant_features
    from ladle.plans.scale import materialize
    r = TB.conform(bayesian_rating(add_restaurant_features(materialize(clean_restaurants(raw)), fixed=True))
                   .withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()}), TB.RESTAURANTS)
    o = delivery_orders(spark, sf)
    a = r.agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit("restaurants"))
    b = o.agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit("orders"))
    return finish(a.unionByName(b))


from ladle.dims import WEIGHT_PROFILES  # noqa: E402
from ladle.plans.q_business import _scen_long, ssql  # noqa: E402


@register("write_report_json", ssql(
    """SELECT profile, round(avg(score), 6) + 0.0 AS mean_score,
 CAST(least(count(*), 10) AS BIGINT) AS n_top FROM sl GROUP BY profile""", _scen_long(WEIGHT_PROFILES)))
def q_report(spark, sf):
    """The scenario report (nested: profile, mean, top list) as JSON, read back."""
    from ladle.operators.business import ab_scenarios
    from ladle.plans.common import scenario_frame
    means, top = ab_scenarios(scenario_frame(spark, sf))
    nested = top.groupBy("profile").agg(F.sort_array(F.collect_list(F.struct("rank", "name", "score"))).alias("top"))
    rep = means.join(nested, "profile")
    path = IO.write_report_json(rep, IO.scratch_path(spark, "report"))
    back = spark.read.json(path)
    return finish(back.select("profile", "mean_score", F.size("top").alias("n_top")))


@register("check_not_null", rs("SELECT restaurant_id FROM sr WHERE restaurant_id IS NULL OR name IS NULL"))
def q_not_null(spark, sf):
    """Stored restaurants violating a NOT NULL column (expected none)."""
    return finish(TB.check_not_null(stored_restaurants(spark, sf), TB.RESTAURANTS).select("restaurant_id"))
