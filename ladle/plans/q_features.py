"""Queries for restaurant (C) and delivery (D) features and traffic."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ladle.dims import CENTROIDS, CUISINES
from ladle.functions import encode as E
from ladle.functions import geo as G
from ladle.functions import time as TM
from ladle.operators import delivery_features as DF
from ladle.operators import restaurant_features as RF
from ladle.operators import traffic as TR
from ladle.plans.catalog import finish, register
from ladle.plans.common import WEATHER_SQL, deliveries, restaurants
from ladle.plans.sql_blocks import deliveries_clean, restaurants_clean
from ladle.plans.views_sql import with_views
from ladle.sources.fixtures import FIXTURE_CUISINES, table


def rsql(body: str) -> str:
    return with_views(body, "restaurants_raw", extra=restaurants_clean())


def dsql(body: str) -> str:
    extra = deliveries_clean()
    extra["dw"] = f"SELECT *, {WEATHER_SQL} AS weather_conditions FROM deliveries_clean"
    return with_views(body, "deliveries_raw", extra=extra)


def r6(x: str) -> str:
    return f"(round(CAST({x} AS DOUBLE), 6) + 0.0)"


# ---- SQL restatements of the feature rules ---------------------------------
def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


COST_BUCKET_SQL = """CASE WHEN cost_for_two IS NULL OR cost_for_two <= 0 THEN NULL WHEN cost_for_two <= 200 THEN 'budget'
 WHEN cost_for_two <= 500 THEN 'affordable' WHEN cost_for_two <= 1000 THEN 'moderate'
 WHEN cost_for_two <= 2000 THEN 'premium' ELSE 'luxury' END"""
CUISINE_COUNT_SQL = "CAST(coalesce(len(string_split(cuisines, ',')), 1) AS BIGINT)"
ONLINE_SQL = "CAST(CASE WHEN online_order = 'Yes' THEN 1 ELSE 0 END AS BIGINT)"
VOTES_LOG_SQL = "ln(1 + coalesce(CAST(votes AS DOUBLE), 0))"


def cuisine_sql(name: str) -> str:
    return f"CAST(coalesce(contains(lower(cuisines), {q(name.lower())}), false) AS BIGINT) AS {RF.cuisine_column(name)}"


def geocode_sql(col: str = "location") -> tuple[str, str]:
    loc = f"lower(trim({col}))"
    lat, lon = [], []
    for a, la, lo in CENTROIDS:
        lat.append(f"WHEN {loc} = {q(a.lower())} THEN {la}")
        lon.append(f"WHEN {loc} = {q(a.lower())} THEN {lo}")
    for a, la, lo in CENTROIDS:
        cond = f"(contains({loc}, {q(a.lower())}) OR contains({q(a.lower())}, {loc}))"
        lat.append(f"WHEN {cond} THEN {la}")
        lon.append(f"WHEN {cond} THEN {lo}")
    return ("CAST(CASE " + " ".join(lat) + " END AS DOUBLE)", "CAST(CASE " + " ".join(lon) + " END AS DOUBLE)")


def hav_sql(a, b, c, d) -> str:
    h = (f"(pow(sin((radians({c}) - radians({a})) / 2), 2) + "
         f"cos(radians({a})) * cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2))")
    return f"2 * 6371.0 * asin(sqrt(CASE WHEN {h} > 1.0 THEN 1.0 ELSE {h} END))"


HAV = hav_sql("restaurant_latitude", "restaurant_longitude", "delivery_latitude", "delivery_longitude")
ZONE = """CASE WHEN restaurant_latitude IS NULL OR restaurant_longitude IS NULL THEN 'unknown'
 WHEN restaurant_latitude BETWEEN 12.96 AND 13.01 AND restaurant_longitude BETWEEN 77.58 AND 77.65 THEN 'central'
 WHEN restaurant_latitude > 13.01 THEN 'north' WHEN restaurant_latitude < 12.91 THEN 'south'
 WHEN restaurant_longitude > 77.68 THEN 'east' ELSE 'west' END"""
HOUR = "CAST(coalesce(hour(order_ts), 0) AS BIGINT)"
DOW = "CAST(coalesce(isodow(order_ts) - 1, 0) AS BIGINT)"
WEEKEND = "CAST(CASE WHEN isodow(order_ts) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT)"


def rush_sql(h: str) -> str:
    return f"CAST(CASE WHEN {h} IN (8, 9, 10, 13, 14, 18, 19, 20) THEN 1 ELSE 0 END AS BIGINT)"


def bucket_sql(h: str) -> str:
    return (f"CASE WHEN {h} IS NULL THEN 'unknown' WHEN {h} >= 5 AND {h} < 11 THEN 'breakfast' "
            f"WHEN {h} >= 11 AND {h} < 16 THEN 'lunch' WHEN {h} >= 16 AND {h} < 21 THEN 'evening' ELSE 'late_night' END")


def age_sql(a: str) -> str:
    return (f"CASE WHEN {a} IS NULL OR {a} <= 0 THEN 'mid' WHEN {a} <= 25 THEN 'young' WHEN {a} <= 35 THEN 'mid' "
            f"WHEN {a} <= 45 THEN 'senior' ELSE 'veteran' END")


FEST = "CAST(CASE WHEN festival = 'Yes' THEN 1 ELSE 0 END AS BIGINT)"
TRAFFIC = ("CAST(coalesce(CASE road_traffic_density WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 "
           "WHEN 'Jam' THEN 3 END, 1) AS BIGINT)")
WEATHER = ("CAST(coalesce(CASE lower(weather_conditions) WHEN 'sunny' THEN 0 WHEN 'cloudy' THEN 1 WHEN 'fog' THEN 2 "
           "WHEN 'sandstorms' THEN 2 WHEN 'windy' THEN 3 WHEN 'stormy' THEN 4 WHEN 'rainy' THEN 4 END, 1) AS BIGINT)")
TWO_PI_24 = f"({2 * math.pi / 24!r})"
TWO_PI_7 = f"({2 * math.pi / 7!r})"


# ---- C: restaurant features --------------------------------------------------
@register("top_cuisines", rsql(
    """SELECT trim(c) AS cuisine, CAST(count(*) AS BIGINT) AS n_restaurants
FROM (SELECT unnest(string_split(cuisines, ',')) AS c FROM restaurants_clean) GROUP BY 1
ORDER BY n_restaurants DESC, cuisine LIMIT 30"""))
def q_top_cuisines(spark, sf):
    return finish(RF.top_cuisines(restaurants(spark, sf), 30))


@register("encode_cuisines", rsql(
    "SELECT restaurant_id, " + ", ".join(cuisine_sql(c) for c in FIXTURE_CUISINES) + " FROM restaurants_clean"))
def q_encode_cuisines(spark, sf):
    e = RF.encode_cuisines(restaurants(spark, sf), 30)
    return finish(e.select("restaurant_id", *[c for c in e.columns if c.startswith("cuisine_")]))


@register("encode_cuisines_fixed", rsql(
    "SELECT restaurant_id, " + ", ".join(cuisine_sql(c) for c in CUISINES) + " FROM restaurants_clean"))
def q_encode_fixed(spark, sf):
    r = RF.encode_cuisines_fixed(restaurants(spark, sf))
    return finish(r.select("restaurant_id", *[RF.cuisine_column(c) for c in CUISINES]))


@register("cost_bucket", rsql(f"SELECT restaurant_id, {COST_BUCKET_SQL} AS cost_for_two_bucket FROM restaurants_clean"))
def q_cost_bucket(spark, sf):
    return finish(restaurants(spark, sf).select("restaurant_id", E.cost_bucket("cost_for_two").alias("cost_for_two_bucket")))


@register("cuisine_count", with_views(
    f"SELECT restaurant_id, {CUISINE_COUNT_SQL} AS cuisine_count FROM restaurants_raw", "restaurants_raw"))
def q_cuisine_count(spark, sf):
    from ladle.sources.fixtures import restaurants_raw
    return finish(restaurants_raw(spark, sf).select("restaurant_id", E.cuisine_count("cuisines").alias("cuisine_count")))


@register("yes_no_flag", with_views(
    f"SELECT restaurant_id, {ONLINE_SQL} AS online_order_binary FROM restaurants_raw", "restaurants_raw"))
def q_yes_no(spark, sf):
    from ladle.sources.fixtures import restaurants_raw
    return finish(restaurants_raw(spark, sf).select("restaurant_id", E.yes_no_flag("online_order").alias("online_order_binary")))


@register("votes_log", with_views(
    f"SELECT restaurant_id, {r6(VOTES_LOG_SQL)} AS votes_log FROM restaurants_raw", "restaurants_raw"))
def q_votes_log(spark, sf):
    from ladle.sources.fixtures import restaurants_raw
    return finish(restaurants_raw(spark, sf).select("restaurant_id", E.votes_log("votes").alias("votes_log")))


@register("add_restaurant_features", rsql(
    f"""SELECT restaurant_id, name, round(rate, 6) AS rate, round(cost_for_two, 6) AS cost_for_two, cuisines, location,
 online_order, votes, {COST_BUCKET_SQL} AS cost_for_two_bucket, {CUISINE_COUNT_SQL} AS cuisine_count,
 {ONLINE_SQL} AS online_order_binary, {r6(VOTES_LOG_SQL)} AS votes_log, """
    + ", ".join(cuisine_sql(c) for c in FIXTURE_CUISINES) + " FROM restaurants_clean"))
def q_add_restaurant_features(spark, sf):
    return finish(RF.add_restaurant_features(restaurants(spark, sf)))


@register("rating_features", rsql(
    f"SELECT restaurant_id, round(rate, 6) AS rate, " + ", ".join(cuisine_sql(c) for c in CUISINES)
    + f", round(coalesce(cost_for_two, 0), 6) AS cost_for_two, {r6(VOTES_LOG_SQL)} AS votes_log, "
      f"{ONLINE_SQL} AS online_order_binary, {CUISINE_COUNT_SQL} AS cuisine_count FROM restaurants_clean"))
def q_rating_features(spark, sf):
    r = RF.add_restaurant_features(restaurants(spark, sf), fixed=True).drop("cost_for_two_bucket")
    cols = RF.rating_feature_cols(r)
    return finish(RF.rating_features(r).select("restaurant_id", "rate", *cols))


_GLAT, _GLON = geocode_sql()


@register("geocode", with_views(
    f"SELECT restaurant_id, location, {_GLAT} AS latitude, {_GLON} AS longitude FROM restaurants_raw", "restaurants_raw"))
def q_geocode(spark, sf):
    from ladle.sources.fixtures import restaurants_raw
    return finish(RF.geocode(restaurants_raw(spark, sf).select("restaurant_id", "location")))


# ---- D: delivery features --------------------------------------------------
@register("haversine_km", dsql(f"SELECT order_id, {r6(HAV)} AS haversine_distance_km FROM dw"))
def q_haversine(spark, sf):
    d = deliveries(spark, sf)
    return finish(d.select("order_id", G.haversine_km("restaurant_latitude", "restaurant_longitude",
                                                      "delivery_latitude", "delivery_longitude").alias("haversine_distance_km")))


@register("city_zone", dsql(f"SELECT order_id, {ZONE} AS city_zone FROM dw"))
def q_city_zone(spark, sf):
    d = deliveries(spark, sf)
    return finish(d.select("order_id", G.city_zone("restaurant_latitude", "restaurant_longitude").alias("city_zone")))


@register("order_time_parts", dsql(
    f"SELECT order_id, {HOUR} AS order_hour, {DOW} AS day_of_week, {WEEKEND} AS is_weekend FROM dw"))
def q_time_parts(spark, sf):
    d = deliveries(spark, sf)
    return finish(d.select("order_id", *[c.alias(n) for n, c in TM.order_time_parts("order_ts").items()]))


@register("rush_hour_cyclical", dsql(
    f"""SELECT order_id, {rush_sql(HOUR)} AS is_rush_hour, {r6(f'sin({HOUR} * {TWO_PI_24})')} AS hour_sin,
 {r6(f'cos({HOUR} * {TWO_PI_24})')} AS hour_cos, {r6(f'sin({DOW} * {TWO_PI_7})')} AS dow_sin,
 {r6(f'cos({DOW} * {TWO_PI_7})')} AS dow_cos, {bucket_sql(HOUR)} AS order_hour_bucket FROM dw"""))
def q_rush(spark, sf):
    d = deliveries(spark, sf)
    p = TM.order_time_parts("order_ts")
    h, w = p["order_hour"], p["day_of_week"]
    return finish(d.select("order_id", TM.is_rush_hour(h).alias("is_rush_hour"),
                           TM.cyclical_sin(h, 24).alias("hour_sin"), TM.cyclical_cos(h, 24).alias("hour_cos"),
                           TM.cyclical_sin(w, 7).alias("dow_sin"), TM.cyclical_cos(w, 7).alias("dow_cos"),
                           TM.hour_bucket(h).alias("order_hour_bucket")))


@register("encode_conditions", dsql(
    f"SELECT order_id, {FEST} AS is_festival, {TRAFFIC} AS traffic_ordinal, {WEATHER} AS weather_encoded, "
    f"{age_sql('CAST(courier_age AS DOUBLE)')} AS delivery_person_age_bucket FROM dw"))
def q_encode_conditions(spark, sf):
    d = deliveries(spark, sf)
    return finish(d.select("order_id", E.festival_flag("festival").alias("is_festival"),
                           E.traffic_ordinal("road_traffic_density").alias("traffic_ordinal"),
                           E.weather_ordinal("weather_conditions").alias("weather_encoded"),
                           TM.age_bucket(F.col("courier_age")).alias("delivery_person_age_bucket")))


_DFEAT = f"""SELECT order_id, round(time_taken_min, 6) AS time_taken_min, {r6(HAV)} AS haversine_distance_km,
 {ZONE} AS city_zone, {HOUR} AS order_hour, {DOW} AS day_of_week, {WEEKEND} AS is_weekend,
 {rush_sql(HOUR)} AS is_rush_hour, {r6(f'sin({HOUR} * {TWO_PI_24})')} AS hour_sin,
 {r6(f'cos({HOUR} * {TWO_PI_24})')} AS hour_cos, {r6(f'sin({DOW} * {TWO_PI_7})')} AS dow_sin,
 {r6(f'cos({DOW} * {TWO_PI_7})')} AS dow_cos, {bucket_sql(HOUR)} AS order_hour_bucket, {FEST} AS is_festival,
 {TRAFFIC} AS traffic_ordinal, {WEATHER} AS weather_encoded,
 {r6(f'({HAV}) * ({TRAFFIC} + 1)')} AS distance_traffic_interaction, {r6(f'({HAV}) * {FEST}')} AS distance_festival_interaction,
 round(CAST(courier_age AS DOUBLE), 6) AS courier_age, {age_sql('CAST(courier_age AS DOUBLE)')} AS delivery_person_age_bucket,
 {r6(f'CASE WHEN time_taken_min / 60 = 0 THEN NULL ELSE ({HAV}) / (time_taken_min / 60) END')} AS speed_kmh
FROM dw"""


@register("add_delivery_features", dsql(_DFEAT))
def q_add_delivery_features(spark, sf):
    d = deliveries(spark, sf)
    out = DF.add_delivery_features(d, date_col="order_ts", age_col="courier_age")
    keep = ["order_id", "time_taken_min", "haversine_distance_km", "city_zone", "order_hour", "day_of_week",
            "is_weekend", "is_rush_hour", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "order_hour_bucket",
            "is_festival", "traffic_ordinal", "weather_encoded", "distance_traffic_interaction",
            "distance_festival_interaction", "courier_age", "delivery_person_age_bucket", "speed_kmh"]
    return finish(out.select(*keep))


@register("speed_and_complete", dsql(
    f"""SELECT order_id, {r6(f'CASE WHEN time_taken_min / 60 = 0 THEN NULL ELSE ({HAV}) / (time_taken_min / 60) END')}
 AS speed_kmh FROM dw WHERE time_taken_min IS NOT NULL AND ({HAV}) IS NOT NULL"""))
def q_speed(spark, sf):
    d = deliveries(spark, sf)
    out = DF.add_delivery_features(d.select("order_id", "time_taken_min", "restaurant_latitude", "restaurant_longitude",
                                            "delivery_latitude", "delivery_longitude"))
    return finish(out.select("order_id", "speed_kmh"))


def _requests(d):
    oid = F.col("order_id")
    p = TM.order_time_parts("order_ts")
    return d.select(
        oid.alias("request_id"),
        G.haversine_km("restaurant_latitude", "restaurant_longitude", "delivery_latitude",
                       "delivery_longitude").alias("distance_km"),
        F.when(oid % 4 == 0, F.lit(None)).otherwise(E.traffic_ordinal("road_traffic_density")).alias("traffic_level"),
        (F.col("festival") == "Yes").alias("is_festival"),
        F.when(oid % 6 == 0, F.lit(None)).otherwise(F.col("courier_age").cast("double")).alias("delivery_person_age"),
        F.when(oid % 3 == 0, F.lit(None)).otherwise(p["order_hour"]).alias("order_hour"),
        F.when(oid % 5 == 0, F.lit(None)).otherwise(p["day_of_week"]).alias("day_of_week"),
    )


_RQ = f"""SELECT order_id AS request_id, {HAV} AS distance_km,
 CASE WHEN order_id % 4 = 0 THEN NULL ELSE {TRAFFIC} END AS traffic_level, festival = 'Yes' AS is_festival,
 CASE WHEN order_id % 6 = 0 THEN NULL ELSE CAST(courier_age AS DOUBLE) END AS delivery_person_age,
 CASE WHEN order_id % 3 = 0 THEN NULL ELSE {HOUR} END AS order_hour,
 CASE WHEN order_id % 5 = 0 THEN NULL ELSE {DOW} END AS day_of_week FROM dw"""
_H, _W, _T = "coalesce(order_hour, 12)", "coalesce(day_of_week, 2)", "coalesce(traffic_level, 1)"
_F = "CAST(CASE WHEN coalesce(is_festival, false) THEN 1 ELSE 0 END AS BIGINT)"
_A = "coalesce(delivery_person_age, 30.0)"


@register("eta_request_features", dsql(
    f"""SELECT request_id, {r6('distance_km')} AS haversine_distance_km, 'unknown' AS city_zone,
 CAST({_H} AS BIGINT) AS order_hour, CAST({_W} AS BIGINT) AS day_of_week,
 CAST(CASE WHEN {_W} >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend, {rush_sql(_H)} AS is_rush_hour,
 {r6(f'sin({_H} * {TWO_PI_24})')} AS hour_sin, {r6(f'cos({_H} * {TWO_PI_24})')} AS hour_cos,
 {r6(f'sin({_W} * {TWO_PI_7})')} AS dow_sin, {r6(f'cos({_W} * {TWO_PI_7})')} AS dow_cos,
 {bucket_sql(_H)} AS order_hour_bucket, CAST({_T} AS BIGINT) AS traffic_ordinal, {_F} AS is_festival,
 CAST(1 AS BIGINT) AS weather_encoded, {r6(f'distance_km * ({_T} + 1)')} AS distance_traffic_interaction,
 {r6(f'distance_km * {_F}')} AS distance_festival_interaction, round({_A}, 6) AS delivery_person_age,
 CAST(4.0 AS DOUBLE) AS delivery_person_ratings, CAST(1 AS BIGINT) AS vehicle_condition, {age_sql(_A)} AS delivery_person_age_bucket
FROM ({_RQ})"""))
def q_eta_request(spark, sf):
    return finish(DF.eta_request_features(_requests(deliveries(spark, sf)), now_hour=12, now_dow=2))


@register("eta_feature_contract", dsql(
    f"""SELECT order_id, {r6(HAV)} AS haversine_distance_km, {ZONE} AS city_zone, round(CAST({HOUR} AS DOUBLE), 6) AS order_hour,
 round(CAST({DOW} AS DOUBLE), 6) AS day_of_week, round(CAST({WEEKEND} AS DOUBLE), 6) AS is_weekend,
 round(CAST({rush_sql(HOUR)} AS DOUBLE), 6) AS is_rush_hour, {r6(f'sin({HOUR} * {TWO_PI_24})')} AS hour_sin,
 {r6(f'cos({HOUR} * {TWO_PI_24})')} AS hour_cos, {r6(f'sin({DOW} * {TWO_PI_7})')} AS dow_sin,
 {r6(f'cos({DOW} * {TWO_PI_7})')} AS dow_cos, {bucket_sql(HOUR)} AS order_hour_bucket,
 round(CAST({TRAFFIC} AS DOUBLE), 6) AS traffic_ordinal, round(CAST({FEST} AS DOUBLE), 6) AS is_festival,
 round(CAST({WEATHER} AS DOUBLE), 6) AS weather_encoded,
 {r6(f'({HAV}) * ({TRAFFIC} + 1)')} AS distance_traffic_interaction, {r6(f'({HAV}) * {FEST}')} AS distance_festival_interaction,
 round(CAST(courier_age AS DOUBLE), 6) AS delivery_person_age, CAST(0.0 AS DOUBLE) AS delivery_person_ratings, CAST(0.0 AS DOUBLE) AS vehicle_condition,
 {age_sql('CAST(courier_age AS DOUBLE)')} AS delivery_person_age_bucket FROM dw"""))
def q_eta_contract(spark, sf):
    d = deliveries(spark, sf).withColumnRenamed("courier_age", "delivery_person_age")
    f = DF.add_delivery_features(d, date_col="order_ts")
    return finish(DF.eta_contract(f).select("order_id", *DF.ETA_FEATURES))


# ---- D17-D20: traffic -------------------------------------------------------
_EXP = """CAST(CASE WHEN dow >= 5 THEN (CASE WHEN hr BETWEEN 11 AND 20 THEN 1 ELSE 0 END)
 WHEN hr IN (8, 9, 10, 18, 19, 20) THEN 2 WHEN hr BETWEEN 11 AND 17 THEN 1 ELSE 0 END AS BIGINT)"""


def _lbl(x):
    return f"CASE {x} WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' WHEN 3 THEN 'Jam' END"


def _ratio(x):
    return f"CAST(CASE WHEN {x} = 0 THEN 0.9 WHEN {x} = 1 THEN 0.7 WHEN {x} = 2 THEN 0.5 ELSE 0.3 END AS DOUBLE)"


@register("expected_traffic", f"""SELECT event_id, {_EXP} AS traffic_level, {_lbl(_EXP)} AS traffic_label,
 {_ratio(_EXP)} AS speed_ratio FROM (SELECT event_id, hour(ts) AS hr, isodow(ts) - 1 AS dow FROM events)""")
def q_expected_traffic(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.hour("ts").alias("hr"), F.weekday("ts").alias("dow"))
    lv = TR.expected_traffic_level("hr", "dow")
    return finish(e.select("event_id", lv.alias("traffic_level"), TR.level_label(lv).alias("traffic_label"),
                           TR.speed_ratio_of_level(lv).alias("speed_ratio")))


def speed_feed(spark, sf):
    """Speed readings per road segment, derived from click events."""
    e = table(spark, sf, "events").where(F.col("event_type") == "click")
    return e.groupBy(F.col("user_id").alias("segment_id")).agg(
        F.avg("value").alias("current_speed"), (F.max("value") - 50).alias("free_flow_speed"))


def congestion_feed(spark, sf):
    """Congestion labels per road segment, derived from purchase events."""
    e = table(spark, sf, "events").where(F.col("event_type") == "purchase")
    labels = F.array(*[F.lit(x) for x in ("low", "Medium", "HIGH", "jam", "severe")])
    return e.groupBy(F.col("user_id").alias("segment_id")).agg(
        F.element_at(labels, (1 + F.count(F.lit(1)) % 5).cast("int")).alias("congestion_level"))


_SPEED_SQL = """SELECT user_id AS segment_id, avg(value) AS current_speed, max(value) - 50 AS free_flow_speed
 FROM events WHERE event_type = 'click' GROUP BY user_id"""
_CONG_SQL = """SELECT user_id AS segment_id, CASE count(*) % 5 WHEN 0 THEN 'low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'HIGH'
 WHEN 3 THEN 'jam' ELSE 'severe' END AS congestion_level FROM events WHERE event_type = 'purchase' GROUP BY user_id"""
_SPD_LV = ("CAST(CASE WHEN r >= 0.8 THEN 0 WHEN r >= 0.6 THEN 1 WHEN r >= 0.4 THEN 2 ELSE 3 END AS BIGINT)")


@register("traffic_from_speed", f"""SELECT segment_id, {_SPD_LV} AS level, {_lbl(_SPD_LV)} AS label,
 round(round_even(r, 2), 6) AS speed_ratio FROM (SELECT segment_id, CASE WHEN free_flow_speed > 0
 THEN current_speed / free_flow_speed ELSE 0.5 END AS r FROM ({_SPEED_SQL}))""")
def q_traffic_speed(spark, sf):
    t = TR.traffic_from_speed("current_speed", "free_flow_speed")
    return finish(speed_feed(spark, sf).select("segment_id", *[c.alias(k) for k, c in t.items()]))


_CG_LV = ("CAST(coalesce(CASE lower(congestion_level) WHEN 'low' THEN 0 WHEN 'medium' THEN 1 WHEN 'high' THEN 2 "
          "WHEN 'jam' THEN 3 END, 1) AS BIGINT)")


@register("traffic_from_congestion", f"""SELECT segment_id, {_CG_LV} AS level, {_lbl(_CG_LV)} AS label,
 round(CAST(1.0 - {_CG_LV} * 0.25 AS DOUBLE), 6) AS speed_ratio FROM ({_CONG_SQL})""")
def q_traffic_congestion(spark, sf):
    t = TR.traffic_from_congestion("congestion_level")
    return finish(congestion_feed(spark, sf).select("segment_id", *[c.alias(k) for k, c in t.items()]))


@register("resolve_traffic", f"""WITH o AS (SELECT event_id, user_id % 60 AS segment_id, hour(ts) AS hr, isodow(ts) - 1 AS dow
 FROM events),
s AS (SELECT segment_id, {_SPD_LV} AS l1, round_even(r, 2) AS r1 FROM (SELECT segment_id, CASE WHEN free_flow_speed > 0
 THEN current_speed / free_flow_speed ELSE 0.5 END AS r FROM ({_SPEED_SQL}))),
c AS (SELECT segment_id, {_CG_LV} AS l2, 1.0 - {_CG_LV} * 0.25 AS r2 FROM ({_CONG_SQL})),
j AS (SELECT o.event_id, o.segment_id, s.l1, s.r1, c.l2, c.r2, {_EXP} AS l0 FROM o LEFT JOIN s USING (segment_id)
 LEFT JOIN c USING (segment_id))
SELECT event_id, segment_id, coalesce(l1, l2, l0) AS traffic_level, {_lbl('coalesce(l1, l2, l0)')} AS traffic_label,
 round(coalesce(r1, r2, {_ratio('l0')}), 6) AS speed_ratio,
 CASE WHEN l1 IS NOT NULL THEN 'speed_feed' WHEN l2 IS NOT NULL THEN 'congestion_feed' ELSE 'time_of_day' END AS source
FROM j""")
def q_resolve_traffic(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", (F.col("user_id") % 60).alias("segment_id"), F.hour("ts").alias("order_hour"),
        F.weekday("ts").alias("day_of_week"))
    out = TR.resolve_traffic(e, speed_feed(spark, sf), congestion_feed(spark, sf))
    return finish(out.select("event_id", "segment_id", "traffic_level", "traffic_label", "speed_ratio", "source"))
