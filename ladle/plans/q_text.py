"""Queries for the conversation rules, narration and request validation (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions.encode import reliability_band
from ladle.operators import text_rules as K
from ladle.plans.catalog import finish, register
from ladle.plans.common import delivery_orders, stored_restaurants
from ladle.plans.q_features import hav_sql
from ladle.plans.q_lookup import ds
from ladle.plans.q_recommend import rs
from ladle.plans.sql_answers import answers_sql
from ladle.plans.views_sql import with_views
from ladle.sources.fixtures import messages, table


def _intent_select() -> str:
    t = "lower(regexp_replace(message, '^\\s+|\\s+$', '', 'g'))"
    case = "CASE " + " ".join(
        f"WHEN regexp_matches(t, '{K._rx(p, a)}') THEN '{n}'" for p, n, a in K.INTENT_RULES) + " ELSE 'unknown' END"
    rx = {n: K._rx(p, a) for p, n, a in K.INTENT_RULES}
    ex = lambda n, g: f"trim(regexp_extract(t, '{rx[n]}', {g}))"
    return f"""SELECT conv_id, turn, intent,
 CASE WHEN intent = 'search' THEN {ex('search', 1)} END AS query,
 CASE WHEN intent = 'search' THEN nullif({ex('search', 2)}, '') END AS area,
 CASE WHEN intent = 'eta' THEN {ex('eta', 1)} WHEN intent = 'reliability' THEN {ex('reliability', 1)} END AS restaurant,
 CASE WHEN intent = 'budget_search' THEN nullif(regexp_extract(t, '{K.BUDGET_PATTERN}', 1), '') END AS budget,
 CASE WHEN intent = 'cuisine_search' THEN 'indian' END AS cuisine
FROM (SELECT *, {case} AS intent FROM (SELECT conv_id, turn, {t} AS t FROM messages))"""


def _intent_sql() -> str:
    return with_views(_intent_select(), "messages")


@register("classify_intent", _intent_sql())
def q_intent(spark, sf):
    c = K.classify_intent(messages(spark, sf))
    return finish(c.select("conv_id", "turn", "intent", "query", "area", "restaurant", "budget", "cuisine"))


@register("search_restaurants", rs(
    """SELECT restaurant_id, name FROM srf WHERE regexp_matches(cuisines, '(?i)biryani') AND cost_for_two <= 800
 AND regexp_matches(location, '(?i)whitefield') ORDER BY restaurant_id LIMIT 5"""))
def q_search_restaurants(spark, sf):
    r = K.search_restaurants(stored_restaurants(spark, sf), "biryani", 800, "whitefield")
    return finish(r.select("restaurant_id", "name"))


from ladle.plans.q_features import geocode_sql  # noqa: E402

_GLAT, _GLON = geocode_sql("location")


@register("eta_estimate", rs(
    f"""SELECT restaurant_id, CAST(round_even(greatest(10.0, coalesce({hav_sql('lat', 'lon', '12.97', '77.59')}, 5.0) * 3 + 15), 0)
 AS BIGINT) AS eta_minutes FROM (SELECT restaurant_id, {_GLAT} AS lat, {_GLON} AS lon FROM sr)"""))
def q_eta_estimate(spark, sf):
    r = stored_restaurants(spark, sf)
    return finish(r.select("restaurant_id", K.eta_minutes(F.col("latitude"), F.col("longitude")).alias("eta_minutes")))


def name_queries(spark, sf):
    """Lookup texts: the first two words of every part name, plus its type's last word."""
    p = table(spark, sf, "part")
    w = F.split("p_name", " ")
    return p.select(F.concat_ws(" ", F.element_at(w, 1), F.element_at(w, 2)).alias("q")).unionByName(
        p.select(F.element_at(F.split("p_type", " "), -1).alias("q")))


_LOOKUP_SQL = """WITH q AS (SELECT DISTINCT lower(q) AS q FROM (SELECT concat_ws(' ', split_part(p_name, ' ', 1),
 split_part(p_name, ' ', 2)) AS q FROM part UNION ALL SELECT list_extract(string_split(p_type, ' '), -1) FROM part))
SELECT q.q AS query, min(sr.restaurant_id) AS restaurant_id FROM q JOIN sr ON contains(lower(sr.name), q.q) GROUP BY q.q"""


@register("reliability_lookup", rs(
    """SELECT l.query, l.restaurant_id, round(coalesce(s.reliability_score, 0.5), 6) + 0.0 AS reliability_score
FROM lk l JOIN srf s USING (restaurant_id)""", {"lk": _LOOKUP_SQL.replace("WITH q AS", "SELECT * FROM (WITH q AS") + ")"}))
def q_reliability_lookup(spark, sf):
    st = stored_restaurants(spark, sf)
    hits = K.contains_lookup(name_queries(spark, sf), "q", st, "name", "restaurant_id")
    out = hits.join(st.select("restaurant_id", "reliability_score"), "restaurant_id").select(
        F.col("_q").alias("query"), "restaurant_id",
        F.coalesce("reliability_score", F.lit(0.5)).alias("reliability_score"))
    return finish(out)


@register("answer_messages", answers_sql(_intent_select()))
def q_answers(spark, sf):
    """K5 over every user message; templates checked in tests/test_text_rules.py."""
    return finish(K.answer_messages(messages(spark, sf), stored_restaurants(spark, sf)))


_NARRATE = """SELECT restaurant_id, concat(concat_ws(' · ', printf('**%s** — %s in **%s**', name, cuisines, location),
 CASE WHEN rate >= 4.0 THEN printf('Highly rated (%s/5)', CAST(rate AS VARCHAR)) WHEN rate >= 3.0
   THEN printf('Decent rating (%s/5)', CAST(rate AS VARCHAR)) WHEN rate IS NOT NULL THEN printf('Average rating (%s/5)', CAST(rate AS VARCHAR)) END,
 CASE WHEN cost_for_two <= 300 THEN 'budget-friendly' WHEN cost_for_two <= 800 THEN 'moderately priced'
   WHEN cost_for_two IS NOT NULL THEN 'premium' END,
 CASE WHEN coalesce(s, 0.0) > 0.3 THEN 'positive customer sentiment' WHEN coalesce(s, 0.0) < -0.2 THEN 'mixed customer reviews'
   ELSE 'neutral customer sentiment' END,
 CASE WHEN coalesce(reliability_score, 0.5) >= 0.7 THEN 'high overall reliability'
   WHEN coalesce(reliability_score, 0.5) >= 0.4 THEN 'moderate reliability' ELSE 'lower reliability — consider alternatives' END), '.')
 AS narration FROM (SELECT srf.*, scen.avg_sentiment AS s FROM srf JOIN scen USING (restaurant_id))"""


@register("narrate", rs(_NARRATE))
def q_narrate(spark, sf):
    return finish(K.narrate(stored_restaurants(spark, sf)).select("restaurant_id", "narration"))


_ETA = f"round_even(greatest(10.0, {hav_sql('lat', 'lon', '12.97', '77.59')} * 3 + 15), 0)"
_HAS = " AS narration FROM (SELECT srf.*, scen.avg_sentiment AS s FROM srf JOIN scen USING (restaurant_id))"


@register("narrate_eta", rs(_NARRATE.replace(
    "), '.')", ", CASE WHEN lat IS NOT NULL AND restaurant_id % 5 <> 0 THEN concat('~', CAST(CAST(" + _ETA
    + " AS BIGINT) AS VARCHAR), ' min delivery estimate') END), '.')").replace(
    _HAS, f" AS narration FROM (SELECT *, {_GLAT} AS lat, {_GLON} AS lon FROM (SELECT srf.*, scen.avg_sentiment AS s"
    " FROM srf JOIN scen USING (restaurant_id)))")))
def q_narrate_eta(spark, sf):
    """K6 with the delivery estimate of K2; a restaurant without one (here every fifth) has no such part."""
    r = stored_restaurants(spark, sf)
    known = F.col("latitude").isNotNull() & (F.col("restaurant_id") % 5 != 0)
    r = r.withColumn("eta", F.when(known, K.eta_minutes(F.col("latitude"), F.col("longitude"))))
    return finish(K.narrate(r, "eta").select("restaurant_id", "narration"))


@register("reliability_band", rs(
    """SELECT restaurant_id, CASE WHEN reliability_score >= 0.7 THEN 'high' WHEN reliability_score >= 0.4 THEN 'moderate'
 ELSE 'low' END AS band FROM srf"""))
def q_band(spark, sf):
    r = stored_restaurants(spark, sf)
    return finish(r.select("restaurant_id", reliability_band("reliability_score").alias("band")))


#: A request of every delivery, with values on both sides of each of the ten rules and blanks.
REQUEST = {
    "distance_km": "CASE WHEN order_id % 50 = 0 THEN NULL ELSE time_taken_min / 10 END",
    "traffic_level": "CASE WHEN order_id % 7 = 0 THEN 4 ELSE order_id % 4 END",
    "delivery_person_age": "courier_age",
    "delivery_person_rating": "CASE WHEN order_id % 11 = 0 THEN 0 WHEN order_id % 12 = 0 THEN NULL ELSE 1 + order_id % 5 END",
    "vehicle_condition": "CASE WHEN order_id % 13 = 0 THEN 4 ELSE order_id % 4 END",
    "budget": "CASE WHEN order_id % 17 = 0 THEN -1 WHEN order_id % 3 = 0 THEN NULL ELSE order_id % 3 - 1 END",
    "top_n": "CASE WHEN order_id % 19 = 0 THEN 51 ELSE order_id % 51 END",
    "priority": "CASE WHEN order_id % 23 = 0 THEN 'fast' WHEN order_id % 2 = 0 THEN 'speed' ELSE 'quality' END",
    "role": "CASE WHEN order_id % 29 = 0 THEN 'system' ELSE 'user' END",
    "message": "CASE WHEN order_id % 31 = 0 THEN '' WHEN order_id % 37 = 0 THEN repeat('x', 2001) ELSE repeat('x', 2000) END",
}
_BROKEN = {
    "distance_km must be in (0, 100]": "distance_km IS NULL OR distance_km <= 0 OR distance_km > 100",
    "traffic_level must be 0-3": "traffic_level < 0 OR traffic_level > 3",
    "delivery_person_age must be 18-70": "delivery_person_age < 18 OR delivery_person_age > 70",
    "delivery_person_rating must be 1-5": "delivery_person_rating < 1 OR delivery_person_rating > 5",
    "vehicle_condition must be 0-3": "vehicle_condition < 0 OR vehicle_condition > 3",
    "budget must be >= 0": "budget < 0",
    "top_n must be 1-50": "top_n < 1 OR top_n > 50",
    "priority must be balanced, speed or quality": "priority NOT IN ('balanced', 'speed', 'quality')",
    "role must be user or assistant": "role NOT IN ('user', 'assistant')",
    "message must be 1-2000 characters": "length(message) NOT BETWEEN 1 AND 2000",
}


@register("validate_requests", ds(
    "SELECT request_id, concat_ws('; ', " + ", ".join(f"CASE WHEN {bad} THEN '{text}' END" for text, bad in _BROKEN.items())
    + ") AS reasons, CAST(" + " + ".join(f"CASE WHEN {bad} THEN 1 ELSE 0 END" for bad in _BROKEN.values())
    + " AS BIGINT) AS n_reasons, NOT (" + " OR ".join(f"coalesce({bad}, false)" for bad in _BROKEN.values()) + ") AS valid FROM (SELECT order_id AS request_id, "
    + ", ".join(f"{e} AS {c}" for c, e in REQUEST.items()) + " FROM deliveries_clean)"))
def q_validate(spark, sf):
    """K8: every rule, with the reasons of each rejected request."""
    from ladle.plans.common import deliveries
    d = deliveries(spark, sf).select(F.col("order_id").alias("request_id"), *[F.expr(e).alias(c) for c, e in REQUEST.items()])
    v = K.validate_requests(d)
    return finish(v.select("request_id", F.array_join("reasons", "; ").alias("reasons"), F.size("reasons").alias("n_reasons"), "valid"))
