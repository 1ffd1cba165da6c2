"""Oracle SQL for the rule-based replies (K5), restating the templates in DuckDB SQL."""

from __future__ import annotations

from ladle.operators import text_rules as K
from ladle.plans.views_sql import with_views


def _sq(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def answers_sql(intent_select: str) -> str:
    from ladle.plans.common import STORED_SQL
    from ladle.plans.q_features import geocode_sql, hav_sql
    from ladle.plans.q_recommend import _SRF
    from ladle.plans.sql_blocks import restaurants_clean

    lat, lon = geocode_sql("s.location")
    eta = f"CAST(round_even(greatest(10.0, coalesce({hav_sql(lat, lon, '12.97', '77.59')}, 5.0) * 3 + 15), 0) AS BIGINT)"
    score = "coalesce(s.reliability_score, 0.5)"
    badge = (f"CASE WHEN {score} >= 0.7 THEN '🟢 **Highly Reliable**' WHEN {score} >= 0.4 "
             f"THEN '🟡 **Moderately Reliable**' ELSE '🔴 **Low Reliability**' END")
    q = "''"  # an escaped single quote inside a SQL literal
    extra = {
        **restaurants_clean(), **STORED_SQL, **_SRF,
        "ci": intent_select,
        "c1": "SELECT *, CASE WHEN intent = 'search' THEN nullif(trim(replace(replace(coalesce(query, ''), 'food', ''), "
              "'restaurants', '')), '') END AS cu, CASE WHEN intent = 'search' THEN area END AS ar, "
              "CASE WHEN intent = 'budget_search' THEN coalesce(budget, '500') END AS btxt FROM ci",
        "c2": "SELECT *, CAST(btxt AS DOUBLE) AS bud FROM c1",
        "ks": "SELECT DISTINCT intent, cu, ar, bud FROM c2 WHERE intent IN ('search', 'budget_search')",
        "found": "SELECT k.*, s.name, s.rate, s.cost_for_two, s.location, row_number() OVER (PARTITION BY k.intent, k.cu, "
                 "k.ar, k.bud ORDER BY s.restaurant_id) AS rk FROM ks k JOIN srf s "
                 "ON (k.cu IS NULL OR coalesce(regexp_matches(s.cuisines, '(?i)' || k.cu), false)) "
                 "AND (k.ar IS NULL OR coalesce(regexp_matches(s.location, '(?i)' || k.ar), false)) "
                 "AND (k.bud IS NULL OR k.bud = 0 OR coalesce(s.cost_for_two <= k.bud, false))",
        "lists": "SELECT intent, cu, ar, bud, count(*) AS n, string_agg(CASE WHEN intent = 'search' "
                 "THEN printf('- **%s** — %s/5 | ₹%s | %s', name, CAST(rate AS VARCHAR), CAST(cost_for_two AS VARCHAR), location) "
                 "ELSE printf('- **%s** — ₹%s | %s', name, CAST(cost_for_two AS VARCHAR), location) END, chr(10) ORDER BY rk) "
                 "AS lines FROM found WHERE rk <= 5 GROUP BY intent, cu, ar, bud",
        "hits": "SELECT q.q, min(s.restaurant_id) AS restaurant_id FROM (SELECT DISTINCT lower(restaurant) AS q FROM c2 "
                "WHERE intent IN ('eta', 'reliability') AND restaurant IS NOT NULL) q JOIN srf s "
                "ON contains(lower(s.name), q.q) GROUP BY q.q",
    }
    none_search = ("concat('😅 I couldn" + q + "t find any restaurants matching ', "
                   "CASE WHEN c.cu IS NOT NULL THEN 'cuisine: ' || c.cu ELSE '' END, ' ', "
                   "CASE WHEN c.ar IS NOT NULL THEN 'area: ' || c.ar ELSE '' END, '. Try broadening your search!')")
    eta_found = ("'🚀 For **' || c.restaurant || '**:' || chr(10) || '- Estimated delivery: **~' || CAST(" + eta
                 + " AS VARCHAR) || ' min**' || chr(10) || '- ✅ **On track**' || chr(10) || '_approximate (no model loaded)_'")
    eta_none = ("'😅 I couldn" + q + "t find ETA data for " + q + "' || c.restaurant || '" + q
                + ". Is the name spelled correctly?'")
    rel_found = ("'📊 ' || " + badge + " || chr(10) || '**' || c.restaurant || '** reliability score: **' || "
                 "printf('%.2f', " + score + ") || '/1.0**'")
    rel_none = "'😅 I couldn" + q + "t find reliability data for " + q + "' || c.restaurant || '" + q + ".'"
    body = f"""SELECT c.conv_id, c.turn, c.intent, CASE
 WHEN c.intent = 'greeting' THEN {_sq(K.GREETING_TEXT)}
 WHEN c.intent = 'search' AND l.n IS NULL THEN {none_search}
 WHEN c.intent = 'search' THEN '🍽️ **Found ' || CAST(l.n AS VARCHAR) || ' restaurants:**' || chr(10) || l.lines
 WHEN c.intent = 'budget_search' AND l.n IS NULL THEN '😅 No restaurants found under ₹' || c.btxt || '.'
 WHEN c.intent = 'budget_search' THEN '💰 **Restaurants under ₹' || c.btxt || ':**' || chr(10) || l.lines
 WHEN c.intent = 'eta' AND h.restaurant_id IS NOT NULL THEN {eta_found}
 WHEN c.intent = 'eta' THEN {eta_none}
 WHEN c.intent = 'reliability' AND h.restaurant_id IS NOT NULL THEN {rel_found}
 WHEN c.intent = 'reliability' THEN {rel_none}
 ELSE {_sq(K.UNKNOWN_TEXT)} END AS response
FROM c2 c LEFT JOIN lists l ON l.intent = c.intent AND l.cu IS NOT DISTINCT FROM c.cu AND l.ar IS NOT DISTINCT FROM c.ar
 AND l.bud IS NOT DISTINCT FROM c.bud
LEFT JOIN hits h ON h.q = lower(c.restaurant) LEFT JOIN srf s ON s.restaurant_id = h.restaurant_id"""
    return with_views(body, "restaurants_raw", "interactions", "messages", extra=extra)
