"""Queries for reliability, SLA, scenarios and dispatch (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.dims import SENSITIVITY_WEIGHTINGS, WEIGHT_PROFILES
from ladle.operators import business as B
from ladle.plans.catalog import finish, register
from ladle.plans.common import SCENARIO_SQL, scenario_frame
from ladle.plans.scale import materialize
from ladle.plans.sql_blocks import restaurants_clean
from ladle.plans.views_sql import with_views
from ladle.sources.fixtures import outcomes, table


def ssql(body: str, extra: dict | None = None) -> str:
    return with_views(body, "restaurants_raw", "interactions",
                      extra={**restaurants_clean(), **SCENARIO_SQL, **(extra or {})})


def osql(body: str, extra: dict | None = None) -> str:
    return with_views(body, "outcomes", extra=extra)


def norm(x: str, lo: str, hi: str) -> str:
    return f"(CASE WHEN {hi} = {lo} THEN 0.5 ELSE ({x} - {lo}) / ({hi} - {lo}) END)"


@register("minmax_norm", ssql(f"""SELECT restaurant_id, round({norm('delay_risk', 'lo', 'hi')}, 6) + 0.0 AS delay_risk_norm
FROM scen, (SELECT min(delay_risk) AS lo, max(delay_risk) AS hi FROM scen)"""))
def q_minmax(spark, sf):
    return finish(B.minmax(scenario_frame(spark, sf), "delay_risk").select("restaurant_id", "delay_risk_norm"))


_REL_STATS = ("SELECT min(rate) AS rlo, max(rate) AS rhi, min(avg_sentiment) AS slo, max(avg_sentiment) AS shi, "
              "min(delay_risk) AS dlo, max(delay_risk) AS dhi FROM scen")


def rel_sql(w1, w2, w3, r="rate", s="avg_sentiment", d="delay_risk"):
    raw = f"{w1} * {norm(r, 'rlo', 'rhi')} + {w2} * {norm(s, 'slo', 'shi')} - {w3} * {norm(d, 'dlo', 'dhi')}"
    return f"greatest(0.0, least(1.0, {raw}))"


@register("reliability_score", ssql(f"""SELECT restaurant_id, round(CASE WHEN rate IS NULL OR avg_sentiment IS NULL
 OR delay_risk IS NULL THEN NULL ELSE {rel_sql(0.4, 0.3, 0.3)} END, 6) + 0.0 AS reliability_score
FROM scen, ({_REL_STATS})"""))
def q_reliability(spark, sf):
    return finish(B.reliability_score(scenario_frame(spark, sf)).select("restaurant_id", "reliability_score"))


@register("sla_analysis", osql("""SELECT CAST(40.0 AS DOUBLE) AS sla_threshold_min, CAST(n AS BIGINT) AS total_orders,
 coalesce(round_even((n - late) / n, 4), 0.0) AS actual_on_time_rate,
 coalesce(round_even((n - plate) / n, 4), 0.0) AS predicted_on_time_rate,
 tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
 coalesce(round_even(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 4), 0.0) AS precision,
 coalesce(round_even(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 4), 0.0) AS recall
FROM (SELECT count(*) AS n,
 CAST(coalesce(sum(CASE WHEN actual_min <= 40 AND predicted_min <= 40 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tp,
 CAST(coalesce(sum(CASE WHEN actual_min > 40 AND predicted_min <= 40 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fp,
 CAST(coalesce(sum(CASE WHEN actual_min <= 40 AND predicted_min > 40 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fn,
 CAST(coalesce(sum(CASE WHEN actual_min > 40 AND predicted_min > 40 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tn,
 coalesce(sum(CASE WHEN actual_min > 40 THEN 1 ELSE 0 END), 0) AS late,
 coalesce(sum(CASE WHEN predicted_min > 40 THEN 1 ELSE 0 END), 0) AS plate FROM outcomes)"""))
def q_sla(spark, sf):
    return finish(B.sla_analysis(outcomes(spark, sf)))


def _scen_long(profiles):
    parts = []
    for i, (p, a, b, c) in enumerate(profiles):
        raw = f"{a} * {norm('_r', 'rlo', 'rhi')} + {b} * {norm('_s', 'slo', 'shi')} - {c} * {norm('_d', 'dlo', 'dhi')}"
        parts.append(f"SELECT '{p}' AS profile, {i} AS profile_ord, restaurant_id, name, "
                     f"greatest(0.0, least(1.0, {raw})) AS score FROM si, ss")
    return {
        "si": "SELECT *, coalesce(rate, 0.0) AS _r, coalesce(avg_sentiment, 0.0) AS _s, coalesce(delay_risk, 0.5) AS _d FROM scen",
        "ss": "SELECT min(_r) AS rlo, max(_r) AS rhi, min(_s) AS slo, max(_s) AS shi, min(_d) AS dlo, max(_d) AS dhi FROM si",
        "sl": " UNION ALL ".join(parts),
    }


@register("ab_scenario_means", ssql(
    "SELECT profile, CAST(profile_ord AS BIGINT) AS profile_ord, round(avg(score), 6) + 0.0 AS mean_score FROM sl "
    "GROUP BY profile, profile_ord", _scen_long(WEIGHT_PROFILES)))
def q_ab_means(spark, sf):
    means, _ = B.ab_scenarios(scenario_frame(spark, sf))
    return finish(means)


_TOP = ("SELECT profile, restaurant_id, name, round(score, 6) + 0.0 AS score, CAST(rank AS BIGINT) AS rank FROM "
        "(SELECT *, row_number() OVER (PARTITION BY profile ORDER BY score DESC, restaurant_id) AS rank FROM sl) "
        "WHERE rank <= 10")


@register("ab_scenario_top", ssql(_TOP, _scen_long(WEIGHT_PROFILES)))
def q_ab_top(spark, sf):
    _, top = B.ab_scenarios(scenario_frame(spark, sf))
    return finish(top.select("profile", "restaurant_id", "name", "score", "rank"))


@register("profile_overlap", ssql(
    f"""SELECT a.profile AS profile_a, b.profile AS profile_b,
 CAST(count(DISTINCT CASE WHEN a.name = b.name THEN a.name END) AS BIGINT) AS overlap
FROM (SELECT DISTINCT profile, name FROM ({_TOP})) a JOIN (SELECT DISTINCT profile, name FROM ({_TOP})) b
 ON (CASE a.profile WHEN 'balanced' THEN 0 WHEN 'quality_first' THEN 1 ELSE 2 END) <
    (CASE b.profile WHEN 'balanced' THEN 0 WHEN 'quality_first' THEN 1 ELSE 2 END)
GROUP BY a.profile, b.profile""", _scen_long(WEIGHT_PROFILES)))
def q_overlap(spark, sf):
    _, top = B.ab_scenarios(scenario_frame(spark, sf))
    return finish(B.profile_overlap(top))


@register("weight_sensitivity", ssql(
    "SELECT profile, restaurant_id, round(score, 6) + 0.0 AS score, CAST(row_number() OVER (PARTITION BY profile "
    "ORDER BY score DESC, restaurant_id) - 1 AS BIGINT) AS rank FROM sl", _scen_long(SENSITIVITY_WEIGHTINGS)))
def q_sensitivity(spark, sf):
    r = B.weight_sensitivity(scenario_frame(spark, sf), SENSITIVITY_WEIGHTINGS)
    return finish(r.select("profile", "restaurant_id", "score", "rank"))


@register("weight_sensitivity_top3", ssql(
    "SELECT profile, restaurant_id, round(score, 6) + 0.0 AS score, CAST(rank AS BIGINT) AS rank FROM "
    "(SELECT *, row_number() OVER (PARTITION BY profile ORDER BY score DESC, restaurant_id) - 1 AS rank FROM sl) "
    "WHERE rank < 3", _scen_long(SENSITIVITY_WEIGHTINGS)))
def q_sensitivity_top3(spark, sf):
    sc = B.scenario_scores(scenario_frame(spark, sf), profiles=SENSITIVITY_WEIGHTINGS)
    from ladle.plans.scale import top_k_per_group
    top = top_k_per_group(sc, ["profile"], [F.desc("score"), F.asc("restaurant_id")], 3)
    return finish(top.select("profile", "restaurant_id", "score", (F.col("rank") - 1).alias("rank")))


def outcomes_unknown(spark, sf):
    """Outcomes where every 11th actual time is not known yet."""
    o = outcomes(spark, sf)
    return o.withColumn("actual_min", F.when(F.col("order_id") % 11 == 0, F.lit(None)).otherwise(F.col("actual_min")))


_OU = {"ou": "SELECT order_id, ts, CASE WHEN order_id % 11 = 0 THEN NULL ELSE actual_min END AS actual_min, "
             "predicted_min FROM outcomes"}


@register("order_sla_flags", osql(
    "SELECT order_id, predicted_min > 40 AS is_at_risk, actual_min > 40 AS actual_late FROM ou", _OU))
def q_flags(spark, sf):
    return finish(B.order_sla_flags(outcomes_unknown(spark, sf)).select("order_id", "is_at_risk", "actual_late"))


@register("running_on_time_rate", osql(
    """SELECT order_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, round(100.0 * sum(CASE WHEN (actual_min > 40) = false THEN 1 ELSE 0 END)
 OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, order_id ROWS UNBOUNDED PRECEDING) /
 count(*) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, order_id ROWS UNBOUNDED PRECEDING), 6) + 0.0 AS on_time_rate
FROM ou""", _OU))
def q_running(spark, sf):
    o = B.order_sla_flags(outcomes_unknown(spark, sf)).withColumn("day", F.to_date("ts").cast("string"))
    r = B.running_on_time_rate(o, ["day"], "ts", "order_id")
    return finish(r.select("order_id", "day", "on_time_rate"))


@register("running_on_time_rate_global", osql(
    """SELECT order_id, round(100.0 * sum(CASE WHEN (actual_min > 40) = false THEN 1 ELSE 0 END)
 OVER (ORDER BY ts, order_id ROWS UNBOUNDED PRECEDING) /
 count(*) OVER (ORDER BY ts, order_id ROWS UNBOUNDED PRECEDING), 6) + 0.0 AS on_time_rate FROM ou""", _OU))
def q_running_global(spark, sf):
    """G8 global form: one running rate over all orders; the bucketed prefix
    sums keep it off a single task."""
    o = B.order_sla_flags(outcomes_unknown(spark, sf))
    r = B.running_on_time_rate(o, [], "ts", "order_id")
    return finish(r.select("order_id", "on_time_rate"))


@register("ops_kpis", osql(
    """SELECT CAST(count(*) AS BIGINT) AS orders,
 round(100.0 * sum(CASE WHEN (actual_min > 40) = false THEN 1 ELSE 0 END) / count(*), 6) + 0.0 AS on_time_pct,
 CAST(sum(CASE WHEN predicted_min > 40 THEN 1 ELSE 0 END) AS BIGINT) AS at_risk,
 round(avg(abs(actual_min - predicted_min)), 6) + 0.0 AS mean_abs_error,
 CASE WHEN 100.0 * sum(CASE WHEN (actual_min > 40) = false THEN 1 ELSE 0 END) / count(*) > 90 THEN 'success'
      WHEN 100.0 * sum(CASE WHEN (actual_min > 40) = false THEN 1 ELSE 0 END) / count(*) < 70 THEN 'danger'
      ELSE 'default' END AS band FROM ou""", _OU))
def q_kpis(spark, sf):
    return finish(B.ops_kpis(outcomes_unknown(spark, sf)))


@register("sla_confusion", osql(
    """SELECT predicted_late, actual_late, CAST(sum(CASE WHEN (predicted_min > 40) = predicted_late AND
 (actual_min > 40) = actual_late THEN 1 ELSE 0 END) AS BIGINT) AS orders
FROM (SELECT * FROM (VALUES (false), (true)) p(predicted_late), (VALUES (false), (true)) a(actual_late)) g, outcomes
GROUP BY predicted_late, actual_late"""))
def q_confusion(spark, sf):
    return finish(B.sla_confusion(outcomes(spark, sf)))


# ---- dispatch -----------------------------------------------------------------
def dispatch_orders(spark, sf):
    """Orders by zone (user % 10) and hour window, with predicted minutes."""
    e = table(spark, sf, "events").select(
        F.col("event_id").alias("order_id"), "ts", (F.col("user_id") % 10).alias("zone"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH").alias("dispatch_window"),
        (15 + F.col("event_id") % 47 + (F.col("event_id") * 7) % 11 - 5).cast("double").alias("predicted_min"))
    return e


def dispatch_partners(spark, sf):
    """Delivery partners from suppliers: zone = key % 10, speed factor in [0.8, 1.2]."""
    s = table(spark, sf, "supplier")
    return s.select(F.col("s_suppkey").alias("partner_id"), (F.col("s_suppkey") % 10).alias("zone"),
                    (0.8 + (F.col("s_suppkey") % 41) / 100.0).alias("factor"))


_DISPATCH_SQL = {
    "dord": """SELECT event_id AS order_id, ts, user_id % 10 AS zone, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS dispatch_window,
 CAST(15 + event_id % 47 + (event_id * 7) % 11 - 5 AS DOUBLE) AS predicted_min FROM events""",
    "dpar": "SELECT s_suppkey AS partner_id, s_suppkey % 10 AS zone, 0.8 + (s_suppkey % 41) / 100.0 AS factor FROM supplier",
    "ork": """SELECT o.*, row_number() OVER (PARTITION BY zone, dispatch_window ORDER BY predicted_min, order_id) AS k,
 count(*) OVER (PARTITION BY zone, dispatch_window) AS n FROM dord o""",
    "prk": """SELECT p.*, row_number() OVER (PARTITION BY zone ORDER BY factor, partner_id) AS j,
 count(*) OVER (PARTITION BY zone) AS pc FROM dpar p""",
    "sep": """SELECT o.zone, o.dispatch_window, o.order_id, p.partner_id, o.predicted_min * p.factor AS cost
 FROM ork o JOIN prk p ON p.zone = o.zone AND p.j = least(o.n, p.pc) - o.k + 1 WHERE o.k <= least(o.n, p.pc)""",
}


@register("assign_separable", with_views(
    "SELECT zone, dispatch_window, order_id, partner_id, round(cost, 6) + 0.0 AS cost FROM sep", extra=_DISPATCH_SQL))
def q_separable(spark, sf):
    a = B.assign_separable(dispatch_orders(spark, sf), dispatch_partners(spark, sf), ["zone", "dispatch_window"], "zone")
    return finish(a)


_LOADED_SQL = """WITH RECURSIVE {views},
pl AS (SELECT zone, list(partner_id ORDER BY partner_id) AS ids, list(factor ORDER BY partner_id) AS fs FROM dpar GROUP BY zone),
oq AS (SELECT o.*, row_number() OVER (PARTITION BY zone, dispatch_window ORDER BY ts, order_id) AS k FROM dord o),
st AS (SELECT zone, dispatch_window, CAST(0 AS BIGINT) AS k, list_transform(ids, lambda x: CAST(0 AS DOUBLE)) AS loads, CAST(NULL AS BIGINT) AS order_id,
  CAST(NULL AS BIGINT) AS partner_id, CAST(NULL AS DOUBLE) AS cost FROM (SELECT DISTINCT zone, dispatch_window FROM oq) JOIN pl USING (zone)
 UNION ALL SELECT zone, dispatch_window, k, list_transform(loads, lambda x, i: CASE WHEN i = j THEN x + predicted_min * fs[j] ELSE x END), order_id, ids[j],
  predicted_min * fs[j] FROM (SELECT s.zone, s.dispatch_window, q.k, loads, q.order_id, q.predicted_min, ids, fs, list_position(loads, list_min(loads)) AS j
   FROM st s JOIN oq q ON q.zone = s.zone AND q.dispatch_window = s.dispatch_window AND q.k = s.k + 1 JOIN pl ON pl.zone = s.zone))
SELECT zone, dispatch_window, order_id, partner_id, round(cost, 6) + 0.0 AS cost FROM st WHERE k > 0"""


@register("assign_least_loaded", _LOADED_SQL.replace("{views}", ", ".join(f"{n} AS ({_DISPATCH_SQL[n]})" for n in ("dord", "dpar"))))
def q_least_loaded(spark, sf):
    """In sequence inside a dispatch group; the oracle goes through each group order by order."""
    a = B.assign_least_loaded(dispatch_orders(spark, sf), dispatch_partners(spark, sf), ["zone", "dispatch_window"], "zone")
    return finish(a)


@register("compare_assignment")
def q_compare(spark, sf):
    o, p = materialize(dispatch_orders(spark, sf)), materialize(dispatch_partners(spark, sf))
    sep = B.assign_separable(o, p, ["zone", "dispatch_window"], "zone")
    ll = B.assign_least_loaded(o, p, ["zone", "dispatch_window"], "zone")
    return finish(B.compare_assignment(sep, ll, ["zone", "dispatch_window"]))
