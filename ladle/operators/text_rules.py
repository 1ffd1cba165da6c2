"""Rule-based conversation, narration and request tables (K1-K8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.config import DEFAULTS
from ladle.dims import CITY_CENTRE
from ladle.functions.geo import haversine_km
from ladle.operators.matching import first_within, match_requests
from ladle.plans.scale import top_k_per_group

# ---- FIXED VALUES: intent rules, checked in this order ----------------------
# (pattern, intent, anchored at the start?)
INTENT_RULES = [
    (r"(?:cheap|budget|affordable|under\s+₹?\d+)", "budget_search", False),
    (r"(?:spicy|spice|hot)", "cuisine_search", False),
    (r"(?:find|search|look|show|get|recommend|suggest)\s+(?:me\s+)?(?:some\s+)?(.+?)(?:\s+(?:in|near|at)\s+(.+))?$",
     "search", True),
    (r"(?:how\s+long|eta|delivery\s+time|when)\s+(?:for|does|will)\s+(?:delivery\s+)?(?:from\s+)?(.+?)(?:\s+take)?(?:\?)?$",
     "eta", True),
    (r"(?:reliability|reliable|trust|score|rating)\s+(?:of|for|score)?\s*(.+?)(?:\?)?$", "reliability", False),
    (r"(?:hello|hi|hey|namaste)", "greeting", True),
]
BUDGET_PATTERN = r"under\s+₹?(\d+)"

GREETING_TEXT = (
    "👋 **Namaste!** I'm your Food Concierge. "
    "I can help you find restaurants, check delivery ETAs, "
    "or look up reliability scores. Try asking something like:\n"
    '- "Find North Indian food near Koramangala"\n'
    '- "How long does delivery from Meghana Foods take?"\n'
    '- "What\'s the reliability score for Truffles?"'
)
UNKNOWN_TEXT = (
    "🤔 I'm not sure I understood that. Here's what I can help with:\n\n"
    '🔍 **Search** — "Find North Indian food near Koramangala"\n'
    '⏱️ **ETA** — "How long does delivery from Meghana Foods take?"\n'
    '📊 **Reliability** — "What\'s the reliability score for Truffles?"\n'
    '💰 **Budget** — "Find cheap restaurants under ₹300"\n\n'
    "Try one of those! 😊"
)
# -----------------------------------------------------------------------------


def _rx(pattern: str, anchored: bool) -> str:
    return "(?i)" + ("^" if anchored else "") + pattern


def classify_intent(messages: DataFrame, col: str = "message") -> DataFrame:
    """K4: ordered regex rules -> intent plus extracted query / area /
    restaurant / budget / cuisine. A pure projection (no join, no Python)."""
    t = F.lower(F.regexp_replace(F.col(col), r"^\s+|\s+$", ""))
    intent = None
    for pat, name, anchored in INTENT_RULES:
        cond = t.rlike(_rx(pat, anchored))
        intent = F.when(cond, name) if intent is None else intent.when(cond, name)
    intent = intent.otherwise("unknown")
    rules = {n: _rx(p, a) for p, n, a in INTENT_RULES}
    x = messages.withColumn("_t", t).withColumn("intent", intent)
    t = F.col("_t")
    ex = lambda n, g: F.trim(F.regexp_extract(t, rules[n], g))
    it = F.col("intent")
    return x.withColumns({
        "query": F.when(it == "search", ex("search", 1)),
        "area": F.when(it == "search", F.nullif(ex("search", 2), F.lit(""))),
        "restaurant": F.when(it == "eta", ex("eta", 1)).when(it == "reliability", ex("reliability", 1)),
        "budget": F.when(it == "budget_search",
                         F.nullif(F.regexp_extract(t, BUDGET_PATTERN, 1), F.lit(""))),
        "cuisine": F.when(it == "cuisine_search", F.lit("indian")),
    }).drop("_t")


def search_restaurants(df: DataFrame, cuisine=None, budget=None, area=None, n: int = 5,
                       id_col: str = "restaurant_id") -> DataFrame:
    """K1: the preference filter, first n in stored (id) order."""
    from ladle.operators.recommend import filter_preferences
    return filter_preferences(df, cuisine, budget, area).orderBy(id_col).limit(n)


def eta_minutes(lat: Column, lon: Column) -> Column:
    """K2 without a model: round(max(10, 3 km + 15)) half-even, where km is
    the distance to the city centre, or 5 km without coordinates."""
    km = F.coalesce(haversine_km(lat, lon, F.lit(CITY_CENTRE[0]), F.lit(CITY_CENTRE[1])), F.lit(5.0))
    return F.bround(F.greatest(F.lit(10.0), km * 3 + 15), 0).cast("bigint")


def contains_lookup(queries: DataFrame, qcol: str, table: DataFrame, tcol: str, id_col: str) -> DataFrame:
    """For every distinct query text: the row of ``table`` with the lowest
    ``id_col`` whose ``tcol`` contains it (case-insensitive), or nothing.

    Exact for texts of any length: a query meets only the names with its
    rarest gram (``match_requests``). An empty text is held by every name.
    """
    q = queries.select(F.lower(F.col(qcol)).alias("_q")).where(F.col("_q").isNotNull()).distinct()
    t = table.select(F.col(id_col), F.col(tcol).alias("_n")).where(F.col("_n").isNotNull())
    return match_requests(q, "_q", t, [("_q", "_n")], id_col).groupBy("_q").agg(F.min(id_col).alias(id_col))


def answer_messages(messages: DataFrame, restaurants: DataFrame, id_col: str = "restaurant_id") -> DataFrame:
    """K5: the rule-based reply to every message.

    K4 gives intent and parameters; distinct search requests are matched
    against the restaurants through their rarest grams (``match_requests``; top
    5 per request by id, salted), those with a budget alone through the order of
    costs (``first_within``), name lookups use
    ``contains_lookup``; the replies are assembled with ``format_string``
    templates. Returns (conv_id, turn, intent, response)."""
    c = classify_intent(messages)
    cuisine = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("query", F.lit("")), "food", ""), "restaurants", ""))
    c = c.withColumns({
        "_cuisine": F.when(F.col("intent") == "search", F.nullif(cuisine, F.lit(""))),
        "_area": F.when(F.col("intent") == "search", F.col("area")),
        "_budget_txt": F.when(F.col("intent") == "budget_search", F.coalesce("budget", F.lit("500"))),
    })
    c = c.withColumn("_budget", F.col("_budget_txt").cast("double"))
    c = c.withColumn("_skey", F.when(F.col("intent").isin("search", "budget_search"),
                                     F.sha2(F.to_json(F.struct("intent", "_cuisine", "_area", "_budget")), 256)))
    # the classified messages feed three branches below: store them once (the
    # regex rules are then evaluated once, outside any aggregate's codegen)
    from ladle.plans.scale import materialize
    c = materialize(c)
    keys = c.where(F.col("_skey").isNotNull()).select("_skey", "intent", "_cuisine", "_area", "_budget").dropDuplicates(["_skey"])
    r = restaurants
    # a request without a text passes by its budget alone; the others meet the rows with their rarest gram
    texts = [("_cuisine", "cuisines"), ("_area", "location")]
    open_ = F.col("_cuisine").isNull() & F.col("_area").isNull()
    asked = r.select(id_col, "cuisines", "location", "cost_for_two")
    found = match_requests(keys.where(~open_), "_skey", asked, texts, id_col)
    found = found.where(F.col("_budget").isNull() | (F.col("_budget") == 0)
                        | F.coalesce(F.col("cost_for_two") <= F.col("_budget"), F.lit(False))).select("_skey", id_col)
    found = top_k_per_group(found, ["_skey"], [F.asc(id_col)], 5).drop("rank").unionByName(
        first_within(keys.where(open_), "_skey", "_budget", asked, "cost_for_two", id_col, 5))
    top = found.join(r.select(id_col, "name", "rate", "cost_for_two", "location"), id_col).join(keys.select("_skey", "intent"), "_skey")
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("_skey").orderBy(id_col))).where("rank <= 5")  # few rows a request
    num = lambda col: F.col(col).cast("string")
    line = F.when(F.col("intent") == "search",
                  F.format_string("- **%s** — %s/5 | ₹%s | %s", "name", num("rate"), num("cost_for_two"), "location")) \
        .otherwise(F.format_string("- **%s** — ₹%s | %s", "name", num("cost_for_two"), "location"))
    lists = top.groupBy("_skey").agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("l")))),
                                 lambda s: s["l"]), "\n").alias("_lines"))
    c = c.join(lists, "_skey", "left")
    # name lookups for eta / reliability
    hits = contains_lookup(c.where(F.col("intent").isin("eta", "reliability")), "restaurant", r, "name", id_col)
    info = hits.join(r.select(id_col, "latitude", "longitude", "reliability_score"), id_col)
    c = c.withColumn("_q", F.lower("restaurant")).join(info, "_q", "left")
    eta = eta_minutes(F.col("latitude"), F.col("longitude"))
    score = F.coalesce(F.col("reliability_score"), F.lit(0.5))
    badge = F.when(score >= 0.7, "🟢 **Highly Reliable**").when(score >= 0.4, "🟡 **Moderately Reliable**") \
        .otherwise("🔴 **Low Reliability**")
    found_any = F.col(id_col).isNotNull()
    it = F.col("intent")
    none_search = F.concat(F.lit("😅 I couldn't find any restaurants matching "),
                           F.when(F.col("_cuisine").isNotNull(), F.concat(F.lit("cuisine: "), "_cuisine")).otherwise(""),
                           F.lit(" "),
                           F.when(F.col("_area").isNotNull(), F.concat(F.lit("area: "), "_area")).otherwise(""),
                           F.lit(". Try broadening your search!"))
    resp = (
        F.when(it == "greeting", F.lit(GREETING_TEXT))
        .when((it == "search") & F.col("_n").isNull(), none_search)
        .when(it == "search", F.concat(F.format_string("🍽️ **Found %d restaurants:**\n", "_n"), "_lines"))
        .when((it == "budget_search") & F.col("_n").isNull(),
              F.format_string("😅 No restaurants found under ₹%s.", "_budget_txt"))
        .when(it == "budget_search", F.concat(F.format_string("💰 **Restaurants under ₹%s:**\n", "_budget_txt"), "_lines"))
        .when((it == "eta") & found_any,
              F.format_string("🚀 For **%s**:\n- Estimated delivery: **~%d min**\n- ✅ **On track**\n"
                              "_approximate (no model loaded)_", F.col("restaurant"), eta))
        .when(it == "eta", F.format_string("😅 I couldn't find ETA data for '%s'. Is the name spelled correctly?",
                                           "restaurant"))
        .when((it == "reliability") & found_any,
              F.format_string("📊 %s\n**%s** reliability score: **%.2f/1.0**", badge, F.col("restaurant"), score))
        .when(it == "reliability", F.format_string("😅 I couldn't find reliability data for '%s'.", "restaurant"))
        .otherwise(F.lit(UNKNOWN_TEXT))
    )
    return c.select("conv_id", "turn", "intent", resp.alias("response"))


def narrate(df: DataFrame, eta_col: str | None = None) -> DataFrame:
    """K6: template sentence per restaurant (rating bands 4 / 3, cost 300 / 800,
    sentiment > .3 / < -.2, reliability .7 / .4, optional ETA)."""
    rate, cost = F.col("rate"), F.col("cost_for_two")
    sent = F.coalesce(F.col("avg_sentiment"), F.lit(0.0)) if "avg_sentiment" in df.columns else F.lit(0.0)
    rel = F.coalesce(F.col("reliability_score"), F.lit(0.5)) if "reliability_score" in df.columns else F.lit(0.5)
    parts = [
        F.format_string("**%s** — %s in **%s**", F.coalesce("name", F.lit("This restaurant")),
                        F.coalesce("cuisines", F.lit("a variety of dishes")), F.coalesce("location", F.lit("your area"))),
        F.when(rate >= 4.0, F.format_string("Highly rated (%s/5)", rate.cast("string")))
        .when(rate >= 3.0, F.format_string("Decent rating (%s/5)", rate.cast("string")))
        .when(rate.isNotNull(), F.format_string("Average rating (%s/5)", rate.cast("string"))),
        F.when(cost <= 300, "budget-friendly").when(cost <= 800, "moderately priced").when(cost.isNotNull(), "premium"),
        F.when(sent > 0.3, "positive customer sentiment").when(sent < -0.2, "mixed customer reviews")
        .otherwise("neutral customer sentiment"),
        F.when(rel >= 0.7, "high overall reliability").when(rel >= 0.4, "moderate reliability")
        .otherwise("lower reliability — consider alternatives"),
    ]
    if eta_col:
        parts.append(F.when(F.col(eta_col).isNotNull(), F.format_string("~%.0f min delivery estimate", F.col(eta_col).cast("double"))))
    return df.withColumn("narration", F.concat(F.concat_ws(" · ", *parts), F.lit(".")))


# ---- K8: request validation ------------------------------------------------------
RANGES = {
    "distance_km": (lambda c: (c > 0) & (c <= 100), "distance_km must be in (0, 100]"),
    "traffic_level": (lambda c: c.between(0, 3), "traffic_level must be 0-3"),
    "delivery_person_age": (lambda c: c.between(18, 70), "delivery_person_age must be 18-70"),
    "delivery_person_rating": (lambda c: c.between(1, 5), "delivery_person_rating must be 1-5"),
    "vehicle_condition": (lambda c: c.between(0, 3), "vehicle_condition must be 0-3"),
    "budget": (lambda c: c >= 0, "budget must be >= 0"),
    "top_n": (lambda c: c.between(1, 50), "top_n must be 1-50"),
    "priority": (lambda c: c.isin("balanced", "speed", "quality"), "priority must be balanced, speed or quality"),
    "role": (lambda c: c.isin("user", "assistant"), "role must be user or assistant"),
    "message": (lambda c: F.length(c).between(1, 2000), "message must be 1-2000 characters"),
}


def validate_requests(df: DataFrame, required=("distance_km",)) -> DataFrame:
    """K8: per request the list of violated rules (null values pass unless
    required) and a ``valid`` flag; split with ``where('valid')`` /
    ``where('not valid')`` into accepted and quarantined rows."""
    checks = []
    for col, (ok, msg) in RANGES.items():
        if col not in df.columns:
            continue
        c = F.col(col)
        bad = c.isNull() if col in required else F.lit(False)
        bad = bad | (c.isNotNull() & ~F.coalesce(ok(c), F.lit(False)))
        checks.append(F.when(bad, F.lit(msg)))
    reasons = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
    return df.withColumn("reasons", reasons).withColumn("valid", F.size("reasons") == 0)
