"""Queries for ranking, recommendation, similarity, CF and clustering (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators import recommend as R
from ladle.operators import similarity as S
from ladle.plans.catalog import finish, register
from ladle.plans.common import STORED_SQL, deliveries, stored_interactions, stored_restaurants
from ladle.plans.q_business import rel_sql, _REL_STATS
from ladle.plans.sql_blocks import restaurants_clean
from ladle.plans.views_sql import with_views
from ladle.sources.fixtures import interactions, table

CONTENT = ["cost_for_two", "votes_log", "online_order_binary", "cuisine_count"]

_SRF = {
    "relst": _REL_STATS,
    "srf": f"""SELECT sr.*, ln(1 + coalesce(CAST(sr.votes AS DOUBLE), 0)) AS votes_log,
 CAST(CASE WHEN rc.online_order = 'Yes' THEN 1 ELSE 0 END AS BIGINT) AS online_order_binary,
 CAST(coalesce(len(string_split(sr.cuisines, ',')), 1) AS BIGINT) AS cuisine_count,
 CASE WHEN s.rate IS NULL OR s.avg_sentiment IS NULL OR s.delay_risk IS NULL THEN NULL
 ELSE {rel_sql(0.4, 0.3, 0.3, r='s.rate', s='s.avg_sentiment', d='s.delay_risk')} END
 AS reliability_score
FROM sr JOIN restaurants_clean rc USING (restaurant_id) JOIN scen s USING (restaurant_id), relst""",
}


def rs(body: str, extra: dict | None = None) -> str:
    return with_views(body, "restaurants_raw", "interactions",
                      extra={**restaurants_clean(), **STORED_SQL, **_SRF, **(extra or {})})


def dot_sql(prefix: str = "") -> tuple[str, str, str]:
    x = [f"coalesce(CAST({prefix}{c} AS DOUBLE), 0.0)" for c in CONTENT]
    q = [f"coalesce(m{i}, 0.0)" for i in range(len(CONTENT))]
    dot = "(0.0" + "".join(f" + {a} * {b}" for a, b in zip(x, q)) + ")"
    nx = "sqrt(0.0" + "".join(f" + {a} * {a}" for a in x) + ")"
    nq = "sqrt(0.0" + "".join(f" + {b} * {b}" for b in q) + ")"
    return dot, nx, nq


def cos_sql(src: str, cen_src: str) -> str:
    dot, nx, nq = dot_sql()
    cen = ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(CONTENT))
    return (f"SELECT {src}.*, coalesce(CASE WHEN {nx} * {nq} = 0 THEN NULL ELSE {dot} / ({nx} * {nq}) END, 0.0) AS _cos "
            f"FROM {src}, (SELECT {cen} FROM {cen_src})")


FILTER = "regexp_matches(cuisines, '(?i)chinese') AND cost_for_two <= 1500"


@register("bayesian_rating", rs("SELECT restaurant_id, round(bayesian_rating, 6) + 0.0 AS bayesian_rating FROM sr"))
def q_bayes(spark, sf):
    return finish(stored_restaurants(spark, sf).select("restaurant_id", "bayesian_rating"))


@register("filter_preferences", rs(
    f"SELECT restaurant_id, name FROM srf WHERE {FILTER} AND regexp_matches(location, '(?i)koramangala')"))
def q_filter(spark, sf):
    r = R.filter_preferences(stored_restaurants(spark, sf), "Chinese", 1500, "koramangala")
    return finish(r.select("restaurant_id", "name"))


@register("cosine_to_centroid", rs("SELECT restaurant_id, round(_cos, 6) + 0.0 AS similarity_score FROM c",
                                   {"c": cos_sql("srf", "srf")}))
def q_cosine(spark, sf):
    r = R.cosine_to_centroid(stored_restaurants(spark, sf), CONTENT)
    return finish(r.select("restaurant_id", "similarity_score"))


@register("recommend_content", rs(
    """SELECT restaurant_id, name, round(_cos, 6) + 0.0 AS similarity_score,
 round(0.5 * _cos + 0.5 * (bayesian_rating / 5.0), 6) + 0.0 AS combined_score
FROM c ORDER BY 0.5 * _cos + 0.5 * (bayesian_rating / 5.0) DESC, restaurant_id LIMIT 5""",
    {"cand": f"SELECT * FROM srf WHERE {FILTER}", "c": cos_sql("cand", "cand")}))
def q_content(spark, sf):
    r = R.recommend_content(stored_restaurants(spark, sf), CONTENT, cuisine="chinese", budget=1500, n=5)
    return finish(r.select("restaurant_id", "name", "similarity_score", "combined_score"))


@register("explanation_text", rs(
    """SELECT restaurant_id, concat_ws(' | ', printf('Rated %s/5', CAST(rate AS VARCHAR)), printf('(adj: %.2f)', bayesian_rating),
 printf('₹%d for two', CAST(cost_for_two AS BIGINT)), concat('Cuisines: ', substr(cuisines, 1, 60))) AS recommendation_explanation
FROM srf"""))
def q_explain_text(spark, sf):
    r = stored_restaurants(spark, sf)
    return finish(r.select("restaurant_id", R.explanation_content().alias("recommendation_explanation")))


@register("content_score_minmax", rs(
    "SELECT restaurant_id, round(CASE WHEN hi = lo THEN 0.5 ELSE (_cos - lo) / (hi - lo) END, 6) + 0.0 AS content_score "
    "FROM c, (SELECT min(_cos) AS lo, max(_cos) AS hi FROM c)",
    {"cand": f"SELECT * FROM srf WHERE {FILTER}", "c": cos_sql("cand", "srf")}))
def q_content_score(spark, sf):
    st = stored_restaurants(spark, sf)
    cand = R.cosine_to_centroid(R.filter_preferences(st, "chinese", 1500), CONTENT, over=st, out="_cos")
    return finish(R.minmax_within(cand, "_cos", out="content_score").select("restaurant_id", "content_score"))


EXPLAIN_SQL = """concat_ws(' | ', CASE WHEN rate IS NOT NULL AND rate <> 0 THEN printf('Rated %s/5', CAST(rate AS VARCHAR)) END,
 printf('%s Rel:%.2f', CASE WHEN coalesce(reliability_score, 0.5) >= 0.7 THEN '🟢' WHEN coalesce(reliability_score, 0.5) >= 0.4 THEN '🟡' ELSE '🔴' END,
 coalesce(reliability_score, 0.5)), CASE WHEN cost_for_two IS NOT NULL AND cost_for_two <> 0 THEN printf('₹%d', CAST(cost_for_two AS BIGINT)) END)"""


def _hybrid_sql(priority: str) -> str:
    wc, wf, wr, wb = R.hybrid_weights(priority)
    comb = (f"{wc} * content_score + {wf} * 0.5 + {wr} * coalesce(reliability_score, 0.5) + "
            f"{wb} * (bayesian_rating / 5.0)")
    return rs(
        f"""SELECT restaurant_id, name, round(content_score, 6) + 0.0 AS content_score, CAST(0.5 AS DOUBLE) AS cf_score,
 round(coalesce(reliability_score, 0.5), 6) + 0.0 AS reliability_score_display, round({comb}, 6) + 0.0 AS combined_score,
 {EXPLAIN_SQL} AS explanation
FROM (SELECT *, CASE WHEN hi = lo THEN 0.5 ELSE (_cos - lo) / (hi - lo) END AS content_score
      FROM c, (SELECT min(_cos) AS lo, max(_cos) AS hi FROM c))
ORDER BY {comb} DESC, restaurant_id LIMIT 5""",
        {"cand": f"SELECT * FROM srf WHERE {FILTER}", "c": cos_sql("cand", "srf")})


def _hybrid(spark, sf, priority):
    r = R.recommend_hybrid(stored_restaurants(spark, sf), CONTENT, cuisine="chinese", budget=1500,
                           priority=priority, n=5)
    return finish(r.select("restaurant_id", "name", "content_score", "cf_score", "reliability_score_display",
                           "combined_score", "explanation"))


def _ratings(spark, sf):
    """A collaborative table from the interactions: mean rating on [0, 1], for
    the restaurants of three of four ids; the others have none."""
    g = interactions(spark, sf).groupBy("restaurant_id").agg((F.avg("rating") / 5).alias("cf_score"))
    return g.where(F.col("restaurant_id") % 4 != 0)


_CF_SQL = {"cf": "SELECT restaurant_id, avg(rating) / 5 AS cf_score FROM interactions WHERE restaurant_id % 4 <> 0 GROUP BY 1"}


@register("recommend_hybrid_balanced", _hybrid_sql("balanced"))
def q_hybrid_balanced(spark, sf):
    return _hybrid(spark, sf, "balanced")


@register("recommend_hybrid_quality", _hybrid_sql("quality"))
def q_hybrid_quality(spark, sf):
    return _hybrid(spark, sf, "quality")


@register("recommend_hybrid_speed", _hybrid_sql("speed"))
def q_hybrid_speed(spark, sf):
    return _hybrid(spark, sf, "speed")


def requests_table(spark, sf):
    """Recommendation requests from customers: cuisine from the market
    segment, budget from the account balance band, area every third
    customer, priority by nation; many are identical (dedupe exercised)."""
    c = table(spark, sf, "customer")
    seg = F.element_at(F.array(*[F.lit(x) for x in ["Chinese", "North Indian", "Cafe", "Biryani", "Bakery"]]),
                       (1 + F.col("c_custkey") % 5).cast("int"))
    return c.select(
        F.col("c_custkey").alias("request_id"), seg.alias("cuisine"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(None)).otherwise((F.col("c_custkey") % 3 + 1) * 500.0).alias("budget"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("Koramangala")).alias("area"),
        F.element_at(F.array(F.lit("balanced"), F.lit("speed"), F.lit("quality"), F.lit("other")),
                     (1 + F.col("c_nationkey") % 4).cast("int")).alias("priority"),
        F.lit(5).alias("top_n"))


_REQ_SQL = {
    "req": """SELECT c_custkey AS request_id,
 CASE c_custkey % 5 WHEN 0 THEN 'Chinese' WHEN 1 THEN 'North Indian' WHEN 2 THEN 'Cafe' WHEN 3 THEN 'Biryani' ELSE 'Bakery' END AS cuisine,
 CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE (c_custkey % 3 + 1) * 500.0 END AS budget,
 CASE WHEN c_custkey % 3 = 0 THEN 'Koramangala' END AS area,
 CASE c_nationkey % 4 WHEN 0 THEN 'balanced' WHEN 1 THEN 'speed' WHEN 2 THEN 'quality' ELSE 'other' END AS priority
 FROM customer""",
    "rk": """SELECT DISTINCT cuisine, budget, area, priority,
 CASE priority WHEN 'speed' THEN 0.2 WHEN 'quality' THEN 0.25 ELSE 0.4 END AS wc,
 CASE priority WHEN 'speed' THEN 0.2 WHEN 'quality' THEN 0.25 ELSE 0.3 END AS wf,
 CASE priority WHEN 'speed' THEN 0.5 WHEN 'quality' THEN 0.1 ELSE 0.3 END AS wr,
 CASE priority WHEN 'speed' THEN 0.1 WHEN 'quality' THEN 0.4 ELSE 0.0 END AS wb FROM req""",
    "c": cos_sql("srf", "srf"),
    "cand": """SELECT k.*, c.restaurant_id, c._cos, coalesce(c.reliability_score, 0.5) AS rel, c.bayesian_rating / 5.0 AS bn
 FROM rk k JOIN c ON (k.cuisine IS NULL OR k.cuisine = '' OR coalesce(regexp_matches(c.cuisines, '(?i)' || k.cuisine), false))
 AND (k.budget IS NULL OR k.budget = 0 OR coalesce(c.cost_for_two <= k.budget, false))
 AND (k.area IS NULL OR k.area = '' OR coalesce(regexp_matches(c.location, '(?i)' || k.area), false))""",
    "mm": """SELECT cand.*, CASE WHEN max(_cos) OVER w = min(_cos) OVER w THEN 0.5
 ELSE (_cos - min(_cos) OVER w) / (max(_cos) OVER w - min(_cos) OVER w) END AS content
 FROM cand WINDOW w AS (PARTITION BY cuisine, budget, area, priority)""",
    "sc": """SELECT *, wc * content + wf * 0.5 + wr * rel + wb * bn AS combined,
 row_number() OVER (PARTITION BY cuisine, budget, area, priority ORDER BY wc * content + wf * 0.5 + wr * rel + wb * bn DESC,
 restaurant_id) AS rank FROM mm""",
}


@register("recommend_batch", rs(
    """SELECT r.request_id, s.restaurant_id, CAST(s.rank AS BIGINT) AS rank, round(s.combined, 6) + 0.0 AS combined_score
FROM req r JOIN sc s ON s.cuisine IS NOT DISTINCT FROM r.cuisine AND s.budget IS NOT DISTINCT FROM r.budget
 AND s.area IS NOT DISTINCT FROM r.area AND s.priority IS NOT DISTINCT FROM r.priority WHERE s.rank <= 5""", _REQ_SQL))
def q_batch(spark, sf):
    """H9 over all customers' requests; checked against per-request H8 in tests."""
    out = R.recommend_batch(requests_table(spark, sf), stored_restaurants(spark, sf), CONTENT)
    return finish(out.select("request_id", "restaurant_id", "rank", "combined_score"))


@register("recommend_batch_cf", rs(
    """SELECT r.request_id, s.restaurant_id, CAST(s.rank AS BIGINT) AS rank, round(s.combined, 6) + 0.0 AS combined_score
FROM req r JOIN sc s ON s.cuisine IS NOT DISTINCT FROM r.cuisine AND s.budget IS NOT DISTINCT FROM r.budget
 AND s.area IS NOT DISTINCT FROM r.area AND s.priority IS NOT DISTINCT FROM r.priority WHERE s.rank <= 5""",
    {**_CF_SQL, **{k: v.replace("c.bayesian_rating / 5.0 AS bn", "c.bayesian_rating / 5.0 AS bn, coalesce(cf.cf_score, 0.5) AS cfs")
                   .replace(" FROM rk k JOIN c ON", " FROM rk k CROSS JOIN c LEFT JOIN cf USING (restaurant_id) WHERE").replace("wf * 0.5", "wf * cfs")
                   for k, v in _REQ_SQL.items()}}))
def q_batch_cf(spark, sf):
    """H6 and H9: the same requests with collaborative scores; 0.5 where a restaurant has none."""
    out = R.recommend_batch(requests_table(spark, sf), stored_restaurants(spark, sf), CONTENT, cf=_ratings(spark, sf))
    return finish(out.select("request_id", "restaurant_id", "rank", "combined_score"))


@register("hybrid_weights", """SELECT priority, CAST(w_content AS DOUBLE) AS w_content,
 CAST(w_collaborative AS DOUBLE) AS w_collaborative, CAST(w_reliability AS DOUBLE) AS w_reliability,
 CAST(w_bayesian AS DOUBLE) AS w_bayesian FROM (VALUES
 ('balanced', 0.4, 0.3, 0.3, 0.0), ('speed', 0.2, 0.2, 0.5, 0.1), ('quality', 0.25, 0.25, 0.1, 0.4),
 ('other', 0.4, 0.3, 0.3, 0.0)) t(priority, w_content, w_collaborative, w_reliability, w_bayesian)
 WHERE priority IN (SELECT DISTINCT CASE c_nationkey % 4 WHEN 0 THEN 'balanced' WHEN 1 THEN 'speed'
 WHEN 2 THEN 'quality' ELSE 'other' END FROM customer)""")
def q_weights(spark, sf):
    pr = requests_table(spark, sf).select("priority").distinct()
    prof = {p: w for p, *w in [(p, *R.hybrid_weights(p)) for p in ("balanced", "speed", "quality")]}
    m = lambda i: F.create_map(*[x for p, w in prof.items() for x in (F.lit(p), F.lit(w[i]))])
    bal = R.hybrid_weights("balanced")
    return finish(pr.select("priority", *[F.coalesce(m(i)[F.col("priority")], F.lit(bal[i])).alias(n) for i, n in
                                          enumerate(["w_content", "w_collaborative", "w_reliability", "w_bayesian"])]))


# ---- vectors and nearest neighbours -----------------------------------------------
@register("embed", rs(
    """SELECT restaurant_id, round(CASE WHEN n > 0 THEN c0 / n ELSE c0 END, 6) + 0.0 AS e0,
 round(CASE WHEN n > 0 THEN c3 / n ELSE c3 END, 6) + 0.0 AS e3 FROM
 (SELECT restaurant_id, coalesce(CAST(cost_for_two AS DOUBLE), 0.0) AS c0, coalesce(CAST(cuisine_count AS DOUBLE), 0.0) AS c3,
   sqrt(0.0 + coalesce(CAST(cost_for_two AS DOUBLE), 0.0) * coalesce(CAST(cost_for_two AS DOUBLE), 0.0)
   + coalesce(CAST(votes_log AS DOUBLE), 0.0) * coalesce(CAST(votes_log AS DOUBLE), 0.0)
   + coalesce(CAST(online_order_binary AS DOUBLE), 0.0) * coalesce(CAST(online_order_binary AS DOUBLE), 0.0)
   + coalesce(CAST(cuisine_count AS DOUBLE), 0.0) * coalesce(CAST(cuisine_count AS DOUBLE), 0.0)) AS n FROM srf)"""))
def q_embed(spark, sf):
    e = S.embed(stored_restaurants(spark, sf), CONTENT)
    return finish(e.select("restaurant_id", F.col("embedding")[0].alias("e0"), F.col("embedding")[3].alias("e3")))


def _queries(spark, sf):
    """The first vector of every label is a query (the request list grows only with the label set)."""
    e = table(spark, sf, "embeddings")
    first = e.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    return e.join(first, ["label", "vec_id"]).select("vec_id", "embedding")


def _knn_sql(score: str) -> str:
    return f"""WITH q AS (SELECT e.vec_id AS query_id, e.embedding AS qv FROM embeddings e
 JOIN (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY label) f USING (label, vec_id)),
s AS (SELECT q.query_id, t.vec_id, {score} AS score FROM q, embeddings t WHERE t.vec_id <> q.query_id)
SELECT query_id, vec_id, round(score, 3) + 0.0 AS score, CAST(rank AS BIGINT) AS rank FROM
 (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


_DOT = "list_sum(list_transform(list_zip(CAST(t.embedding AS DOUBLE[]), CAST(q.qv AS DOUBLE[])), lambda x: x[1] * x[2]))"
_NT = "sqrt(list_sum(list_transform(CAST(t.embedding AS DOUBLE[]), lambda x: x * x)))"
_NQ = "sqrt(list_sum(list_transform(CAST(q.qv AS DOUBLE[]), lambda x: x * x)))"
_L2 = "1.0 / (1.0 + list_sum(list_transform(list_zip(CAST(t.embedding AS DOUBLE[]), CAST(q.qv AS DOUBLE[])), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))"


@register("similar_cosine", _knn_sql(f"coalesce(CASE WHEN {_NT} * {_NQ} = 0 THEN NULL ELSE {_DOT} / ({_NT} * {_NQ}) END, 0.0)"))
def q_similar_cosine(spark, sf):
    out = S.nearest(table(spark, sf, "embeddings"), _queries(spark, sf), "vec_id", "embedding", 5, "cosine")
    return finish(out.select("query_id", "vec_id", "score", "rank"))


@register("similar_l2", _knn_sql(_L2))
def q_similar_l2(spark, sf):
    out = S.nearest(table(spark, sf, "embeddings"), _queries(spark, sf), "vec_id", "embedding", 5, "l2")
    return finish(out.select("query_id", "vec_id", "score", "rank"))


# ---- collaborative filtering --------------------------------------------------------
def _cf_model(spark, sf):
    key = ("cf", spark.sparkContext.applicationId, sf)
    if key not in _CF:
        _CF[key] = S.train_cf(stored_interactions(spark, sf), rank=50, max_iter=20)
    return _CF[key]


_CF: dict = {}


@register("train_cf")
def q_train_cf(spark, sf):
    """ALS with 50 factors and 20 iterations; per user the number of factors and of
    ratings, and the mean absolute error of the model on them."""
    m = _cf_model(spark, sf)
    factors = m.userFactors.select(F.col("id").alias("user_id"), F.size("features").alias("rank"))
    errors = m.transform(stored_interactions(spark, sf)).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("ratings"), F.avg(F.abs(F.col("prediction") - F.col("rating"))).alias("mae"))
    return finish(factors.join(errors, "user_id"))


@register("cf_top_items")
def q_cf_top(spark, sf):
    """H12 for the five most active users (a top-k request list from the data)."""
    it = stored_interactions(spark, sf)
    users = it.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "user_id").limit(5)
    return finish(S.cf_top_items(_cf_model(spark, sf), users, 10))


@register("cf_item_scores")
def q_cf_items(spark, sf):
    """H13; checked against the explicit users x items mean in tests."""
    return finish(S.cf_item_scores(_cf_model(spark, sf)))


# ---- clustering ------------------------------------------------------------------------
def _points(spark, sf):
    return deliveries(spark, sf).select("order_id", "restaurant_latitude", "restaurant_longitude")


PTS = ["restaurant_latitude", "restaurant_longitude"]


@register("kmeans_sweep")
def q_kmeans(spark, sf):
    return finish(S.kmeans_sweep(_points(spark, sf), PTS))


@register("hierarchical_sweep")
def q_bisecting(spark, sf):
    return finish(S.kmeans_sweep(_points(spark, sf), PTS, bisecting=True))


@register("dbscan_sweep")
def q_dbscan(spark, sf):
    return finish(S.dbscan_sweep(_points(spark, sf), "order_id", PTS))


@register("compare_clustering")
def q_compare_clustering(spark, sf):
    p = _points(spark, sf)
    return finish(S.compare_clustering(S.kmeans_sweep(p, PTS), S.kmeans_sweep(p, PTS, bisecting=True),
                                       S.dbscan_sweep(p, "order_id", PTS)))
