from pyspark.sql import functions as F

from ladle.operators import recommend as R
from ladle.operators import similarity as S
from ladle.operators import text_rules as K


def test_intents(spark):
    msgs = ["Find North Indian food near Koramangala", "How long does delivery from Meghana Foods take?",
            "What's the reliability score for Truffles?", "Find cheap restaurants under 300", "Hello!", "asdfghjkl"]
    df = spark.createDataFrame([(i, 0, m) for i, m in enumerate(msgs)], "conv_id long, turn long, message string")
    r = K.classify_intent(df).orderBy("conv_id").collect()
    assert [x["intent"] for x in r] == ["search", "eta", "reliability", "budget_search", "greeting", "unknown"]
    assert "north indian" in r[0]["query"] and r[0]["area"] == "koramangala"
    assert "meghana" in r[1]["restaurant"] and "truffles" in r[2]["restaurant"] and r[3]["budget"] == "300"


def test_answers_and_narration(spark, sf):
    from ladle.plans.common import stored_restaurants
    st = stored_restaurants(spark, sf)
    df = spark.createDataFrame([(0, 0, "namaste"), (1, 0, "something cheap under 400"), (2, 0, "asdfghjkl")],
                               "conv_id long, turn long, message string")
    a = {r["conv_id"]: r["response"] for r in K.answer_messages(df, st).collect()}
    assert a[0].startswith("👋 **Namaste!**")
    assert a[1].startswith("💰 **Restaurants under ₹400:**") or a[1].startswith("😅 No restaurants found under ₹400")
    assert a[2].startswith("🤔")
    n = K.narrate(st).select("narration").first()["narration"]
    assert n.endswith(".") and " · " in n


def test_batch_matches_single_requests(spark, sf):
    from ladle.plans.common import stored_restaurants
    from ladle.plans.q_recommend import CONTENT
    st = stored_restaurants(spark, sf)
    reqs = spark.createDataFrame([(1, "Chinese", 1500.0, None, "balanced", 5), (2, "Chinese", 1500.0, None, "balanced", 5),
                                  (3, "Cafe", None, "Koramangala", "quality", 3)],
                                 "request_id long, cuisine string, budget double, area string, priority string, top_n int")
    b = R.recommend_batch(reqs, st, CONTENT)
    for rid, cu, bu, ar, pr, n in [(1, "Chinese", 1500, None, "balanced", 5), (3, "Cafe", None, "Koramangala", "quality", 3)]:
        single = [(r["restaurant_id"], round(r["combined_score"], 9)) for r in
                  R.recommend_hybrid(st, CONTENT, cu, bu, ar, pr, n).collect()]
        got = [(r["restaurant_id"], round(r["combined_score"], 9)) for r in
               b.where(F.col("request_id") == rid).orderBy("rank").collect()]
        assert got == single
    assert b.where("request_id = 2").count() == b.where("request_id = 1").count()


def test_nearest_excludes_self_and_sorted(spark, sf):
    from ladle.plans.q_recommend import _queries
    from ladle.sources.fixtures import table
    e = table(spark, sf, "embeddings")
    r = S.nearest(e, _queries(spark, sf), "vec_id", "embedding", 5).collect()
    assert all(x["vec_id"] != x["query_id"] for x in r)
    by_q = {}
    for x in r:
        by_q.setdefault(x["query_id"], []).append((x["rank"], x["score"]))
    for v in by_q.values():
        s = [sc for _, sc in sorted(v)]
        assert s == sorted(s, reverse=True) and len(s) == 5


def test_cf_item_scores_equal_explicit_mean(spark, sf):
    import numpy as np
    from ladle.sources.fixtures import interactions
    m = S.train_cf(interactions(spark, sf), rank=5, max_iter=3)
    got = {r["restaurant_id"]: r["mean_predicted"] for r in S.cf_item_scores(m).collect()}
    U = np.array([r["features"] for r in m.userFactors.collect()])
    items = {r["id"]: np.array(r["features"]) for r in m.itemFactors.collect()}
    for i, v in list(items.items())[:20]:
        assert abs(got[i] - float((U @ v).mean())) < 1e-4


def test_cf_top_items_match_explicit_scores(spark, sf):
    import numpy as np
    from ladle.sources.fixtures import interactions
    m = S.train_cf(interactions(spark, sf), rank=5, max_iter=3)
    users = m.userFactors.select(F.col("id").alias("user_id")).orderBy("user_id").limit(3)
    got = S.cf_top_items(m, users, 4).collect()
    items = {r["id"]: np.array(r["features"]) for r in m.itemFactors.collect()}
    uf = {r["id"]: np.array(r["features"]) for r in m.userFactors.collect()}
    for u in {r["user_id"] for r in got}:
        exp = sorted(((-float(uf[u] @ v), i) for i, v in items.items()))[:4]
        mine = sorted([(r["rank"], r["restaurant_id"]) for r in got if r["user_id"] == u])
        assert [i for _, i in mine] == [i for _, i in exp]


def test_collaborative_model_fits_its_ratings(spark, sf):
    from ladle.plans.catalog import load_all
    from ladle.sources.fixtures import interactions
    rows = load_all()["train_cf"][0](spark, sf).collect()
    it = interactions(spark, sf)
    users = {r["user_id"]: r["n"] for r in it.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {r["user_id"]: r["ratings"] for r in rows} == users and {r["rank"] for r in rows} == {50}
    mean = it.agg(F.avg("rating").alias("m")).first()["m"]
    flat = it.agg(F.avg(F.abs(F.col("rating") - mean)).alias("e")).first()["e"]
    assert sum(r["mae"] * r["ratings"] for r in rows) / sum(users.values()) < 0.2 * flat


def test_narration_with_and_without_estimate(spark, sf):
    from ladle.plans.catalog import load_all
    rows = load_all()["narrate_eta"][0](spark, sf).collect()
    told = [r["narration"].endswith(" min delivery estimate.") for r in rows]
    assert any(told) and not all(told)
