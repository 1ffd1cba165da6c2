"""The matches of batch recommendations hold scores and no texts; each request gets what it gets alone."""

from ladle.operators import recommend as R


def test_matches_hold_no_texts(spark, monkeypatch):
    stored = []
    keep = R.materialize
    monkeypatch.setattr(R, "materialize", lambda df: stored.append(df.columns) or keep(df))
    rows = [(i, f"r{i}", "Chinese" if i % 2 else "Cafe, Chinese", "MG Road", 300.0 + i, 4.0, 0.1 * i, 3.0 + i / 10) for i in range(9)]
    st = spark.createDataFrame(rows, "restaurant_id long, name string, cuisines string, location string, cost_for_two double, rate double, "
                                     "reliability_score double, bayesian_rating double")
    reqs = spark.createDataFrame([(1, "chinese", None, "mg", "speed", 2), (2, "cafe", 304.0, None, "balanced", None), (3, "chinese", None, "mg", "speed", 2),
                                  (4, "sushi", None, None, "x", 3)], "request_id long, cuisine string, budget double, area string, priority string, top_n int")
    got = R.recommend_batch(reqs, st, ["cost_for_two"]).collect()
    assert all(not ({"_request", "request_key"} & set(c) and {"name", "cuisines"} & set(c)) for c in stored)
    one = {q: sorted((r["rank"], r["restaurant_id"], round(r["combined_score"], 9)) for r in got if r["request_id"] == q) for q in (1, 2, 3, 4)}
    h8 = lambda **kw: [(k + 1, r["restaurant_id"], round(r["combined_score"], 9)) for k, r in enumerate(R.recommend_hybrid(st, ["cost_for_two"], **kw).collect())]
    assert one[1] == one[3] == h8(cuisine="chinese", area="mg", priority="speed", n=2)
    assert one[2] == h8(cuisine="cafe", budget=304.0, priority="balanced", n=5)
    assert one[4] == [] and {r["name"] for r in got} <= {f"r{i}" for i in range(9)} and all(r["explanation"] for r in got)
