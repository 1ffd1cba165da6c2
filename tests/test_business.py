import pandas as pd
from pyspark.sql import functions as F

from ladle.operators import business as B


def test_reliability_single_row(spark):
    df = spark.createDataFrame([(4.0, 0.5, 0.2)], "rate double, avg_sentiment double, delay_risk double")
    assert B.reliability_score(df, weights=(1.0, 0.0, 0.0)).first()["reliability_score"] == 0.5


def test_reliability_null_guard(spark):
    df = spark.createDataFrame([(4.0, None, 0.2), (3.0, 0.1, 0.3)], "rate double, avg_sentiment double, delay_risk double")
    assert B.reliability_score(df).orderBy("rate").collect()[1]["reliability_score"] is None


def test_sla_cases(spark):
    s = "actual_min double, predicted_min double"
    perfect = B.sla_analysis(spark.createDataFrame([(10.0, 10.0), (50.0, 50.0)], s)).first()
    assert perfect["precision"] == 1.0 and perfect["recall"] == 1.0
    late = B.sla_analysis(spark.createDataFrame([(50.0, 10.0), (60.0, 60.0)], s)).first()
    assert late["actual_on_time_rate"] == 0.0
    empty = B.sla_analysis(spark.createDataFrame([], s), threshold=30.0).first()
    assert empty["total_orders"] == 0 and empty["precision"] == 0.0 and empty["recall"] == 0.0


def test_separable_one_order(spark):
    orders = spark.createDataFrame([(1, 0, "w", 1.0)], "order_id long, zone long, dispatch_window string, predicted_min double")
    partners = spark.createDataFrame([(1, 0, 10.0), (2, 0, 5.0), (3, 0, 8.0)], "partner_id long, zone long, factor double")
    r = B.assign_separable(orders, partners, ["zone", "dispatch_window"], "zone").collect()
    assert len(r) == 1 and r[0]["partner_id"] == 2 and r[0]["cost"] == 5.0


def brute_least_loaded(orders: pd.DataFrame, partners: pd.DataFrame):
    out = {}
    for (zone, win), g in orders.groupby(["zone", "dispatch_window"]):
        ps = partners[partners.zone == zone].sort_values("partner_id")
        loads = [0.0] * len(ps)
        for _, o in g.sort_values(["ts", "order_id"]).iterrows():
            j = min(range(len(loads)), key=lambda i: (loads[i], i))
            c = o.predicted_min * ps.factor.iloc[j]
            loads[j] += c
            out[o.order_id] = (int(ps.partner_id.iloc[j]), round(c, 6))
    return out


def test_least_loaded_matches_loop(spark, sf):
    from ladle.plans.q_business import dispatch_orders, dispatch_partners
    o, p = dispatch_orders(spark, sf), dispatch_partners(spark, sf)
    got = {r["order_id"]: (r["partner_id"], round(r["cost"], 6))
           for r in B.assign_least_loaded(o, p, ["zone", "dispatch_window"], "zone").collect()}
    exp = brute_least_loaded(o.toPandas(), p.toPandas())
    assert got == exp


def test_separable_is_optimal_against_brute_force(spark):
    import itertools
    orders = spark.createDataFrame([(i, 0, "w", t) for i, t in enumerate([30.0, 12.0, 45.0, 20.0])],
                                   "order_id long, zone long, dispatch_window string, predicted_min double")
    fac = [1.1, 0.8, 1.0]
    partners = spark.createDataFrame([(j, 0, f) for j, f in enumerate(fac)], "partner_id long, zone long, factor double")
    total = sum(r["cost"] for r in B.assign_separable(orders, partners, ["zone", "dispatch_window"], "zone").collect())
    times = [30.0, 12.0, 45.0, 20.0]
    best = min(sum(times[o] * fac[p] for o, p in zip(os_, range(3))) for os_ in itertools.permutations(range(4), 3))
    assert abs(total - best) < 1e-9


def test_profile_overlap_counts_all_pairs(spark):
    top = spark.createDataFrame([("a", 0, "x"), ("b", 1, "x"), ("c", 2, "y")], "profile string, profile_ord int, name string")
    r = {(x["profile_a"], x["profile_b"]): x["overlap"] for x in B.profile_overlap(top).collect()}
    assert r == {("a", "b"): 1, ("a", "c"): 0, ("b", "c"): 0}


def test_least_loaded_overloaded_groups(spark, sf):
    """Two partners per zone: most groups have more orders than partners, so
    the sequential (applyInPandas) path is exercised as well."""
    from ladle.plans.q_business import dispatch_orders, dispatch_partners
    o, p = dispatch_orders(spark, sf), dispatch_partners(spark, sf).where(F.col("partner_id") < 20)
    got = {r["order_id"]: (r["partner_id"], round(r["cost"], 6))
           for r in B.assign_least_loaded(o, p, ["zone", "dispatch_window"], "zone").collect()}
    exp = brute_least_loaded(o.toPandas(), p.toPandas())
    assert got == exp
    sizes = o.groupBy("zone", "dispatch_window").count().toPandas()
    assert (sizes["count"] > 2).any()
