"""Checks that fail on wrong keys, limits, joins and fits that the SQL oracles can't see."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.operators import business as B
from ladle.operators import drift as DR
from ladle.operators import lookups as L
from ladle.operators import models as M
from ladle.operators import similarity as S
from ladle.operators import text_rules as T
from ladle.operators.sentiment import parse_reviews
from ladle.plans.scale import global_rank


# ---- drift -------------------------------------------------------------------------
def test_kolmogorov_limit_on_both_sides():
    assert DR.ks_p_value(10**6, 10**6, 1e-6) == 1.0
    assert DR.ks_p_value(10_001, 10_001, 1e-4) > 0.999999
    for lam in np.linspace(0.3, 2.5, 45):
        direct = 1 - sum((-1) ** k * math.exp(-2 * k * k * lam * lam) for k in range(-400, 401))
        assert abs(DR.kolmogorov_sf(lam) - direct) < 1e-12
    assert abs(DR.kolmogorov_sf(1.18 - 1e-12) - DR.kolmogorov_sf(1.18)) < 1e-10


def test_methods_agree_for_large_samples():
    for d in (0.02, 0.05, 0.1):
        assert abs(DR.ks_p_value(1500, 1500, d, "exact") - DR.ks_p_value(1500, 1500, d)) < 0.01


def test_equal_samples_do_not_drift(spark):
    ref = spark.range(20_000).select((F.col("id") % 1009).cast("double").alias("x"))
    assert not DR.ks_test(ref, ref.where("x <> 3"), ["x"]).first()["drifted"]


# ---- null keys -----------------------------------------------------------------------
def nulls(spark):
    rows = [("a", i, float(i)) for i in range(8)] + [(None, 10 + i, float(i * i)) for i in range(6)]
    return spark.createDataFrame(rows, "g string, id long, v double")


def test_null_groups_stay(spark):
    df = nulls(spark)
    d = {r["g"]: r for r in L.describe(df, "v", "g").collect()}
    assert d[None]["count"] == 6 and d[None]["p50"] == 6.5 and d["a"]["p50"] == 3.5
    b = {r["g"]: r for r in L.box_stats(df, "g", "v").collect()}
    assert b[None]["median"] == 6.5 and b[None]["whisker_high"] == 25.0
    assert global_rank(df, ["g"], "v", "id").count() == 14
    late = df.withColumns({"actual_late": F.col("v") > 3, "ts": F.timestamp_seconds("id")})
    r = B.running_on_time_rate(late, ["g"], "ts", "id").where("g IS NULL").orderBy("id").collect()
    assert [round(x["on_time_rate"], 3) for x in r] == [100.0, 100.0, 66.667, 50.0, 40.0, 33.333]
    m = M.regression_metrics(df.withColumn("p", F.col("v") + 1), "v", "p", keys=["g"]).collect()
    assert {x["g"]: (x["n"], x["mae"]) for x in m} == {"a": (8, 1.0), None: (6, 1.0)}


def test_a_group_of_null_values_only(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "g string, v double")
    assert {r["g"]: (r["count"], r["p50"]) for r in L.describe(df, "v", "g").collect()} == {"a": (1, 1.0), "b": (0, None)}


# ---- dispatch ------------------------------------------------------------------------
def test_compare_assignment_compares_the_same_orders(spark):
    sep = spark.createDataFrame([("z", 1, 10.0)], "zone string, order_id long, cost double")
    naive = spark.createDataFrame([("z", 1, 10.0), ("z", 2, 30.0), (None, 3, 5.0)], "zone string, order_id long, cost double")
    out = {r["zone"]: r for r in B.compare_assignment(sep, naive, ["zone"]).collect()}
    assert out["z"]["improvement_pct"] == 0.0 and out["z"]["improvement_all_orders_pct"] == 75.0
    assert out["z"]["naive_same_orders_min"] == 10.0 and out[None]["optimized_total_min"] == 0.0


def test_compare_assignment_against_brute_force(spark):
    import itertools

    r = random.Random(3)
    orders = [(g, i + 100 * g, float(r.randrange(10, 60))) for g in range(3) for i in range(r.choice([2, 3, 5]))]
    partners = [(0, j, r.choice([0.8, 0.9, 1.0, 1.3])) for j in range(3)]
    od = spark.createDataFrame([(g, 0, i, t) for g, i, t in orders], "grp long, zone long, order_id long, predicted_min double").withColumn(
        "ts", F.timestamp_seconds("order_id"))
    pa = spark.createDataFrame(partners, "zone long, partner_id long, factor double")
    sep = B.assign_separable(od, pa, ["grp", "zone"], "zone")
    out = {x["grp"]: x for x in B.compare_assignment(sep, B.assign_least_loaded(od, pa, ["grp", "zone"], "zone"), ["grp", "zone"]).collect()}
    for g in range(3):
        times = [t for h, _, t in orders if h == g]
        m = min(len(times), 3)
        best = min(sum(t * f for t, f in zip(ts, fs)) for ts in itertools.permutations(times, m) for fs in itertools.combinations([p[2] for p in partners], m))
        assert abs(out[g]["optimized_total_min"] - round(best, 1)) < 0.051


# ---- text ----------------------------------------------------------------------------
def restaurants(spark):
    return spark.createDataFrame(
        [(1, "Cafe (Vegan) One", 4.0, 300.0, "Koramangala", "Cafe (vegan), Bakery", 0.5, 12.9, 77.6), (2, "Two", 3.5, 200.0, "Indiranagar", "North Indian", None, None, None)],
        "restaurant_id long, name string, rate double, cost_for_two double, location string, cuisines string, reliability_score double, latitude double, longitude double")


def test_user_text_is_no_pattern(spark):
    msgs = spark.createDataFrame([(1, 1, "find cafe (vegan in Koramangala"), (2, 1, "find .* in Koramangala"), (3, 1, "find north indian near [indira")],
                                 "conv_id long, turn long, message string")
    out = {r["conv_id"]: r["response"] for r in T.answer_messages(msgs, restaurants(spark)).collect()}
    assert "Cafe (Vegan) One" in out[1] and "couldn't find" in out[2] and "couldn't find" in out[3]


REVIEWS = {
    "[('Rated 4.0', 'RATED\\n Good food'), ('Rated 2.0', \"it's cold\")]": ["RATED\n Good food", "it's cold"],
    "['plain one', 'two']": ["plain one", "two"],
    "[('only',)]": ["only',"],  # no review in the list: the text between its edges
    "junk \"a quoted review text\" and 'short'": ["a quoted review text"],
    "first long part here\nx\nsecond long part": ["first long part here", "second long part"],
    "one part of text; another part of it": ["one part of text; another part of it"],  # the first delimiter that gives any part
    "a; b; c\nd": ["a; b; c\nd"], "shrt\nx; a longer part": ["x; a longer part"],
    "tiny": [], "": [], "[]": [], "  sixsix ": ["sixsix"],
}


def test_parse_reviews(spark):
    df = spark.createDataFrame([(k,) for k in REVIEWS] + [(None,)], "raw string").select("raw", parse_reviews("raw").alias("r"))
    assert {x["raw"]: x["r"] for x in df.collect()} == {**REVIEWS, None: []}


# ---- models ---------------------------------------------------------------------------
@pytest.fixture(scope="module")
def fit_data(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(200, 2))
    y = 3 + 2 * x[:, 0] - x[:, 1] + r.normal(scale=0.1, size=200)
    return x, y, spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                                       "id long, a double, b double, y double").cache()


def test_linear_and_ridge_closed_form(spark, fit_data):
    x, y, df = fit_data
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    for name, alpha in (("LinearRegression", 0.0), ("Ridge", 1.0)):
        m = M.fit_best(name, df, "y", ["a", "b"], [])
        got = np.array(m.stages[-1].coefficients)
        want = np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (y - y.mean()))
        assert np.allclose(got, want, atol=1e-6), name


def test_out_of_fold_predictions(spark, fit_data):
    x, y, df = fit_data
    oof = M.oof_predictions(df, "id", "y", ["a", "b"], [], "LinearRegression", M.estimators("eta", 200)["LinearRegression"])
    got = {r["id"]: r["prediction"] for r in oof.collect()}
    fold = {r["id"]: r["fold"] for r in M.with_folds(df, "id").collect()}
    assert len(got) == 200 and len(set(fold.values())) == 5
    f = np.array([fold[i] for i in range(200)])
    for k in range(5):
        a = np.column_stack([np.ones((f != k).sum()), x[f != k]])
        beta = np.linalg.lstsq(a, y[f != k], rcond=None)[0]
        for i in np.flatnonzero(f == k):
            assert abs(got[i] - (beta[0] + x[i] @ beta[1:])) < 1e-6
    m = M.leaderboard(oof).first()
    p = np.array([got[i] for i in range(200)])
    assert abs(m["mae"] - np.abs(p - y).mean()) < 1e-4 and abs(m["rmse"] - math.sqrt(((p - y) ** 2).mean())) < 1e-4


def test_estimator_settings():
    e = M.estimators("eta", 100)
    assert e["GradientBoosting"].getMaxDepth() == 3 and e["RandomForest"].getMaxDepth() == M.FOREST_DEPTH and e["DecisionTree"].getMaxDepth() == 12
    assert e["RandomForest"].getNumTrees() == 100 and e["GradientBoosting"].getMaxIter() == 100


def test_tune_reports_held_out_errors(spark):
    r = np.random.default_rng(5)
    noise = spark.createDataFrame([(i, float(r.normal()), float(r.normal())) for i in range(150)], "id long, a double, y double")
    t = M.tune(noise, "y", ["a"], [], "DecisionTree", n_trials=3).first()
    assert t["rmse"] > 0.95  # a tree fitted on these rows has a far smaller error on them


def test_permutation_importance(spark, fit_data):
    _, _, df = fit_data
    m = M.fit_best("LinearRegression", df, "y", ["a", "b"], [])
    one = {r["feature"]: r["importance"] for r in M.permutation_importance(m, df, "y", ["a", "b"], "id").collect()}
    two = {r["feature"]: r["importance"] for r in M.permutation_importance(m, df.repartition(7), "y", ["a", "b"], "id").collect()}
    assert one == two and one["a"] > one["b"] > 0.3


def test_missing_model_is_none_and_damaged_is_an_error(spark, tmp_path):
    assert M.load_model(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    with pytest.raises(Exception):
        M.load_model(spark, str(tmp_path / "bad"))


# ---- clustering -------------------------------------------------------------------------
def test_dbscan_against_brute_force(spark):
    r = np.random.default_rng(2)
    pts = np.round(np.vstack([r.normal(0, .3, (40, 2)), r.normal(3, .3, (30, 2)), r.uniform(-3, 6, (25, 2))]), 2)
    eps, least = 0.35, 5
    near = ((pts[:, None] - pts[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    comp = {}
    for s in np.flatnonzero(core):
        if s not in comp:
            todo, c = [s], len(set(comp.values()))
            while todo:
                x = todo.pop()
                if x not in comp:
                    comp[x] = c
                    todo += [y for y in np.flatnonzero(near[x] & core) if y not in comp]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id long, x double, y double")
    got = {q["id"]: q["cluster"] for q in S.dbscan_labels(df, "id", ["x", "y"], eps, least).collect()}
    pairs = {(comp[i], got[i]) for i in comp}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    for i in range(len(pts)):
        if not core[i]:
            assert got[i] == -1 if not (near[i] & core).any() else got[i] in {got[j] for j in np.flatnonzero(near[i] & core)}


# ---- storage -----------------------------------------------------------------------------
class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, conf=None, folder=None):
        self.sparkContext, self.values = FakeContext(master, folder), {"spark.checkpoint.dir": conf} if conf else {}
        self.conf = self

    def get(self, k, default=None):
        return self.values.get(k, default)

    def set(self, k, v):
        self.values[k] = v


def test_checkpoint_folder_rule():
    from ladle.session import ensure_checkpoint_dir

    assert ensure_checkpoint_dir(FakeSession("spark://x:1", "s3://shared/a")) == "s3://shared/a"
    assert ensure_checkpoint_dir(FakeSession("spark://x:1", folder="hdfs://b")) == "hdfs://b"
    assert ensure_checkpoint_dir(FakeSession("yarn", "hdfs://conf", "hdfs://b")) == "hdfs://conf"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(FakeSession("yarn"))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(FakeSession("local-cluster[2,1,1024]"))
    assert ensure_checkpoint_dir(FakeSession("local[2]"))
