import itertools
from fractions import Fraction

from pyspark.sql import functions as F

from ladle.operators import drift as DR


def brute(n1, n2, d):
    tot = out = 0
    for comb in itertools.combinations(range(n1 + n2), n1):
        s = set(comb)
        i = j = 0
        D = 0
        for k in range(n1 + n2):
            if k in s:
                i += 1
            else:
                j += 1
            D = max(D, abs(Fraction(i, n1) - Fraction(j, n2)))
        tot += 1
        out += D >= d
    return out / tot


def test_exact_p_value_against_permutations():
    for n1, n2 in [(3, 4), (5, 5), (4, 7), (6, 3)]:
        for d in [Fraction(1, 2), Fraction(2, 3), Fraction(3, 4), Fraction(1, 1)]:
            assert abs(brute(n1, n2, d) - DR.ks_p_value(n1, n2, float(d), "exact")) < 1e-9


def test_same_vs_shifted(spark):
    ref = spark.range(0, 400).select((F.col("id") % 97).cast("double").alias("x"))
    same = DR.ks_test(ref, ref, ["x"]).first()
    assert same["ks_statistic"] == 0.0 and not same["drifted"]
    shifted = DR.ks_test(ref, ref.select((F.col("x") + 30).alias("x")), ["x"]).first()
    assert shifted["drifted"]


def test_ks_statistic_matches_direct_ecdf(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, 300).round(2), rng.normal(0.3, 1, 120).round(2)
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    bat = spark.createDataFrame([(float(x),) for x in b], "x double")
    got = DR.ks_statistics(ref, bat, ["x"]).first()["ks_statistic"]
    pts = np.union1d(a, b)
    exp = max(abs((a <= p).mean() - (b <= p).mean()) for p in pts)
    assert abs(got - exp) < 1e-12


def test_stream_cooldown_equals_batch(spark, sf):
    from ladle.plans.q_drift import _history
    from ladle.sources.io import scratch_path
    from ladle.streaming import ops as L
    hist = _history(spark, sf).where("drifted").select("feature", "batch_id", "detected_at")
    batch = {(r["feature"], r["batch_id"]): r["alerted"] for r in DR.apply_cooldown(hist).collect()}
    src = scratch_path(spark, "cooldown-test")
    hist.write.parquet(src)
    out = L.run_to_table(L.stream_alert_cooldown(spark.readStream.schema(hist.schema).parquet(src)),
                         scratch_path(spark, "cooldown-out"))
    stream = {(r["feature"], r["batch_id"]): r["alerted"] for r in spark.read.parquet(out).collect()}
    assert stream == batch and len(batch) > 0


def test_retrain_cooldown_of_each_source(spark):
    from pyspark.sql import functions as F

    from ladle.operators import drift as DR
    rows = [(b, s, 10, 5, True, b * 2) for s in ("a", "b", None) for b in (0, 1, 2, 4)] + [(9, "a", 0, 0, True, 100), (10, "a", 10, 2, True, 100)]
    r = spark.createDataFrame(rows, "batch_id long, source string, total_features long, drifted_count long, has_drift boolean, h int")
    r = r.withColumn("detected_at", F.timestamp_seconds(F.col("h") * 3600))
    got = {(x.source, x.batch_id): x.retrain for x in DR.retrain_decision(r, source="source").collect()}
    assert len(got) == len(rows)
    for s in ("a", "b", None):
        # at 0 h, then not again before 6 h have passed
        assert [got[s, b] for b in (0, 1, 2, 4)] == [True, False, False, True]
    assert not got["a", 9] and not got["a", 10]
