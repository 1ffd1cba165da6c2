import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ladle.plans import scale
from ladle.plans.scale import exact_quantiles, global_rank, running_total, top_k_per_group


def skewed(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 20, n))  # one key holds a third of the rows
    val = np.round(rng.normal(50, 10, n), 1)
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "v": val})
    return spark.createDataFrame(pdf), pdf


def test_exact_quantiles_match_numpy(spark):
    df, pdf = skewed(spark)
    got = {r["k"]: (r["q0"], r["q1"], r["n"]) for r in exact_quantiles(df, ["k"], "v", [0.25, 0.5], buckets=16).collect()}
    for k, g in pdf.groupby("k"):
        q = np.percentile(g["v"], [25, 50])
        assert abs(got[k][0] - q[0]) < 1e-9 and abs(got[k][1] - q[1]) < 1e-9 and got[k][2] == len(g)
    one = exact_quantiles(df, [], "v", [0.5], buckets=16).first()
    assert abs(one["q0"] - np.median(pdf["v"])) < 1e-9


def test_running_total_and_rank(spark):
    df, pdf = skewed(spark)
    r = running_total(df.withColumn("one", F.lit(1)), ["k"], "v", ["one"], tiebreak=["id"], buckets=8).toPandas()
    exp = pdf.sort_values(["k", "v", "id"]).assign(c=1).groupby("k")["c"].cumsum()
    merged = r.set_index("id")["one_cum"].sort_index()
    assert (merged.loc[exp.index].values == exp.values).all()
    g = global_rank(df, ["k"], "v", "id").toPandas().set_index("id")["rank"]
    exp2 = pdf.sort_values(["k", "v", "id"], ascending=[True, False, True]).groupby("k").cumcount() + 1
    assert (g.loc[exp2.index].values == exp2.values).all()


def test_top_k_per_group(spark):
    df, pdf = skewed(spark)
    got = top_k_per_group(df, ["k"], [F.desc("v"), F.asc("id")], 3, salt_buckets=4).toPandas()
    exp = pdf.sort_values(["k", "v", "id"], ascending=[True, False, True]).groupby("k").head(3)
    assert sorted(got["id"]) == sorted(exp["id"])


def test_count_below_binary_search(spark):
    from ladle.plans.scale import count_below
    bounds = [1.0, 2.0, 2.0, 5.0, 9.0]
    df = spark.createDataFrame([(v,) for v in [0.5, 1.0, 1.5, 2.0, 3.0, 5.0, 9.0, 10.0]], "v double")
    got = [r["c"] for r in df.select(count_below(F.array(*[F.lit(b) for b in bounds]), F.col("v"), len(bounds)).alias("c")).collect()]
    assert got == [sum(b < v for b in bounds) for v in [0.5, 1.0, 1.5, 2.0, 3.0, 5.0, 9.0, 10.0]]


def test_many_buckets(spark):
    df, pdf = skewed(spark)
    one = exact_quantiles(df, ["k"], "v", [0.5], buckets=1024).where("k = 0").first()
    assert abs(one["q0"] - np.median(pdf[pdf.k == 0]["v"])) < 1e-9


def test_ties_are_split_over_buckets(spark):
    """One value for all rows of a key, for most rows of another, and for the null key; ranks stay exact."""
    from ladle.plans.scale import _bucketed
    rng = np.random.default_rng(5)
    n = 4000
    pdf = pd.DataFrame({"id": rng.permutation(n) * 7 - 3000, "k": rng.choice(["a", "b", "c"], n)})
    pdf["v"] = np.where(pdf.k == "a", 1.0, np.where((pdf.k == "b") & (rng.random(n) < 0.7), 5.0, rng.normal(0, 9, n).round(1)))
    df = spark.createDataFrame(pdf).withColumn("k", F.when(F.col("k") != "c", F.col("k")))
    for keys in (["k"], []):
        g = global_rank(df, keys, "v", "id", descending=False).toPandas().set_index("id")["rank"]
        order = pdf.sort_values(["v", "id"])
        exp = (order.groupby("k").cumcount() if keys else pd.Series(range(n), index=order.index)) + 1
        assert all(g.loc[pdf.id[i]] == r for i, r in exp.items())
    most = _bucketed(df, ["k"], "v", ["id"], 16).where("k = 'a'").groupBy("_bk").count().agg(F.max("count"), F.count("*")).first()
    assert most[1] == 15 and most[0] <= 2.1 * (pdf.k == "a").sum() / 16  # as many as a key has bounds
    one = _bucketed(df.withColumn("w", F.lit(0.5)), [], "w", ["id"], 16).groupBy("_bk").count().agg(F.max("count"), F.count("*")).first()
    assert one[1] == 15 and one[0] <= 2 * n / 16


def test_null_and_text_tiebreaks(spark):
    df = spark.createDataFrame([(None, 1.0, "x"), (3, 1.0, "y"), (1, 1.0, "z"), (2, 0.0, "w")], "id long, v double, s string")
    by_id = running_total(df.withColumn("one", F.lit(1)), [], "v", ["one"], tiebreak=["id"], buckets=4)
    assert {r["id"]: r["one_cum"] for r in by_id.collect()} == {2: 1, None: 2, 1: 3, 3: 4}
    by_text = running_total(df.withColumn("one", F.lit(1)), [], "v", ["one"], tiebreak=["s"], buckets=4)
    assert {r["s"]: r["one_cum"] for r in by_text.collect()} == {"w": 1, "x": 2, "y": 3, "z": 4}


def test_interactions_are_grouped_in_pieces_that_follow_the_rows(spark, tmp_path, monkeypatch):
    from ladle.sources.fixtures import interactions
    lines = [(i % 30 or None, i % 7 or None, float(i % 9)) for i in range(120)] + [(1, 1, 3.0)] * 60  # one pair holds a third
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    users = {i: i % 4 or None for i in range(1, 30)}
    spark.createDataFrame([*users.items()], "o_orderkey long, o_custkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    want = {}
    for o, p, q in lines:
        if o is not None:
            want.setdefault((users[o], p), []).append(1 + q % 5)
    monkeypatch.setattr(scale, "PIECE_ROWS", 10, raising=False)
    got = interactions(spark, str(tmp_path))
    assert {(r.user_id, r.restaurant_id): r.rating for r in got.collect()} == {k: sum(v) / len(v) for k, v in want.items()}
    assert got.rdd.getNumPartitions() == 18
