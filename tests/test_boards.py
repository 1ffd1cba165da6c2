"""Boards and searches at scale: the same errors as plain refits, with few passes and no models kept."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from ladle.operators import models as M
from ladle.operators import similarity as S


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        a, b, kind = rng.gauss(50, 9), rng.random(), rng.choice(["x", "y", "z"])
        rows.append((i, a, b, 0.0, kind, 2 * a - 5 * b + (kind == "x") * 4 + rng.gauss(0, 2)))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, kind string, y double").repartition(3).cache()


def test_linear_fits_on_moments_equal_fits_on_all_rows(spark, frame):
    data = frame.withColumn("label", F.col("y"))
    prep = Pipeline(stages=M.build_preprocessor(["a", "b", "c"], ["kind"])).fit(data)
    ready = prep.transform(data).select("features", "label")
    few = M._moment_rows(ready, len(ready.first()["features"]))
    assert few.count() <= 2 * 8 and abs(few.agg(F.sum("weight")).first()[0] - 400) < 1e-6
    for name in ("Ridge", "Lasso"):
        est = M.estimators("eta", 400, 20.0)[name]
        for reg in (1e-4, 0.05, 1.0):
            one, other = est.fit(ready, {est.regParam: reg}), est.fit(few, {est.regParam: reg, est.weightCol: "weight"})
            assert max(abs(one.coefficients.toArray() - other.coefficients.toArray())) < 1e-4
            assert abs(one.intercept - other.intercept) < 1e-4


def test_linear_search_equals_refits(spark, frame):
    got = M.tune(frame, "y", ["a", "b", "c"], ["kind"], "Ridge", n_trials=2, k=3).first()
    data = frame.withColumns({"label": F.col("y"), "_row": F.xxhash64(*frame.columns)})
    data = M.with_folds(data, "_row", 3)
    est, best = M.estimators("eta", *M.label_scale(data, "label"))["Ridge"], None
    for draw in M.sample_params(M.SPACES["Ridge"], 2):
        total, n = 0.0, 0
        for f in range(3):
            pipe = Pipeline(stages=M.build_preprocessor(["a", "b", "c"], ["kind"]) + [est.copy({est.regParam: draw["regParam"]})])
            r = pipe.fit(data.where(F.col("fold") != f)).transform(data.where(F.col("fold") == f)).agg(
                F.sum(F.abs(F.col("prediction") - F.col("label"))).alias("a"), F.count("label").alias("n")).first()
            total, n = total + r["a"], n + r["n"]
        best = min(total / n, best or total / n)
    assert abs(got["mae"] - best) < 1e-6


def test_board_shares_features_and_keeps_no_model(spark, frame):
    ests = {n: e for n, e in M.estimators("eta", 400, 20.0).items() if n in ("Ridge", "DecisionTree")}
    got = M.oof_board(frame, "id", "y", ["a", "b", "c"], ["kind"], ests, k=2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" not in plan  # stored predictions: nothing refers to a model
    for name, est in ests.items():
        want = M.oof_predictions(frame, "id", "y", ["a", "b", "c"], ["kind"], name, est, k=2)
        a, b = ({r["id"]: (r["actual"], r["prediction"]) for r in x.collect()} for x in (got.where(F.col("model") == name), want))
        assert a.keys() == b.keys() and all(abs(a[i][j] - b[i][j]) < 1e-9 for i in a for j in (0, 1))


def test_factors_are_checkpointed_in_every_iteration(spark, monkeypatch):
    seen = []
    fit = ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, *a, **kw: seen.append(self.getCheckpointInterval()) or fit(self, *a, **kw))
    model = S.train_cf(spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(6) for i in range(4)],
                                             "user_id long, restaurant_id long, rating double"), rank=2, max_iter=2)
    assert seen == [1] and model.userFactors.count() == 6


def test_blocks_follow_the_ratings(spark, monkeypatch):
    assert S._blocks(1_000_000, 10**9, 50) == S.BLOCKS  # as MLlib's default
    for ratings, others in ((216_000_000, 7_200_000), (10**10, 10**8), (10**10, 100)):
        n = S._blocks(ratings, others, 50)
        assert min(others, ratings / n) * 224 <= S.BLOCK_BYTES and ratings / n * S.RATING_BYTES <= S.BLOCK_BYTES
    seen = []
    fit = ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, *a, **kw: seen.append((self.getNumUserBlocks(), self.getNumItemBlocks())) or fit(self, *a, **kw))
    monkeypatch.setattr(S, "BLOCK_BYTES", 24)
    monkeypatch.setattr(S, "DEALT_ROWS", 10)
    model = S.train_cf(spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(6) for i in range(4)],
                                             "user_id long, restaurant_id long, rating double"), rank=2, max_iter=2)
    assert seen == [(32, 32)] and model.userFactors.count() == 6 and model.itemFactors.count() == 4
