"""F6 against all distances."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.operators import neighbours as NB


def brute(rows, k):
    out = {}
    for i, x, y, f, label in rows:
        others = sorted(((x - a) * (x - a) + (y - b) * (y - b), j, lab) for j, a, b, g, lab in rows if g != f)[:k]
        if others:
            out[i] = (label, sum(o[2] for o in others) / len(others), others[0][1])
    return out


@pytest.mark.parametrize("cell_rows,block_rows", [(5, 7), (40, 2000), (10_000, 2000)])
def test_equals_all_distances(spark, cell_rows, block_rows):
    r = np.random.default_rng(2)
    xy = np.concatenate([r.normal(0, 0.05, (150, 2)), r.uniform(-3, 3, (80, 2)), np.round(r.uniform(-1, 1, (60, 2)), 0)])
    rows = [(i, float(x), float(y), i % 3, float(i * i % 37)) for i, (x, y) in enumerate(xy)]
    rows += [(1000 + i, 0.5, 0.5, i % 3, float(i)) for i in range(120)]  # one place holds a third of the rows
    bad = [(5000, None, 1.0, 0, 1.0), (5001, 0.0, float("nan"), 1, 1.0), (5002, 0.0, 0.0, None, 1.0), (5003, 0.0, 0.0, 1, None), (None, 0.0, 0.0, 1, 1.0)]
    df = spark.createDataFrame(rows + bad, "id long, x double, y double, fold int, label double").repartition(4)
    got = {g.id: (g.actual, g.prediction, g.nearest) for g in NB.knn_regression(df, "id", "label", ["x", "y"], "fold", 10, cell_rows, block_rows).collect()}
    want = brute(rows, 10)
    assert got.keys() == want.keys()
    for i, (a, p, n) in want.items():
        assert got[i][0] == a and got[i][2] == n and abs(got[i][1] - p) < 1e-9, i


def test_few_rows_and_none(spark):
    schema = "id long, x double, fold int, label double"
    assert NB.knn_regression(spark.createDataFrame([], schema), "id", "label", ["x"], "fold").collect() == []
    one_fold = spark.createDataFrame([(1, 0.0, 0, 1.0), (2, 1.0, 0, 2.0)], schema)
    assert NB.knn_regression(one_fold, "id", "label", ["x"], "fold").collect() == []
    two = one_fold.unionByName(one_fold.select((F.col("id") + 10).alias("id"), "x", F.lit(1).alias("fold"), (F.col("label") * 10).alias("label")))
    got = {r.id: r.prediction for r in NB.knn_regression(two, "id", "label", ["x"], "fold").collect()}
    assert got == {1: 15.0, 2: 15.0, 11: 1.5, 12: 1.5}


def test_folds_that_are_regions(spark, monkeypatch):
    """A cell of one fold gives its queries no bound; they must not go to every cell for that, and rows at infinity are no rows."""
    r = np.random.default_rng(3)
    xy = r.uniform(-1, 1, (1200, 2))
    rows = [(i, float(x), float(y), int(x > 0) + 2 * int(y > 0), float(i % 11)) for i, (x, y) in enumerate(xy)]
    stored, keep = [], NB.materialize
    monkeypatch.setattr(NB, "materialize", lambda df: stored.append(keep(df)) or stored[-1])
    visits = []
    monkeypatch.setattr(NB, "discard", lambda *tables: visits.extend(t.count() for t in tables if t is not None and "_t" in t.columns))
    df = spark.createDataFrame([*rows, (5000, float("inf"), 0.0, 0, 1.0)], "id long, x double, y double, fold int, label double")
    got = {g.id: (g.actual, g.prediction, g.nearest) for g in NB.knn_regression(df, "id", "label", ["x", "y"], "fold", 10, 20).collect()}
    want = brute(rows, 10)
    assert got.keys() == want.keys()
    assert all(got[i][2] == n and abs(got[i][1] - p) < 1e-9 for i, (_, p, n) in want.items())
    assert sum(visits) < 15 * len(rows)
