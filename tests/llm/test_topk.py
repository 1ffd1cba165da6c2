import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.llm import topk

SCHEMA = "vec_id long, embedding array<float>, _id string, score int"


def brute(rows, k):
    ok = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 50 == 0:
            s = sorted((-int(a @ b), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, r, i, -m) for r, (m, i) in enumerate(s, 1)]
    return sorted(out)


def run(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, "a", 7) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.exact_topk(df, F.col("vec_id") % 50 == 0, k).collect())


def test_random_vectors_and_ties(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(230, 8))
    v[100:160] = v[100]  # ties go to the smaller id
    rows = [(i, (x / np.linalg.norm(x)).tolist()) for i, x in enumerate(v)]
    assert run(spark, rows) == brute(rows, 5)


def test_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 2)
    rng = np.random.default_rng(4)
    rows = [(i, rng.uniform(-1, 1, 6).tolist()) for i in range(300)]
    assert run(spark, rows) == brute(rows, 5)


def test_odd_rows(spark):
    rows = [(0, [0.5, 0.25]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 0.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]),
            (50, [0.1, 0.2]), (7, []), (8, [1.0, 0.0])]
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


@pytest.mark.parametrize("k", [1, 3])
def test_bounds_hold(k):
    rng = np.random.default_rng(k)
    v = rng.integers(-50, 50, (64, 5)).astype(float)
    q = rng.integers(-50, 50, (9, 5)).astype(float)
    lists = topk.SortedLists(np.arange(64), v)
    exact = q @ v.T
    for depth in (1, 20, 60):
        low, high = lists.bounds(np.arange(64), np.maximum(q, 0), np.minimum(q, 0), depth)
        assert (low <= exact).all() and (exact <= high).all()
