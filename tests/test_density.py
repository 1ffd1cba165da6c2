"""H18 with dense cells: against brute force, and a cell of very many points."""
import random

import pytest
from pyspark.sql import functions as F

from ladle.operators import density


def brute(points, eps, least):
    """Core points' components, and the clusters that border points may have."""
    near = {i: [j for j, (a, b) in points.items() if (a - x) * (a - x) + (b - y) * (b - y) <= eps * eps] for i, (x, y) in points.items()}
    core = {i for i, n in near.items() if len(n) >= least}
    comp = {}
    for i in core:
        if i not in comp:
            todo, comp[i] = [i], i
            while todo:
                for j in near[todo.pop()]:
                    if j in core and j not in comp:
                        comp[j] = i
                        todo.append(j)
    return core, comp, {i: {comp[j] for j in near[i] if j in core} for i in points if i not in core}


@pytest.mark.parametrize("eps,least,block_rows", [(0.05, 5, 2000), (0.05, 4, 3), (0.2, 8, 10), (0.01, 2, 2000)])
def test_equals_brute_force(spark, eps, least, block_rows):
    r = random.Random(11)
    points = {i: (r.random(), r.random()) for i in range(250)}
    points |= {1000 + i: (0.3 + r.gauss(0, 0.01), 0.3 + r.gauss(0, 0.01)) for i in range(200)}
    points |= {2000 + i: (round(r.random(), 1), round(r.random(), 1)) for i in range(120)}  # equal places
    points |= {3000 + i: (-2 - 0.04 * i, 0.5) for i in range(30)}  # a chain
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in points.items()] + [(-1, None, 1.0), (-2, 1.0, None)], "id long, x double, y double").repartition(4)
    got = {q["id"]: q["cluster"] for q in density.dbscan_labels(df, "id", ["x", "y"], eps, least, block_rows).collect()}
    core, comp, border = brute(points, eps, least)
    assert got.keys() == points.keys()
    to = {}
    for i in core:
        assert got[i] >= 0 and to.setdefault(comp[i], got[i]) == got[i]
    assert sorted(to.values()) == list(range(len(to)))
    for i, may in border.items():
        assert got[i] == min((to[c] for c in may), default=-1)


def test_cell_of_many_points(spark):
    """All pairs of this cell would be 10**10 rows."""
    n = 100_000
    dense = spark.range(n).select("id", (F.lit(5.0) + F.rand(1) * 0.001).alias("x"), (F.lit(5.0) + F.rand(2) * 0.001).alias("y"))
    far = spark.createDataFrame([(n + 1, 5.009, 5.0), (n + 2, 9.0, 9.0)], "id long, x double, y double")
    got = density.dbscan_labels(dense.unionByName(far), "id", ["x", "y"], 0.01, 5)
    assert sorted(map(tuple, got.groupBy("cluster").count().collect())) == [(-1, 1), (0, n + 1)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id long, x double, y double")
    assert density.dbscan_labels(empty, "id", ["x", "y"], 0.1).collect() == []
