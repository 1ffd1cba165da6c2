"""contributions of tree models against a recursive SQL walk and their sum."""
import random

import duckdb
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor

from ladle.operators import attribution as AT
from ladle.operators.models import build_preprocessor

KINDS = {"tree": lambda: DecisionTreeRegressor(maxDepth=5, seed=1), "forest": lambda: RandomForestRegressor(numTrees=5, maxDepth=4, seed=1),
         "booster": lambda: GBTRegressor(maxIter=4, maxDepth=3, seed=1)}


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(7)
    data = [(i, r.random() * 10, float(r.randrange(5)), r.choice(["a", "b", "c"])) for i in range(400)]
    data = [(i, x, y, c, 3 * x + (5 if c == "b" else 0) * y + r.random()) for i, x, y, c in data]
    return spark.createDataFrame(data, "id long, x double, y double, c string, label double")


@pytest.mark.parametrize("kind", KINDS)
def test_contributions(spark, rows, kind):
    model = Pipeline(stages=[*build_preprocessor(["x", "y"], ["c"]), KINDS[kind]()]).fit(rows)
    nodes = AT.node_table(model.stages[-1], spark)
    got = AT.tree_contributions(model, rows, "id").toPandas()
    scored = {r.id: (r.prediction, [float(v) for v in r.features]) for r in model.transform(rows).collect()}
    base, total = AT.baseline(nodes), got.groupby("id")["contribution"].sum()
    for i, (p, _) in scored.items():
        assert abs(base + total.get(i, 0.0) - p) < 1e-9

    n = nodes.toPandas()  # noqa: F841  read by DuckDB
    f = pd.DataFrame([(i, v) for i, (_, v) in scored.items()], columns=["id", "v"])  # noqa: F841
    walk = duckdb.sql("""WITH RECURSIVE w AS (
 SELECT f.id, n.tree, n.node, CAST(NULL AS INTEGER) AS feature_index, CAST(0 AS DOUBLE) AS part FROM f, n WHERE n.node = 0
 UNION ALL SELECT f.id, c.tree, c.node, p.feature, p.weight * (c.value - p.value) FROM w JOIN f USING (id) JOIN n p ON p.tree = w.tree AND p.node = w.node
  JOIN n c ON c.tree = p.tree AND c.node = CASE WHEN CASE WHEN p.categories IS NULL THEN v[CAST(p.feature AS INTEGER) + 1] <= p.threshold
   ELSE list_contains(p.categories, v[CAST(p.feature AS INTEGER) + 1]) END THEN p."left" ELSE p."right" END WHERE p.feature IS NOT NULL)
SELECT id, feature_index, sum(part) AS c FROM w WHERE feature_index IS NOT NULL GROUP BY ALL""").fetchall()
    want = {(i, int(k)): c for i, k, c in walk if abs(c) > 1e-12}
    have = {(i, int(k)): c for i, k, c in got.itertuples(index=False) if abs(c) > 1e-12}
    assert want.keys() == have.keys() and all(abs(have[k] - c) < 1e-9 for k, c in want.items())
