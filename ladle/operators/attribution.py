"""F20 for tree models: what each feature adds to a row's prediction.

A fitted tree, forest or booster is a table of nodes, saved by MLlib in the
shared folder and read back. A row's way from the root of a tree to its leaf changes the mean
label of the rows it is among at every step; the change belongs to the feature
that the step tests. So a row's contributions and the trees' root values
(``baseline``) add up to its prediction, for any row and model.

The node table is as large as the model (at most trees * 2**(depth + 1) rows, which every executor
holds to predict); rows walk it in Arrow batches, all rows of a batch and one tree at
a time, a step a level. A null or missing slot of the vector is NaN and goes right, as in the model.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.session import ensure_checkpoint_dir

NODE = "tree int, node int, value double, left int, right int, feature int, threshold double, categories array<double>, weight double"


def node_table(model, spark: SparkSession) -> DataFrame:
    """(tree, node, value, left, right, feature, threshold, categories, weight) of a fitted MLlib tree model; of a
    categorical test ``categories`` go left and ``threshold`` is null; leaves have no feature."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ladle-models/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        weights = [float(w) for w in model.treeWeights]
        share = sum(weights) if "RandomForest" in type(model).__name__ else 1.0
        each = F.element_at(F.array(*[F.lit(w / share) for w in weights]), F.col("treeID") + 1)
        nodes = nodes.select(F.col("treeID").alias("tree"), "nodeData.*", each.alias("weight"))
    else:
        nodes = nodes.select(F.lit(0).alias("tree"), "*", F.lit(1.0).alias("weight"))
    leaf, numeric = F.col("leftChild") < 0, F.col("split.numCategories") < 0
    test = F.col("split.leftCategoriesOrThreshold")
    return nodes.select("tree", F.col("id").alias("node"), F.col("prediction").alias("value"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
                        F.when(~leaf, F.col("split.featureIndex")).alias("feature"), F.when(~leaf & numeric, F.element_at(test, 1)).alias("threshold"),
                        F.when(~leaf & ~numeric, test).alias("categories"), "weight")


def baseline(nodes: DataFrame) -> float:
    """The prediction before any feature is looked at: the weighted root values."""
    return nodes.where("node = 0").agg(F.sum(F.col("value") * F.col("weight"))).first()[0]


class Trees:
    """The node table as arrays, a tuple for each tree."""

    def __init__(self, nodes: pd.DataFrame):
        self.trees = []
        for _, t in nodes.sort_values(["tree", "node"]).groupby("tree"):
            feature = t["feature"].fillna(-1).to_numpy().astype(int)
            listed = {int(i): np.array(c) for i, c in zip(t["node"], t["categories"]) if c is not None}
            self.trees.append((t["value"].to_numpy(), t["left"].to_numpy(), t["right"].to_numpy(), feature,
                               t["threshold"].to_numpy(dtype=float), listed, float(t["weight"].iloc[0])))

    def contributions(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape)
        for value, left, right, feature, threshold, listed, weight in self.trees:
            at, rows = np.zeros(len(x), int), np.arange(len(x))
            while True:
                rows = rows[feature[at[rows]] >= 0]
                if not len(rows):
                    break
                here = at[rows]
                f = feature[here]
                goes_left = x[rows, f] <= threshold[here]
                for node in np.unique(here[np.isin(here, list(listed))]) if listed else ():
                    some = here == node
                    goes_left[some] = np.isin(x[rows[some], f[some]], listed[node])
                to = np.where(goes_left, left[here], right[here])
                out[rows, f] += weight * (value[to] - value[here])
                at[rows] = to
        return out


def tree_contributions(model: PipelineModel, rows: DataFrame, key: str) -> DataFrame:
    """(key, feature_index, contribution) of every feature that changes the row's prediction; the model's
    last stage is a fitted tree, forest or booster over the column ``features``."""
    spark = rows.sparkSession
    trees = spark.sparkContext.broadcast(Trees(node_table(model.stages[-1], spark).toPandas()))
    x = model.transform(rows).select(F.col(key).alias("_key"), vector_to_array("features").alias("_x"))

    def walk(batches):
        for pdf in batches:
            if len(pdf):
                c = trees.value.contributions(np.stack(pdf["_x"].to_numpy()))
                at, f = np.nonzero(c)
                yield pd.DataFrame({"_key": pdf["_key"].to_numpy()[at], "feature_index": f, "contribution": c[at, f]})

    kind = dict(x.dtypes)["_key"]
    return x.mapInPandas(walk, f"_key {kind}, feature_index int, contribution double").withColumnRenamed("_key", key)
