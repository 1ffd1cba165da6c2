"""DBSCAN on 2-D points without the pairs of dense places.

Equal points are one, with their number as weight. Points fall into cells of
side eps / sqrt(2), so all points of a cell are within eps of one another.

* A cell whose weight reaches ``min_samples`` is full: all its points are core, no pair is looked at.
* A point of another cell is compared with the points of the 25 cells around it. Such a cell has fewer than
  ``min_samples`` points, so a point, however dense its place, is looked at by at most
  24 * (min_samples - 1) others: the pairs grow with the points.
* The core points of a cell are one cluster, so clusters are components of cells. Two cells are linked if a core
  point of one is within eps of one of the other: tried first on the outermost points of both
  in eight directions, and only where that fails, and the two aren't in one component already, on their points within eps of
  the other cell's box, by blocks that a task holds.
* A border point takes the smallest adjacent cluster; the rest is noise (-1).

Points with a null coordinate have no label.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.plans.scale import discard, global_rank, materialize

#: Points of a cell that one task compares.
BLOCK_ROWS = 2000


def squared(x1, y1, x2, y2) -> Column:
    return (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)


def smallest_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component; min-label rounds with pointer jumping, until nothing changes."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = materialize(nodes.select("node", F.col("node").alias("label")))
    while True:
        low = both.join(label.select(F.col("node").alias("b"), F.col("label").alias("l")), "b").groupBy("a").agg(F.min("l").alias("m"))
        step = label.join(low.withColumnRenamed("a", "node"), "node", "left").select("node", F.least("label", F.coalesce("m", "label")).alias("label"))
        named = step.select(F.col("node").alias("label"), F.col("label").alias("l"))
        new = materialize(step.join(named, "label", "left").select("node", F.least("label", F.coalesce("l", "label")).alias("label")))
        same = not new.join(label.withColumnRenamed("label", "old"), "node").where("label <> old").limit(1).count()
        discard(label)
        label = new
        if same:
            discard(both)
            return label


def _near(eps: float):
    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        hit = False
        q, r = a[["x", "y"]].to_numpy(), b[["x", "y"]].to_numpy()
        for i in range(0, len(q) if len(r) else 0, 500):
            dx, dy = q[i:i + 500, 0, None] - r[None, :, 0], q[i:i + 500, 1, None] - r[None, :, 1]
            if (dx * dx + dy * dy <= eps * eps).any():
                hit = True
                break
        return pd.DataFrame({"a": [key[0]], "b": [key[1]]} if hit else {"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    return run


def _cell_links(core: DataFrame, eps: float, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(cells with the smallest core id as ``node``, links a, b between them)."""
    ways = {"e": F.col("x"), "w": -F.col("x"), "n": F.col("y"), "s": -F.col("y"), "ne": F.col("x") + F.col("y"), "sw": -F.col("x") - F.col("y"),
            "nw": F.col("y") - F.col("x"), "se": F.col("x") - F.col("y")}
    xy = F.struct("x", "y")
    cells = materialize(core.groupBy("cx", "cy").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.array(*[F.max_by(xy, w) for w in ways.values()]).alias("out")))
    half = [(dx, dy) for dx in range(0, 3) for dy in range(-2, 3) if (dx, dy) > (0, 0)]
    offsets = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in half]))
    near = cells.withColumn("o", offsets).withColumns({"cx": F.col("cx") + F.col("o.dx"), "cy": F.col("cy") + F.col("o.dy")}).drop("o")
    names = ("node", "n", "x0", "x1", "y0", "y1", "out")
    two = near.withColumnsRenamed({c: f"a_{c}" for c in names}).join(cells.withColumnsRenamed({c: f"b_{c}" for c in names}), ["cx", "cy"]).drop("cx", "cy")
    gap = lambda lo, hi: F.greatest(F.lit(0.0), F.col(f"a_{lo}") - F.col(f"b_{hi}"), F.col(f"b_{lo}") - F.col(f"a_{hi}"))
    reach = eps * eps * (1 + 1e-9)
    two = two.where(gap("x0", "x1") * gap("x0", "x1") + gap("y0", "y1") * gap("y0", "y1") <= reach)
    linked = F.exists("a_out", lambda p: F.exists("b_out", lambda q: squared(p["x"], p["y"], q["x"], q["y"]) <= eps * eps))
    two = materialize(two.withColumn("linked", linked).drop("a_out", "b_out"))
    links = two.where("linked").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    open_pairs = two.where("NOT linked")
    if not open_pairs.limit(1).count():
        return cells, links
    label = smallest_labels(cells, links)
    of = lambda c: label.select(F.col("node").alias(f"{c}_node"), F.col("label").alias(f"{c}_label"))
    apart = open_pairs.join(of("a"), "a_node").join(of("b"), "b_node").where("a_label <> b_label")
    blocks = lambda c: F.ceil(F.col(f"{c}_n") / block_rows).cast("int")
    apart = materialize(apart.withColumns({"a_blocks": blocks("a"), "b_blocks": blocks("b")}))
    points = core.join(cells.select("cx", "cy", "node"), ["cx", "cy"]).select("id", "x", "y", "node")

    def side(own: str, other: str) -> DataFrame:
        """The points of one cell of each pair within eps of the other's box, once for each block of the other."""
        box = [F.greatest(F.lit(0.0), F.col(f"{other}_{c}0") - F.col(c), F.col(c) - F.col(f"{other}_{c}1")) for c in ("x", "y")]
        rows = apart.join(points, F.col(f"{own}_node") == F.col("node")).where(box[0] * box[0] + box[1] * box[1] <= reach)
        mine = F.pmod(F.xxhash64("id"), F.col(f"{own}_blocks")).cast("int")
        rows = rows.withColumns({f"{own}_block": mine, f"{other}_block": F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))})
        out = ("a_node", "b_node", "a_block", "b_block", "x", "y")
        return rows.select(*out).toDF(*out)

    keys = ("a_node", "b_node", "a_block", "b_block")
    found = side("a", "b").groupBy(*keys).cogroup(side("b", "a").groupBy(*keys)).applyInPandas(_near(eps), "a long, b long")
    return cells, materialize(links.unionByName(found.distinct()))


def _coordinates(points: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    return points.select(F.col(id_col), *[F.col(c).cast("double").alias(n) for c, n in zip(cols, ("x", "y"))]).where("x IS NOT NULL AND y IS NOT NULL")


def dense_places(points: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """(x, y, w, ids, id), stored: the distinct points with their number, and those of them with an ``id_col``; ``id`` numbers the places."""
    p = _coordinates(points, id_col, cols).groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"), F.count(id_col).alias("ids"))
    # ids by rank: two places never share one
    p = materialize(p.withColumn("_h", F.xxhash64("x", "y").cast("double")))
    ranked = materialize(global_rank(p, [], "_h", "x", descending=False, rank_col="id", tiebreak=["y"], split_ties=False).drop("_h").withColumn("id", F.col("id").cast("long")))
    discard(p)
    return ranked


def place_labels(places: DataFrame, eps: float, min_samples: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(x, y, ids, cluster) of ``dense_places``: clusters numbered from 0 by their smallest core point, noise -1; see the module."""
    side = eps / math.sqrt(2) * (1 - 1e-9)  # a cell's corners are within eps of each other whatever is rounded
    p = places.withColumns({"cx": F.floor(F.col("x") / side).cast("long"), "cy": F.floor(F.col("y") / side).cast("long")})
    cells = materialize(p.groupBy("cx", "cy").agg(F.sum("w").alias("weight"), F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")))
    p = materialize(p.join(cells, ["cx", "cy"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    full = F.col("weight") >= min_samples
    around = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in range(-2, 3) for dy in range(-2, 3)]))
    probes = p.where(~full).select("id", "x", "y", "cx", "cy", around.alias("o")).select(
        F.col("id").alias("id1"), F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("cx") + F.col("o.dx")).alias("cx"), (F.col("cy") + F.col("o.dy")).alias("cy"))
    probes = probes.join(cells.select("cx", "cy", "blocks"), ["cx", "cy"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    seen = probes.join(p.select("cx", "cy", "block", F.col("id").alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2"), "w"), ["cx", "cy", "block"])
    seen = materialize(seen.where(squared(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")) <= eps * eps).select("id1", "id2", "w"))
    own = seen.groupBy("id1").agg(F.sum("w").alias("n")).where(F.col("n") >= min_samples).select(F.col("id1").alias("id"))
    core = materialize(p.where(full).select("id", "x", "y", "cx", "cy").unionByName(p.join(own, "id", "left_semi").select("id", "x", "y", "cx", "cy")))
    nodes, links = _cell_links(core, eps, block_rows)
    label = smallest_labels(nodes, links)
    of_cell = nodes.select("cx", "cy", "node").join(label, "node").select("cx", "cy", "label")
    of_core = materialize(core.join(of_cell, ["cx", "cy"]).select("id", "label"))
    border = seen.join(of_core.withColumnRenamed("id", "id2"), "id2").groupBy("id1").agg(F.min("label").alias("nearby"))
    lab = p.select("id", "x", "y", "ids").join(of_core, "id", "left").join(border.withColumnRenamed("id1", "id"), "id", "left")
    lab = lab.select("x", "y", "ids", F.coalesce("label", "nearby").alias("label"))
    numbers = global_rank(label.select("label").distinct(), [], "label", "label", descending=False, rank_col="cluster", split_ties=False)
    lab = lab.join(numbers.select("label", (F.col("cluster") - 1).cast("bigint").alias("cluster")), "label", "left")
    return lab.select("x", "y", "ids", F.coalesce("cluster", F.lit(-1).cast("bigint")).alias("cluster"))


def dbscan_labels(points: DataFrame, id_col: str, cols: Sequence[str], eps: float, min_samples: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, cluster) of every point with both coordinates; see the module."""
    lab = place_labels(dense_places(points, cols, id_col), eps, min_samples, block_rows)
    return _coordinates(points, id_col, cols).join(lab.drop("ids"), ["x", "y"]).select(id_col, "cluster")
