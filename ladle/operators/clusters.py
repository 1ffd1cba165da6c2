"""Bisecting k-means for several k at once, and silhouettes, over weighted places.

Equal points are one place with their number as weight; nothing depends on there being any. A pass goes over
the places in Arrow batches, a task returns sums of a few clusters, and Spark adds them up.

* ``bisect_sweep`` grows the trees of all k together. They share their splits as long as they make the same ones, and a level's
  splits move their centres in the same passes: 20 passes a level for the whole sweep, not for each k. The rules are those of MLlib's
  ``BisectingKMeans`` (halves along a seeded noise, 20 iterations, the larger clusters first), which the tests compare it with.
* ``silhouettes`` takes any number of labellings in two passes: squared distances to a cluster follow from its
  size, mean and mean square, and a point is left out of its own cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.plans.scale import materialize

ITERATIONS = 20
#: Distances a task holds at a time.
BLOCK = 1_000_000


def weighted_places(points: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(c0, c1, ..., w), stored; points with a null or NaN coordinate take no part."""
    p = points.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    for c in p.columns:
        p = p.where(F.col(c).isNotNull() & ~F.isnan(c))
    return materialize(p.groupBy(*p.columns).agg(F.count(F.lit(1)).alias("w")))


def _coordinates(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c[0] == "c" and c[1:].isdigit()]


def _origin(places: DataFrame) -> np.ndarray:
    """The mean place: sums of squares about it lose no digits."""
    r = places.agg(*[F.avg(c) for c in _coordinates(places)]).first()
    return np.array([v or 0.0 for v in r])


def _sums(places: DataFrame, origin: np.ndarray, groups) -> dict[tuple[int, int], np.ndarray]:
    """(group, part) -> weight, sums of the coordinates, sum of squares; ``groups(x, batch)`` yields (group, rows, part of each row)."""
    names = _coordinates(places)
    out = ["n", *[f"s{i}" for i in range(len(names))], "q"]

    def run(batches):
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = np.column_stack([batch[c].to_numpy() for c in names]) - origin
            w = batch["w"].to_numpy().astype(float)
            for group, rows, part in groups(x, batch):
                ids, at = np.unique(part, return_inverse=True)
                cols = [w[rows], *(w[rows, None] * x[rows]).T, w[rows] * (x[rows] ** 2).sum(1)]
                for i, row in zip(ids.tolist(), np.column_stack([np.bincount(at, c, len(ids)) for c in cols]) if len(ids) else ()):
                    found[group, i] = found.get((group, i), 0.0) + row
        if found:
            values = np.array(list(found.values()))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.int64()),
                                              *[pa.array(c) for c in values.T]], ["g", "part", *out])

    schema = "g long, part long, " + ", ".join(f"{c} double" for c in out)
    rows = places.mapInArrow(run, schema).groupBy("g", "part").agg(*[F.sum(c).alias(c) for c in out]).collect()
    return {(r["g"], r["part"]): np.array(r[2:]) for r in rows if r["n"] > 0}


def nearest_center(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.stack([((x - c) ** 2).sum(1) for c in centers], 1).argmin(1)


class Split:
    """A cluster's halves: ``centers`` by side (0, 1; a side without points has none); the cluster is a side of ``parent``."""

    def __init__(self, parent: Split | None, side: int, centers: dict[int, np.ndarray]):
        self.parent, self.side, self.centers, self.parts = parent, side, centers, {}

    def sides(self, x: np.ndarray) -> np.ndarray:
        return np.array(list(self.centers))[nearest_center(x, np.array(list(self.centers.values())))]

    def rows(self, x: np.ndarray, seen: dict) -> np.ndarray:
        """Rows of ``x`` in the cluster."""
        if self.parent is None:
            return np.arange(len(x))
        key = (id(self.parent), self.side)
        if key not in seen:
            own = self.parent.rows(x, seen)
            side = self.parent.sides(x[own])
            seen.update({(id(self.parent), s): own[side == s] for s in (0, 1)})
        return seen[key]


def _move(places: DataFrame, origin: np.ndarray, splits: list[Split]) -> None:
    """Lloyd's iterations of all ``splits``; ends early where no centre moves, as more would change nothing."""
    for _ in range(ITERATIONS):
        def groups(x, batch):
            seen: dict = {}
            for i, s in enumerate(splits):
                rows = s.rows(x, seen)
                yield i, rows, s.sides(x[rows])

        found = _sums(places, origin, groups)
        moved = False
        for i, s in enumerate(splits):
            s.parts = {side: found[i, side] for side in (0, 1) if (i, side) in found}
            new = {side: v[1:-1] / v[0] for side, v in s.parts.items()}
            moved |= list(new) != list(s.centers) or any((new[k] != s.centers[k]).any() for k in new)
            s.centers = new
        if not moved:
            return


def bisect_sweep(places: DataFrame, ks: Sequence[int], seed: int) -> list[dict]:
    """For each k a tree, node -> (children, their centres): the root is 1, the children of i are 2i and 2i + 1."""
    origin, jvm = _origin(places), places.sparkSession._jvm
    root = _sums(places, origin, lambda x, batch: [(0, np.arange(len(x)), np.zeros(len(x), int))]).get((0, 0))
    known: dict[tuple, Split] = {}
    state = [{"needed": k - 1, "random": jvm.java.util.Random(seed), "active": {} if root is None else {1: (root, None, 0)}, "tree": {}} for k in ks]
    while True:
        todo: list[Split] = []
        for s in state:
            cost = lambda v: max(v[-1] - (v[1:-1] ** 2).sum() / v[0], 0.0)
            due = [i for i, (v, _, _) in sorted(s["active"].items()) if cost(v) > np.finfo(float).eps * v[0]]
            if len(due) > s["needed"]:
                due = sorted(due, key=lambda i: -s["active"][i][0][0])[:s["needed"]]
            s["due"] = {}
            for i in due:
                v, parent, side = s["active"][i]
                center = v[1:-1] / v[0]
                noise = np.array([s["random"].nextDouble() for _ in center]) * 1e-4 * np.linalg.norm(center + origin)
                key = (id(parent), side, *noise.tolist())
                if key not in known:
                    known[key] = Split(parent, side, {0: center - noise, 1: center + noise})
                    todo.append(known[key])
                s["due"][i] = known[key]
        if not any(s["due"] for s in state):
            return [{i: ([2 * i + k for k in sp.centers], np.array(list(sp.centers.values())) + origin) for i, sp in s["tree"].items()} for s in state]
        _move(places, origin, todo)
        for s in state:
            s["tree"].update(s["due"])
            s["needed"] -= len(s["due"])
            s["active"] = {2 * i + side: (v, sp, side) for i, sp in s["due"].items() for side, v in sp.parts.items()}


def tree_labels(tree: dict, x: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    at = np.full(len(x), min(tree, default=1))
    for node in sorted(tree):  # children have larger numbers
        some = np.flatnonzero(at == node)
        children, centers = tree[node]
        at[some] = np.array(children)[nearest_center(x[some], centers)]
    return at


def silhouettes(places: DataFrame, labellings: Sequence[dict | str]) -> list[tuple[int, float | None]]:
    """(clusters with points, mean silhouette by squared distance, null for fewer than two) of each labelling: a tree, or a
    column of numbers (null: no part). Each of a place's ``w`` points counts, and is left out of its own cluster."""
    origin, names = _origin(places), _coordinates(places)

    def groups(x, batch):
        for i, lab in enumerate(labellings):
            if isinstance(lab, str):
                rows = np.flatnonzero(batch[lab].is_valid().to_numpy(zero_copy_only=False))
                yield i, rows, batch[lab].drop_null().to_numpy()
            else:
                yield i, np.arange(len(x)), tree_labels(lab, x + origin)

    found = _sums(places, origin, groups)
    clusters = {}
    for i in range(len(labellings)):
        ids = np.array(sorted(part for g, part in found if g == i), int)
        v = np.array([found[i, part] for part in ids.tolist()]).reshape(len(ids), len(names) + 2)
        clusters[i] = (ids, v[:, 0], v[:, 1:-1] / v[:, :1], v[:, -1] / v[:, 0])

    def run(batches):
        total = np.zeros(len(labellings))
        for batch in batches:
            x = np.column_stack([batch[c].to_numpy() for c in names]) - origin
            w = batch["w"].to_numpy().astype(float)
            for i, rows, part in groups(x, batch):
                ids, n, mean, square = clusters[i]
                size = max(1, BLOCK // max(1, len(ids)))
                for a in range(0, len(rows) if len(ids) > 1 else 0, size):
                    some, own = rows[a:a + size], np.searchsorted(ids, part[a:a + size])
                    d = (x[some] ** 2).sum(1)[:, None] + square[None] - 2 * x[some] @ mean.T
                    at = np.arange(len(some))
                    near = d[at, own] * n[own] / np.maximum(n[own] - 1, 1)
                    d[at, own] = np.inf
                    other = d.min(1)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        s = np.where(near < other, 1 - near / other, np.where(near > other, other / near - 1, 0.0))
                    total[i] += (w[some] * np.where(n[own] > 1, s, 0.0)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int64()), pa.array(total)], ["g", "total"])

    totals = {r["g"]: r["total"] for r in places.mapInArrow(run, "g long, total double").groupBy("g").agg(F.sum("total").alias("total")).collect()}
    return [(len(ids), totals[i] / n.sum() if len(ids) > 1 else None) for i, (ids, n, _, _) in clusters.items()]
