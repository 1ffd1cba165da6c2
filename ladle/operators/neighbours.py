"""exact k-nearest-neighbour regression as a join over the cells of a k-d tree.

A tree of median splits, from a bounded sample of the places, cuts space into cells.
Every cell knows the box of its rows. Two rounds:

1. q is compared with near rows of its own cell. The k-th best distance there is
   an upper bound t of the answer's.
2. q goes to every cell whose box comes within t and that holds a row of another fold, is compared
   with the rows of that cell, and keeps its k best of each block that are within t. The k best of all are the answer.

No pair is ever a row: a task compares bounded blocks of queries and rows as
arrays, cut into runs of near rows, and a run meets only runs whose boxes are within its bound.
Equal points are one: of the rows at one place only the k smallest ids of each fold can be
among anyone's neighbours, and all queries of one place and fold have one answer, so
a place that holds a third of all rows is a few rows here.

Ties in distance go to the smaller id. Rows with a null or NaN coordinate, label, id or
fold are neither queries nor neighbours, nor are those with an infinite coordinate, which have no distance;
a query with fewer than k rows in other folds averages those it has, and has no row in the result if there is none.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.plans.scale import discard, materialize, top_k_per_group

#: Rows of a cell on average, the most cells (their boxes are broadcast) and the rows of a block.
CELL_ROWS, MOST_CELLS, BLOCK_ROWS = 500, 1 << 14, 2000
#: Places sampled for each cell, rows of a run of near rows, and the runs that give a query its bound.
SAMPLED, RUN_ROWS, BOUND_RUNS = 8, 64, 8


def squared(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Squared distances, summed coordinate by coordinate."""
    out = np.zeros((len(q), len(r)))
    for c in range(q.shape[1]):
        d = q[:, c, None] - r[None, :, c]
        out += d * d
    return out


def _best(d: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k smallest finite entries of each row, ties by id, in order."""
    take = min(k, d.shape[1])
    floor = np.partition(d, take - 1, axis=1)[:, [take - 1]]
    at, col = np.nonzero((d <= floor) & np.isfinite(d))
    order = np.lexsort((ids[col], d[at, col], at))
    at, col = at[order], col[order]
    keep = np.arange(len(at)) - np.searchsorted(at, np.arange(len(d)))[at] < k
    return at[keep], col[keep]


def _vectors(pdf: pd.DataFrame, dims: int) -> np.ndarray:
    return np.stack(pdf["_v"].to_numpy()) if len(pdf) else np.zeros((0, dims))


def _splits(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(coordinate, value) of the splits of a tree, level by level: the median of the widest coordinate."""
    dim, at, parts = np.zeros(2 ** depth - 1, np.int64), np.zeros(2 ** depth - 1), [sample]
    for i in range(len(dim)):
        p = parts[i]
        if len(p):
            dim[i] = np.argmax(p.max(axis=0) - p.min(axis=0))
            at[i] = np.partition(p[:, dim[i]], len(p) // 2)[len(p) // 2]
        left = p[:, dim[i]] < at[i]
        parts += [p[left], p[~left]]
    return dim, at


def _cells(x: np.ndarray, dim: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(len(dim).bit_length()):
        node = 2 * node + 1 + (x[rows, dim[node]] >= at[node])
    return node - len(dim)


def _runs(x: np.ndarray) -> list[np.ndarray]:
    """Runs of at most RUN_ROWS near rows, cut at medians of the widest coordinate."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        if len(at) <= RUN_ROWS:
            out.append(at)
            continue
        p = x[at]
        order = np.argpartition(p[:, np.argmax(p.max(axis=0) - p.min(axis=0))], len(at) // 2)
        todo += [at[order[:len(at) // 2]], at[order[len(at) // 2:]]]
    return out


def _boxes(x: np.ndarray, runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([x[i].min(axis=0) for i in runs]), np.array([x[i].max(axis=0) for i in runs])


def _gaps(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of the box of ``p`` from each of the boxes."""
    gap = np.maximum(0.0, np.maximum(low - p.max(axis=0), p.min(axis=0) - high))
    return (gap * gap).sum(axis=1)


def _reach(t: np.ndarray) -> np.ndarray:
    """The squared bound; rounding never leaves a row out."""
    return (t * (1 + 1e-9) + 1e-12) ** 2


def _bounds(x: np.ndarray, fold: np.ndarray, y: np.ndarray, y_fold: np.ndarray, runs: list[np.ndarray], k: int) -> np.ndarray:
    """Distance within which each row of the run ``x`` has k rows of other folds among ``y``, infinite if there are fewer."""
    def kth(ask: np.ndarray, near: np.ndarray) -> np.ndarray:
        if len(near) < k:
            return np.full(len(ask), np.inf)
        d = squared(x[ask], y[near])
        d[fold[ask][:, None] == y_fold[near][None, :]] = np.inf
        return np.sqrt(np.partition(d, k - 1, axis=1)[:, k - 1])

    first = np.argsort(_gaps(x, *_boxes(y, runs)), kind="stable")[:BOUND_RUNS]
    t = kth(np.arange(len(x)), np.concatenate([runs[j] for j in first]))
    left = np.flatnonzero(np.isinf(t))
    if len(left) and len(runs) > BOUND_RUNS:
        t[left] = kth(left, np.arange(len(y)))
    return t


def _places(points: DataFrame, k: int, cell_rows: int, block_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(_q, _v, _fold) of the distinct places and folds, and (_q, _id, _label, _d): the k nearest rows of other folds of each."""
    spark = points.sparkSession
    finite = points.where(~F.exists("_v", lambda x: F.abs(x) == float("inf")))
    refs = materialize(top_k_per_group(finite, ["_v", "_fold"], [F.asc("_id")], k))
    n = refs.count()
    if not n:
        return refs.select(F.lit(0).cast("long").alias("_q"), "_v", "_fold"), None
    depth = (max(1, min(MOST_CELLS, n // cell_rows)) - 1).bit_length()
    chosen = refs.where("rank = 1").select("_v").orderBy(F.xxhash64("_v"), "_v").limit(SAMPLED << depth)
    sample = np.array([r["_v"] for r in chosen.collect()])  # at most SAMPLED * MOST_CELLS rows
    dims, tree = sample.shape[1], spark.sparkContext.broadcast(_splits(sample, depth))

    def to_cells(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(_cell=_cells(_vectors(pdf, dims), *tree.value).astype(np.int32))

    base = "_q long, _id long, _label double, _fold long, _v array<double>, rank int"
    named = refs.select(F.monotonically_increasing_id().alias("_q"), "_id", "_label", "_fold", "_v", "rank")
    placed = materialize(named.mapInPandas(to_cells, f"{base}, _cell int"))
    discard(refs)
    ends = [f(F.col("_v")[c]).alias(f"{name}{c}") for c in range(dims) for name, f in (("low", F.min), ("high", F.max))]
    again = [f(f"{name}{c}").alias(f"{name}{c}") for c in range(dims) for name, f in (("low", F.min), ("high", F.max))]
    stats = placed.groupBy("_cell", "_fold").agg(F.count(F.lit(1)).alias("n"), *ends).groupBy("_cell").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.min("_fold").alias("fold"), *again).collect()  # at most a row for each cell
    column = lambda *names: np.array([[r[c] for c in names] for r in stats])
    cell, size, most, only = column("_cell", "n", "most", "fold").T
    low, high = column(*[f"low{c}" for c in range(dims)]), column(*[f"high{c}" for c in range(dims)])
    boxes = spark.sparkContext.broadcast((cell, size, most, only, low, high))
    blocks = F.broadcast(spark.createDataFrame([(int(c), -(-int(m) // block_rows)) for c, m in zip(cell, size)], "_cell int, _blocks int"))
    rows = placed.join(blocks, "_cell").withColumn("_block", F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int"))

    def route(pdf: pd.DataFrame) -> pd.DataFrame:
        """The cells that each query of a block has to see, and its bound."""
        cell, size, most, only, low, high = boxes.value
        y, y_fold = _vectors(pdf, dims), pdf["_fold"].to_numpy()
        runs, ask, out = _runs(y), np.flatnonzero(pdf["rank"].to_numpy() == 1), []
        for part in _runs(y[ask]) if len(ask) else ():
            mine = ask[part]
            x, fold = y[mine], y_fold[mine]
            t = _bounds(x, fold, y, y_fold, runs, k)
            near = np.flatnonzero(_gaps(x, low, high) <= _reach(t.max()))
            for f in np.unique(fold):
                # rows of other folds that a cell has at least; none only if it has none
                others = np.where(size > most, size - most, np.where(only == f, 0, size))
                some = np.flatnonzero(fold == f)
                far = some[np.isinf(t[some])]
                if len(far) and others.sum() >= k:  # the cells around whose far corners are nearest hold k such rows
                    corner = np.zeros((len(far), len(cell)))
                    for c in range(dims):
                        corner += np.maximum(np.abs(x[far, c, None] - low[None, :, c]), np.abs(x[far, c, None] - high[None, :, c])) ** 2
                    order = np.argsort(corner, axis=1)
                    last = (np.cumsum(others[order], axis=1) >= k).argmax(axis=1)
                    t[far] = np.sqrt(corner[np.arange(len(far)), order[np.arange(len(far)), last]])
                to = near[others[near] > 0]
                gap = np.zeros((len(some), len(to)))
                for c in range(dims):
                    gap += np.maximum(0.0, np.maximum(low[None, to, c] - x[some, c, None], x[some, c, None] - high[None, to, c])) ** 2
                at, hit = np.nonzero(gap <= _reach(t[some])[:, None])
                out.append((mine[some[at]], t[some[at]], cell[to[hit]]))
        at, t, to = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        return pd.DataFrame({"_q": pdf["_q"].to_numpy()[at], "_v": pdf["_v"].to_numpy()[at], "_fold": y_fold[at], "_t": t, "_cell": to.astype(np.int32)})

    routed = materialize(rows.groupBy("_cell", "_block").applyInPandas(route, "_q long, _v array<double>, _fold long, _t double, _cell int"))
    # a cell's rows and its visitors are both cut into blocks; every two blocks meet in a task
    visits = routed.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / (4 * block_rows)).cast("int").alias("_visits"))
    visits = F.broadcast(visits)  # at most a row for each cell
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    asks = routed.join(visits, "_cell").join(blocks, "_cell").withColumn(
        "_visit", F.pmod(F.xxhash64("_q"), F.col("_visits")).cast("int")).withColumn("_block", each("_blocks"))
    holds = rows.join(visits, "_cell").withColumn("_visit", each("_visits"))

    def compare(key, q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(r):
            x, fold, reach = _vectors(q, dims), q["_fold"].to_numpy(), _reach(q["_t"].to_numpy())
            y, ids, y_fold = _vectors(r, dims), r["_id"].to_numpy(), r["_fold"].to_numpy()
            runs = _runs(y)
            low, high = _boxes(y, runs)
            for mine in _runs(x):
                met = np.flatnonzero(_gaps(x[mine], low, high) <= reach[mine].max())
                if not len(met):
                    continue
                near = np.concatenate([runs[j] for j in met])
                d = squared(x[mine], y[near])
                d[(fold[mine][:, None] == y_fold[near][None, :]) | (d > reach[mine][:, None])] = np.inf
                at, col = _best(d, ids[near], k)
                out.append((mine[at], near[col], d[at, col]))
        at, col, d = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pd.DataFrame({"_q": q["_q"].to_numpy()[at], "_id": r["_id"].to_numpy()[col], "_label": r["_label"].to_numpy()[col], "_d": d})

    # fresh attributes, so the cogroup's keys cannot be ambiguous
    pieces = ["_cell", "_block", "_visit"]
    asks = asks.select("_q", "_v", "_fold", "_t", *pieces).toDF("_q", "_v", "_fold", "_t", *pieces)
    holds = holds.select("_v", "_fold", "_id", "_label", *pieces).toDF("_v", "_fold", "_id", "_label", *pieces)
    found = asks.groupBy(*pieces).cogroup(holds.groupBy(*pieces)).applyInPandas(compare, "_q long, _id long, _label double, _d double")
    order = Window.partitionBy("_q").orderBy("_d", "_id")
    found = materialize(found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank"))
    places = materialize(placed.where("rank = 1").select("_q", "_v", "_fold"))
    discard(placed, routed)
    return places, found


def nearest(points: DataFrame, k: int = 10, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(_v, _fold, _id, _label, _d): for every distinct place and fold of ``points`` (_id, _v, _fold, _label) its k
    nearest rows of other folds, with the squared distance."""
    places, found = _places(points, k, cell_rows, block_rows)
    if found is None:
        return points.where("false").withColumn("_d", F.lit(0.0)).select("_v", "_fold", "_id", "_label", "_d")
    return found.join(places, "_q").select("_v", "_fold", "_id", "_label", "_d")


def knn_regression(df: DataFrame, key: str, label: str, cols: Sequence[str], fold: str, k: int = 10,
                   cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Out-of-fold predictions: (key, actual, prediction, nearest), the mean label of the k rows of other folds that are
    nearest in ``cols`` (scaled by the caller), and the nearest one's key."""
    clean = df.select(F.col(key).cast("long").alias("_id"), F.col(label).cast("double").alias("_label"), F.col(fold).cast("long").alias("_fold"),
                      F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in cols]).alias("_v"))  # -0.0 is 0.0
    ok = F.col("_id").isNotNull() & F.col("_fold").isNotNull() & F.col("_label").isNotNull() & ~F.isnan("_label")
    points = clean.where(ok & ~F.exists("_v", lambda x: x.isNull() | F.isnan(x)))
    places, found = _places(points, k, cell_rows, block_rows)
    if found is None:
        return points.where("false").select(F.col("_id").alias(key), F.col("_label").alias("actual"), F.lit(0.0).alias("prediction"), F.col("_id").alias("nearest"))
    answer = found.groupBy("_q").agg(F.avg("_label").alias("prediction"), F.min_by("_id", F.struct("_d", "_id")).alias("nearest"))
    answer = answer.join(places, "_q").drop("_q")
    return points.join(answer, ["_v", "_fold"]).select(F.col("_id").alias(key), F.col("_label").alias("actual"), "prediction", "nearest")
