"""Exact top-k search by no-random-access aggregation (NRA).

Vectors are cut into shards of a bounded number of rows. In a shard every
dimension is a list of (row, contribution) sorted by what it can add to the
query's score: from the largest component down where the query's component is
positive, from the smallest up where it is negative. What has been read to some depth
gives every vector a lower and an upper score: an entry not read yet adds at most the
value the list has been read down to (its frontier), and at least the list's last
value. A vector whose upper score is below the k-th best lower score is out. The bounds are
taken at two fixed depths of every list (``DEPTHS``), for a block of queries at once as
matrix products, and the scores of those left are then resolved in whole numbers.

Query rows are cut into blocks of a bounded number, so a task holds one shard
and one block. Each task returns k rows a query, and the k best over all shards
are taken by a window over (query), at most k times the number of shards rows.

Defined results: vectors that are null or hold null or non-finite components take no
part; so do rows with a null id. Vectors of each length are searched apart. Scores are exact
64-bit numbers; components so large that one might not fit are an error. Ties go to the smaller id. Repeated ids are separate candidates, none
of them a candidate of a query of that id. With fewer than k candidates all are
returned; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
#: Share of each list read by the end of each round.
DEPTHS = (0.75, 0.95)


class SortedLists:
    """The lists of one shard, in ascending order; read from either end."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: int = 1 << 52):
        """``vectors``: whole numbers; ``largest``: no product with a query's vector, nor any sum of its terms, is beyond it."""
        order = np.argsort(ids, kind="stable")  # so that ties in score keep the smaller id
        self.ids, self.exact = ids[order], vectors[order]
        # whole numbers below these limits add up exactly in single and double precision
        self.kind = np.float32 if largest < 1 << 23 else np.float64
        self.vectors = self.exact.astype(self.kind)
        self.rounded = largest >= 1 << 53
        self.slack = 4.0 * vectors.shape[1] * largest / (1 << 53) if self.rounded else 0
        self.lists = np.sort(self.vectors, axis=0)

    def bounds(self, rows: np.ndarray, up: np.ndarray, down: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper scores of ``rows`` for all queries once ``depth`` entries of each list are read.

        ``up`` and ``down`` are the queries' positive and negative components: for a positive one the
        list is read from its largest value down, so both bounds of all queries are matrix products."""
        v = self.vectors[rows]
        top, bottom = self.lists[len(self.ids) - depth], self.lists[depth - 1]  # the frontiers
        lower = up @ np.where(v >= top, v, self.lists[0]).T + down @ np.where(v <= bottom, v, self.lists[-1]).T
        upper = up @ np.maximum(v, top).T + down @ np.minimum(v, bottom).T
        return lower - self.slack, upper + self.slack

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of the k best rows for each query whose id isn't the query's own."""
        n = len(self.ids)
        q = queries.astype(self.kind)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        rows = np.arange(n)
        live = own[:, None] != self.ids[None, :]
        for share in DEPTHS:
            depth = int(n * share)
            if depth < 1 or len(rows) <= k:
                break
            lower, upper = self.bounds(rows, up, down, depth)
            lower[~live] = -np.inf
            live &= upper >= np.partition(lower, len(rows) - k, axis=1)[:, [len(rows) - k]]
            left = live.any(axis=0)
            rows, live = rows[left], live[:, left]
        # what is left is read to the end, in whole numbers
        scores = queries @ self.exact[rows].T if self.rounded else (q @ self.vectors[rows].T).astype(np.int64)
        take = min(k, len(rows))
        if not take:
            return (np.zeros(0, np.int64),) * 3
        # all rows that may be among the k best by score alone, then these by score and id
        lowest = np.iinfo(np.int64).min
        floor = np.partition(np.where(live, scores, lowest), len(rows) - take, axis=1)[:, [len(rows) - take]]
        of, at = np.nonzero(live & (scores >= floor))
        order = np.lexsort((self.ids[rows[at]], -scores[of, at], of))
        of, at = of[order], at[order]
        first = np.searchsorted(of, np.arange(len(own)))
        best = np.arange(len(of)) - first[of] < k
        of, at = of[best], at[best]
        return of, self.ids[rows[at]], scores[of, at]


def _search_groups(k: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        is_query = pdf["_query"].to_numpy(bool)
        rows, asked = pdf[~is_query], pdf[is_query]
        if not len(rows) or not len(asked):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})
        v, q = (np.stack(x["_v"].to_numpy()).astype(np.int64) for x in (rows, asked))
        largest = v.shape[1] * max(int(v.max()), -int(v.min())) * max(int(q.max()), -int(q.min()))
        if largest >= 1 << 63:
            raise OverflowError("a score may not fit 64 bits: components are too large")
        own = asked["_id"].to_numpy(np.int64)
        of, ids, score = SortedLists(rows["_id"].to_numpy(np.int64), v, largest).search(q, own, k)
        return pd.DataFrame({"query_id": own[of], "vec_id": ids, "score": score})
    return run


def quantized(embedding: Column, levels: int = 256) -> Column:
    """floor(levels * x) of every component as whole numbers."""
    return F.transform(embedding, lambda x: F.floor(F.lit(levels) * x.cast("double")))


def usable(embedding: Column) -> Column:
    """Whether the vector has components, none of them null or non-finite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & ~F.coalesce(bad, F.lit(True))


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
               vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for every query row."""
    e = F.col(f"`{vector_col}`")
    base = vectors.where(usable(e) & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("_id"), quantized(e).alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_is_query"))
    base = base.withColumn("_dim", F.size("_v"))
    counts = base.agg(F.count(F.lit(1)).alias("n"), F.count_if("_is_query").alias("q")).first()
    shards, blocks = max(1, -(-counts["n"] // SHARD_ROWS)), max(1, -(-counts["q"] // BLOCK_ROWS))
    # a row goes to its shard once for every block of queries; a query goes to every shard
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = F.xxhash64("_id", "_v")
    rows = base.select("_id", "_v", "_dim", F.lit(False).alias("_query"), F.pmod(place, F.lit(shards)).cast("int").alias("_shard"),
                       spread(blocks).alias("_block"))
    asked = base.where("_is_query").select("_id", "_v", "_dim", F.lit(True).alias("_query"), spread(shards).alias("_shard"),
                                           F.pmod(place, F.lit(blocks)).cast("int").alias("_block"))
    found = rows.unionByName(asked).groupBy("_block", "_shard", "_dim").applyInPandas(
        _search_groups(k), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
