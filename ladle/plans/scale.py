"""Scale-safe building blocks shared by the operators.

* ``running_total`` — running sums per key in a given order, built as a
  two-level prefix sum: rows are cut into value-range buckets (bounds from
  ``percentile_approx``), bucket totals are prefixed over a tiny window, and
  only one bucket of one key is ever ordered inside a task. A hot key (a third
  of all rows) is therefore spread over ``buckets`` tasks instead of one.
* ``exact_quantiles`` — exact, interpolated quantiles (the pandas/numpy
  'linear' rule) per key on top of ``running_total``; duplicates are collapsed
  by a map-side combined ``groupBy`` first, so memory follows distinct values
  per bucket, never the row count.
* ``one_row`` — turn a one-row aggregate into a struct scalar subquery that
  row expressions can read; Spark runs it once and inlines it (no cross join,
  no driver round trip).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

DEFAULT_BUCKETS = 256
APPROX_ACCURACY = 10000


def one_row(stats: DataFrame) -> Column:
    """A struct Column holding the single row of ``stats`` (scalar subquery)."""
    return stats.select(F.struct(*[F.col(c) for c in stats.columns]).alias("_s")).scalar()


def with_stats(df: DataFrame, stats: DataFrame, name: str = "_st") -> DataFrame:
    """Attach the one-row ``stats`` as a struct column ``name``.

    Reading several fields of one scalar subquery directly plans one subquery
    per field; attaching it once as a column keeps a single execution that
    every later expression reads (drop the column when done)."""
    return df.withColumn(name, one_row(stats))


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose values are computed once a row.

    Spark inlines a projection into everything that names it and pushes filters
    on it below aggregates, so a parsed column that two filters read is parsed
    many times over. A generated column is read as it is."""
    x = df.withColumn("_once", F.explode(F.array(F.struct(*[v.alias(c) for c, v in columns.items()]))))
    return x.withColumns({c: F.col("_once")[c] for c in columns}).drop("_once")


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null, as in ``groupBy``; the keys come from ``left``."""
    renamed = right.withColumnsRenamed({k: f"_join_{i}" for i, k in enumerate(keys)})
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"_join_{i}")) for i, k in enumerate(keys)]
    return left.join(renamed, on, how).drop(*[f"_join_{i}" for i in range(len(keys))])


#: Rows of a piece of ``spread``: what a task sorts and groups in some hundred MB.
PIECE_ROWS = 500_000


def spread(df: DataFrame, keys: Sequence[str], counted: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` dealt by ``keys`` into a piece for every ``rows`` (PIECE_ROWS) rows of ``counted``, a stored table it grows with (its
    row count is in the files' footers); as it is if that is one piece.

    The splits of a scan and the partitions that adaptive execution merges grow with the table up to 64 or 128 MB of
    packed bytes, which are many times that in a task's hash map; the number of these pieces grows instead."""
    n = -(-counted.count() // (rows or PIECE_ROWS))
    return df.repartition(n, *[F.col(k) for k in keys]) if n > 1 else df


def bucket_count(spark, default: int = DEFAULT_BUCKETS) -> int:
    """Buckets per key for ``running_total``: ``spark.ladle.buckets`` if set.
    Each bucket of a key is ordered inside one task, so a key of N rows needs
    about N / (rows a task sorts comfortably) buckets."""
    try:
        return int(spark.conf.get("spark.ladle.buckets", str(default)))
    except Exception:
        return default


def count_below(sorted_arr, v, n: int):
    """Number of elements of a sorted array (length n) strictly below ``v``,
    by binary search: O(log n) per row instead of scanning the array."""
    steps = max(1, math.ceil(math.log2(n + 1)))
    init = F.struct(F.lit(0).alias("lo"), F.size(sorted_arr).alias("hi"))

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        go_right = F.element_at(sorted_arr, mid + 1) < v
        return F.when(lo >= hi, acc).otherwise(
            F.when(go_right, F.struct((mid + 1).alias("lo"), hi.alias("hi")))
            .otherwise(F.struct(lo.alias("lo"), mid.alias("hi"))))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["lo"]


def _bucketed(df: DataFrame, keys: Sequence[str], order_col: str, tiebreak: Sequence[str], buckets: int) -> DataFrame:
    """Add ``_bk``, the bucket of each row: at most ``buckets`` per key, in the order of (order_col, first tiebreak).

    Equal neighbours among a key's bounds mark a value of many rows. It has as
    many buckets as bounds, the ones after its first being empty otherwise;
    quantiles of the tiebreak among its rows cut it into those."""
    qs = [i / buckets for i in range(1, buckets)]
    cut = lambda c: F.percentile_approx(c, qs, APPROX_ACCURACY)

    def put(x, t):
        if keys:
            return join_on(x, t, keys, "left")
        return with_stats(x, t, "_row").withColumns({c: F.col("_row")[c] for c in t.columns}).drop("_row")

    value = F.col(order_col).cast("double")
    bounds = df.groupBy(*keys).agg(cut(value).alias("_bounds"))
    split = bool(tiebreak) and isinstance(df.schema[tiebreak[0]].dataType, NumericType)
    if not split:
        return put(df, bounds).withColumn("_bk", count_below(F.col("_bounds"), value, len(qs))).drop("_bounds")
    bounds = bounds.withColumn("_same", F.transform("_bounds", lambda b: F.size(F.filter("_bounds", lambda c: c == b))))
    tie = F.coalesce(F.col(tiebreak[0]).cast("double"), F.lit(float("-inf")))
    x = put(df, bounds).withColumn("_bk", count_below(F.col("_bounds"), value, len(qs)))
    x = x.withColumn("_same", F.when(F.get("_bounds", F.col("_bk")) == value, F.get("_same", F.col("_bk"))))
    x = x.withColumn("_same", F.coalesce("_same", F.lit(1))).drop("_bounds")
    ties = x.where("_same > 1").groupBy(*keys, "_bk").agg(F.max("_same").alias("_same"), cut(tie).alias("_cuts"))
    ties = ties.select(*keys, F.explode(F.transform(F.sequence(F.lit(1), F.col("_same") - 1), lambda i: F.struct(
        "_bk", F.element_at("_cuts", F.floor(i * buckets / F.col("_same")).cast("int")).alias("_cut")))).alias("_tie"))
    ties = ties.groupBy(*keys).agg(F.array_sort(F.collect_list("_tie")).alias("_ties"))  # fewer than ``buckets`` entries
    x = put(x, ties)
    before = lambda v: count_below(F.col("_ties"), F.struct(F.col("_bk").alias("_bk"), v.alias("_cut")), len(qs))
    inside = before(tie) - before(F.lit(float("-inf")))
    return x.withColumn("_bk", F.when(F.col("_same") > 1, F.col("_bk") + inside).otherwise(F.col("_bk"))).drop("_same", "_ties")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    value_cols: Sequence[str],
    tiebreak: Sequence[str] = (),
    buckets: int | None = None,
    suffix: str = "_cum",
    split_ties: bool = True,
) -> DataFrame:
    """Add inclusive running sums ``<v><suffix>`` per ``keys`` ordered by
    ``order_col`` (then ``tiebreak``), without a whole key in one task.

    A value that holds several buckets' worth of rows is split by the first
    tiebreak, where that is numeric; all other rows with equal ``order_col``
    share a bucket. So ordering by (order_col, tiebreak) inside a bucket is
    globally consistent. ``split_ties=False`` saves a pass over ``df`` where
    ties are rare by construction (an order by a hash).
    """
    keys = list(keys)
    buckets = buckets or bucket_count(df.sparkSession)
    x = _bucketed(df, keys, order_col, tiebreak if split_ties else (), buckets)
    part = x.groupBy(*keys, "_bk").agg(*[F.sum(v).alias(f"_tot_{v}") for v in value_cols])
    # exclusive prefix over the bucket totals of each key: at most ``buckets``
    # entries per key, so one bounded array per key replaces a window
    arr = part.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_bk", *[f"_tot_{v}" for v in value_cols]))).alias("_a"))

    tot_types = dict(part.dtypes)

    def prefix(v):
        t = tot_types[f"_tot_{v}"]  # long for counts, double / decimal otherwise
        return lambda e, i: F.aggregate(F.slice("_a", 1, i), F.lit(0).cast(t),
                                        lambda acc, y: (acc + y[f"_tot_{v}"]).cast(t))

    offs = arr.select(*keys, F.transform("_a", lambda e, i: F.struct(
        e["_bk"].alias("_bk"), *[prefix(v)(e, i).alias(f"_off_{v}") for v in value_cols])).alias("_o"))
    offsets = offs.select(*keys, F.explode("_o").alias("_o")).select(
        *keys, "_o._bk", *[F.col(f"_o._off_{v}").alias(f"_off_{v}") for v in value_cols])
    x = join_on(x, offsets, [*keys, "_bk"])
    w = (
        Window.partitionBy(*keys, "_bk")
        .orderBy(F.col(order_col), *[F.col(t) for t in tiebreak])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    x = x.withColumns({f"{v}{suffix}": F.sum(v).over(w) + F.col(f"_off_{v}") for v in value_cols})
    return x.drop("_bk", *[f"_off_{v}" for v in value_cols])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Exact interpolated quantiles of ``value_col`` per ``keys`` (nulls ignored).

    Returns one row per key with one double column per probability (named by
    ``names``, default ``q<i>``) plus ``n`` (non-null count).
    """
    keys = list(keys)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    vals = df.select(*keys, F.col(value_col).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    counts = vals.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    cum = running_total(counts, keys, "_v", ["_n"], buckets=buckets)
    tot = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    x = join_on(cum, tot, keys) if keys else cum.withColumn("_total", one_row(tot)["_total"])
    start = F.col("_n_cum") - F.col("_n")  # first 0-based rank held by this value
    aggs = []
    for p, nm in zip(probs, names):
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs.append(F.max(F.when((start <= lo) & (lo < F.col("_n_cum")), F.col("_v"))).alias(f"_lo_{nm}"))
        aggs.append(F.max(F.when((start <= hi) & (hi < F.col("_n_cum")), F.col("_v"))).alias(f"_hi_{nm}"))
        aggs.append(F.max(pos - lo).alias(f"_fr_{nm}"))
    res = x.groupBy(*keys).agg(F.max("_total").alias("n"), *aggs)
    return res.select(
        *keys,
        "n",
        *[
            (F.col(f"_lo_{nm}") + (F.col(f"_hi_{nm}") - F.col(f"_lo_{nm}")) * F.col(f"_fr_{nm}")).alias(nm)
            for nm in names
        ],
    )


def long_form(df: DataFrame, cols: Sequence[str], cast: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``cols`` to (feature, value) rows, keeping ``keep`` columns."""
    return df.select(
        *keep,
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(cast).alias("value")) for c in cols])
        ).alias("_kv"),
    ).select(*keep, "_kv.feature", "_kv.value")


def materialize(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Cut the lineage of a table that several statistics or queries read.

    The rows are written once as a Parquet table in the shared folder named
    by ``spark.checkpoint.dir`` (set by the cluster; tests get a scratch
    folder) and read back. Unlike an RDD checkpoint, later plans then scan
    Parquet: column pruning, pushed-down filters and file statistics all
    apply, a lost executor re-reads files instead of recomputing upstream,
    and the plan is not re-planned once per statistic.

    ``group_rows``: rows of a row group, for tables with rows of megabytes. The writer looks at its
    bytes only after 100 rows, and the reader decodes a row group's rows at once (up to 4096).
    """
    import uuid

    from ladle.session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/ladle-tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").options(**({"parquet.block.row.count.limit": group_rows} if group_rows else {})).parquet(path)
    table = df.sparkSession.read.parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that ``materialize`` wrote and that nothing reads any more."""
    for t in tables:
        path = getattr(t, "stored_at", None)
        if path:
            spark = t.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, k, salt_buckets: int = 64,
                    rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows per ``keys`` by ``order`` (Columns, best first; end with a
    unique key). ``k`` is an int or a Column evaluated per row.

    Two rounds: first per (keys, salt) — a hot key is cut into
    ``salt_buckets`` pieces ranked in parallel — then per key over at most
    ``salt_buckets * k`` survivors. Adds a 1-based ``rank_col``.
    """
    keys = list(keys)
    kcol = F.lit(k) if isinstance(k, int) else k
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salt_buckets))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    first = df.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= kcol)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (
        first.drop("_salt", "_r1")
        .withColumn(rank_col, F.row_number().over(w2))
        .where(F.col(rank_col) <= kcol)
    )


def global_rank(df: DataFrame, keys: Sequence[str], score: str, id_col: str, descending: bool = True,
                rank_col: str = "rank", tiebreak: Sequence[str] = (), split_ties: bool = True) -> DataFrame:
    """1-based rank of every row per ``keys`` by ``score`` (ties by ``id_col``),
    through ``running_total`` so no key is ranked inside one task."""
    x = df.withColumn("_ord", -F.col(score) if descending else F.col(score)).withColumn("_one", F.lit(1))
    r = running_total(x, keys, "_ord", ["_one"], tiebreak=[id_col, *tiebreak], split_ties=split_ties)
    return r.withColumnRenamed("_one_cum", rank_col).drop("_ord", "_one")
