"""Stored-table queries and exploratory aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.operators.restaurant_features import encode_cuisines_fixed
from ladle.plans.scale import exact_quantiles, join_on, one_row, top_k_per_group, with_stats


def list_restaurants(df: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    """One page ordered by (name, id), with the total row count."""
    total = one_row(df.agg(F.count(F.lit(1)).alias("total")))["total"]
    return df.orderBy("name", "restaurant_id").offset(offset).limit(limit).withColumn("total", total)


def restaurant_by_id(df: DataFrame, rid: int) -> DataFrame:
    """Point lookup (a pushed-down filter on a stored table)."""
    return df.where(F.col("restaurant_id") == F.lit(rid))


def restaurant_by_name(df: DataFrame, text: str) -> DataFrame:
    """First case-insensitive substring match, lowest id."""
    return df.where(F.col("name").ilike(f"%{text}%")).orderBy("restaurant_id").limit(1)


def by_cuisine(df: DataFrame, cuisine: str, limit: int = 20) -> DataFrame:
    """I4: substring match on cuisines, best Bayesian rating first (nulls last)."""
    return (df.where(F.col("cuisines").ilike(f"%{cuisine}%"))
            .orderBy(F.desc_nulls_last("bayesian_rating"), "restaurant_id").limit(limit))


def count_restaurants(df: DataFrame) -> DataFrame:
    """I5."""
    return df.agg(F.count(F.lit(1)).alias("n_restaurants"))


def recent_orders(orders: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    """Newest first, paged."""
    return orders.orderBy(F.desc("created_at"), F.desc("order_id")).offset(offset).limit(limit)


def orders_by_restaurant(orders: DataFrame, restaurants: DataFrame, n: int = 5,
                         cols: Sequence[str] = ("name", "location", "cuisines")) -> DataFrame:
    """I7 (bulk): the n newest orders of every restaurant, restaurant columns
    attached by a left outer join (orders whose restaurant is gone keep nulls).
    Newest-n per restaurant uses the salted two-round top-k."""
    top = top_k_per_group(orders, ["restaurant_id"], [F.desc("created_at"), F.desc("order_id")], n)
    r = restaurants.select("restaurant_id", *cols)
    return top.join(r, "restaurant_id", "left")


FEATURE_FILL = ["votes_log", "online_order_binary", "book_table_binary", "cuisine_count", "avg_sentiment",
                "reliability_score"]


def restaurant_feature_frame(df: DataFrame) -> DataFrame:
    """Stored restaurants + the 30 cuisine flags; six columns null -> 0."""
    out = encode_cuisines_fixed(df)
    return out.na.fill(0, subset=[c for c in FEATURE_FILL if c in out.columns])


def search(df: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """The first name match (one row) if any, else matches by cuisine.

    Both candidate sets are computed; a priority column keeps only the best
    non-empty one (a scalar subquery picks it), so nothing is collected.
    """
    by_name = restaurant_by_name(df, query).withColumn("_prio", F.lit(0))
    by_c = by_cuisine(df, query, limit).withColumn("_prio", F.lit(1))
    both = by_name.unionByName(by_c)
    best = one_row(both.agg(F.min("_prio").alias("p")))["p"]
    return both.where(F.col("_prio") == best).drop("_prio")


def value_counts(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """Most frequent values (ties by value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_last(col)).limit(n))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed. Every bin
    is reported, empty ones with 0."""
    st = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    x = with_stats(df, st, "_mm")
    lo, hi = F.col("_mm.lo"), F.col("_mm.hi")
    width = (hi - lo) / bins
    b = F.when(hi == lo, 1).otherwise(F.least(F.floor((F.col(col) - lo) / width) + 1, F.lit(bins))).cast("bigint")
    counts = x.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = with_stats(df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin")), st, "_mm")
    return grid.join(counts, "bin", "left").select(
        "bin", (lo + (F.col("bin") - 1) * width).alias("bin_start"), (lo + F.col("bin") * width).alias("bin_end"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def mean_by(df: DataFrame, group: str, value: str) -> DataFrame:
    """I18."""
    return df.groupBy(group).agg(F.avg(value).alias(f"mean_{value}"), F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact quartiles per group, IQR fences and whiskers (the most
    extreme values inside the fences)."""
    q = exact_quantiles(df, [group], value, [0.25, 0.5, 0.75], names=["q1", "median", "q3"])
    q = q.withColumns({"iqr": F.col("q3") - F.col("q1")})
    q = q.withColumns({"lower_fence": F.col("q1") - 1.5 * F.col("iqr"),
                       "upper_fence": F.col("q3") + 1.5 * F.col("iqr")})
    j = join_on(df.select(group, value), q.select(group, "lower_fence", "upper_fence"), [group])
    w = j.groupBy(group).agg(
        F.min(F.when(F.col(value) >= F.col("lower_fence"), F.col(value))).alias("whisker_low"),
        F.max(F.when(F.col(value) <= F.col("upper_fence"), F.col(value))).alias("whisker_high"),
        F.count_if((F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence"))).alias("outliers"),
    )
    return join_on(q, w, [group])


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, from one aggregate, long form."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    arr = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}__{b}").alias("corr"))
                    for a, b in pairs])
    return row.select(F.explode(arr).alias("p")).select("p.*")


def describe(df: DataFrame, col: str, group: str | None = None) -> DataFrame:
    """Count, mean, std (n-1), min, exact quartiles, max."""
    keys = [group] if group else []
    g = df.groupBy(*keys)
    base = g.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                 F.min(col).alias("min"), F.max(col).alias("max"))
    q = exact_quantiles(df, keys, col, [0.25, 0.5, 0.75], names=["p25", "p50", "p75"]).drop("n")
    if keys:
        return join_on(base, q, keys, "left")  # a group of nulls only has no quartiles
    x = with_stats(base, q, "_q")
    return x.withColumns({c: F.col("_q")[c] for c in ("p25", "p50", "p75")}).drop("_q")


def experiments(exps: DataFrame, task: str | None = None, limit: int = 20) -> DataFrame:
    """I8: newest experiments first, optional task filter."""
    e = exps.where(F.col("task") == task) if task else exps
    return e.orderBy(F.desc("created_at"), "model_name").limit(limit)


def winning_model(exps: DataFrame) -> DataFrame:
    """Per task the latest row flagged as winner."""
    return exps.where("is_winner").groupBy("task").agg(
        F.max_by(F.struct(*[c for c in exps.columns if c != "task"]), "created_at").alias("w")).select("task", "w.*")


def experiments_by_mae(exps: DataFrame, task: str) -> DataFrame:
    """I10."""
    return exps.where(F.col("task") == task).orderBy("mae", "model_name")


def model_info(exps: DataFrame, tasks) -> DataFrame:
    """Winner and metrics for each requested task, nulls when none."""
    t = exps.sparkSession.createDataFrame([(x,) for x in tasks], "task string")
    return t.join(winning_model(exps), "task", "left")


def winner_or_best(exps: DataFrame) -> DataFrame:
    """I16: per task the winner, else the lowest MAE."""
    return exps.groupBy("task").agg(F.min_by(F.struct(*[c for c in exps.columns if c != "task"]),
                                             F.struct((~F.col("is_winner")).alias("w"), F.col("mae"), F.col("model_name")))
                                    .alias("b")).select("task", "b.*")


def recent_drift(logs: DataFrame, limit: int = 20, only_alerted: bool = False) -> DataFrame:
    """Newest drift rows, optionally only the alerted ones."""
    d = logs.where("alerted") if only_alerted else logs
    return d.orderBy(F.desc("detected_at"), "feature_name").limit(limit)


def drift_summary(logs: DataFrame) -> DataFrame:
    """Total rows, alerted rows, distinct features and the last detection, one aggregate."""
    return logs.agg(F.count(F.lit(1)).alias("total"), F.count_if("alerted").alias("alerted"),
                    F.count_distinct("feature_name").alias("features"), F.max("detected_at").alias("last_detected_at"))
