"""Reliability, SLA, scenario and dispatch operators."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.config import DEFAULTS
from ladle.dims import WEIGHT_PROFILES
from ladle.plans.scale import discard, global_rank, join_on, materialize, running_total, top_k_per_group, with_stats


def minmax(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """G1: (x - min) / (max - min); a constant column gives 0.5. The two global
    statistics are one scalar subquery (never a global window)."""
    x = with_stats(df, df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")), "_mm")
    return x.withColumn(out or f"{col}_norm", _norm(F.col(col), F.col("_mm.lo"), F.col("_mm.hi"))).drop("_mm")


def _norm(x: Column, lo: Column, hi: Column) -> Column:
    return F.when(hi == lo, F.lit(0.5)).otherwise((x - lo) / (hi - lo))


def _norm_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with column ``_ns``: min and max of every column in one aggregate."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")]
    return with_stats(df, df.agg(*aggs), "_ns")


def reliability_score(df: DataFrame, rating: str = "rate", sentiment: str = "avg_sentiment",
                      delay: str = "delay_risk", weights: tuple[float, float, float] | None = None,
                      out: str = "reliability_score") -> DataFrame:
    """clip(w1 norm(rating) + w2 norm(sentiment) - w3 norm(delay), 0, 1).

    All three min/max pairs come from one aggregate. A null input gives a null
    score (``greatest`` / ``least`` would otherwise skip it)."""
    w1, w2, w3 = weights or (DEFAULTS.reliability_w_rating, DEFAULTS.reliability_w_sentiment,
                             DEFAULTS.reliability_w_delay)
    x = _norm_stats(df, [rating, sentiment, delay])
    s = F.col("_ns")
    n = {c: _norm(F.col(c), s[f"{c}__lo"], s[f"{c}__hi"]) for c in (rating, sentiment, delay)}
    raw = F.lit(w1) * n[rating] + F.lit(w2) * n[sentiment] - F.lit(w3) * n[delay]
    anynull = F.col(rating).isNull() | F.col(sentiment).isNull() | F.col(delay).isNull()
    return x.withColumn(out, F.when(~anynull, F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))).drop("_ns")


def sla_analysis(df: DataFrame, actual: str = "actual_min", predicted: str = "predicted_min",
                 threshold: float | None = None) -> DataFrame:
    """One row. Positive = on time. Empty input gives zeros, not an error."""
    th = float(threshold or DEFAULTS.sla_threshold_minutes)
    al, pl = F.col(actual) > th, F.col(predicted) > th
    cnt = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")
    agg = df.agg(
        F.count(F.lit(1)).alias("total_orders"),
        cnt(~al & ~pl).alias("true_positives"), cnt(al & ~pl).alias("false_positives"),
        cnt(~al & pl).alias("false_negatives"), cnt(al & pl).alias("true_negatives"),
        cnt(al).alias("_late"), cnt(pl).alias("_plate"),
    )
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    tot = F.col("total_orders")
    rate = lambda late: F.coalesce(F.bround(F.try_divide(tot - late, tot), 4), F.lit(0.0))
    return agg.select(
        F.lit(th).alias("sla_threshold_min"), tot.alias("total_orders"),
        rate(F.col("_late")).alias("actual_on_time_rate"), rate(F.col("_plate")).alias("predicted_on_time_rate"),
        "true_positives", "false_positives", "false_negatives", "true_negatives",
        F.coalesce(F.bround(F.try_divide(tp, tp + fp), 4), F.lit(0.0)).alias("precision"),
        F.coalesce(F.bround(F.try_divide(tp, tp + fn), 4), F.lit(0.0)).alias("recall"),
    )


def _scenario_inputs(df: DataFrame, rating: str, sentiment: str, delay: str) -> DataFrame:
    cols = set(df.columns)
    return df.withColumns({
        "_r": F.coalesce(F.col(rating).cast("double"), F.lit(0.0)) if rating in cols else F.lit(0.0),
        "_s": F.coalesce(F.col(sentiment).cast("double"), F.lit(0.0)) if sentiment in cols else F.lit(0.0),
        "_d": F.coalesce(F.col(delay).cast("double"), F.lit(0.5)) if delay in cols else F.lit(0.5),
    })


def scenario_scores(df: DataFrame, profiles: Sequence[tuple] = tuple(WEIGHT_PROFILES), rating: str = "rate",
                    sentiment: str = "avg_sentiment", delay: str = "delay_risk") -> DataFrame:
    """Score of every row under every weight profile, long form
    (profile, profile_ord, <row columns>, score).

    Profiles are a short fixed list, so all scores are computed in one pass
    and unpivoted with ``explode`` — no join with a profile table at all.
    Missing inputs count as 0 / 0 / 0.5, as in the original."""
    x = _norm_stats(_scenario_inputs(df, rating, sentiment, delay), ["_r", "_s", "_d"])
    s = F.col("_ns")
    nr, ns, nd = (_norm(F.col(c), s[f"{c}__lo"], s[f"{c}__hi"]) for c in ("_r", "_s", "_d"))
    structs = [
        F.struct(F.lit(p).alias("profile"), F.lit(i).alias("profile_ord"),
                 F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(a) * nr + F.lit(b) * ns - F.lit(c) * nd)).alias("score"))
        for i, (p, a, b, c) in enumerate(profiles)
    ]
    base = [c for c in df.columns]
    return x.select(*base, F.explode(F.array(*structs)).alias("_p")).select(
        "_p.profile", "_p.profile_ord", *base, "_p.score")


def ab_scenarios(df: DataFrame, n: int = 10, id_col: str = "restaurant_id", **kw) -> tuple[DataFrame, DataFrame]:
    """(per-profile mean score, top-n rows per profile by score then id)."""
    sc = scenario_scores(df, **kw)
    means = sc.groupBy("profile", "profile_ord").agg(F.avg("score").alias("mean_score"))
    top = top_k_per_group(sc, ["profile"], [F.desc("score"), F.asc(id_col)], n)
    return means, top


def profile_overlap(top: DataFrame, name_col: str = "name") -> DataFrame:
    """Number of common names in the top lists of each profile pair."""
    t = top.select("profile", "profile_ord", F.col(name_col).alias("_nm")).distinct()
    a, b = t.alias("a"), t.alias("b")
    pairs = a.join(b, (F.col("a._nm") == F.col("b._nm")) & (F.col("a.profile_ord") < F.col("b.profile_ord")))
    # every ordered pair of profiles appears, with 0 when nothing is shared; the
    # profiles are a short fixed list, so the pair grid is built from it directly
    profs = sorted({(r["profile_ord"], r["profile"]) for r in t.select("profile", "profile_ord").distinct().collect()})
    grid = top.sparkSession.createDataFrame(
        [(a, b) for i, (_, a) in enumerate(profs) for _, b in profs[i + 1:]], "profile_a string, profile_b string")
    cnt = pairs.groupBy(F.col("a.profile").alias("profile_a"), F.col("b.profile").alias("profile_b")).agg(
        F.count(F.lit(1)).alias("overlap"))
    return grid.join(cnt, ["profile_a", "profile_b"], "left").select(
        "profile_a", "profile_b", F.coalesce("overlap", F.lit(0)).cast("bigint").alias("overlap"))


def weight_sensitivity(df: DataFrame, weightings: Sequence[tuple], id_col: str = "restaurant_id",
                       **kw) -> DataFrame:
    """Zero-based rank and score of every row under each weighting.
    Ranks come from ``global_rank`` (bucketed running count), not a global window."""
    sc = scenario_scores(df, profiles=weightings, **kw)
    r = global_rank(sc, ["profile"], "score", id_col, descending=True)
    return r.withColumn("rank", F.col("rank") - 1)


def order_sla_flags(df: DataFrame, actual: str = "actual_min", predicted: str = "predicted_min",
                    threshold: float | None = None) -> DataFrame:
    """is_at_risk (predicted > sla) and actual_late (null when the outcome is unknown)."""
    th = float(threshold or DEFAULTS.sla_threshold_minutes)
    return df.withColumns({"is_at_risk": F.col(predicted) > th, "actual_late": F.col(actual) > th})


def running_on_time_rate(df: DataFrame, keys: Sequence[str], ts: str, id_col: str,
                         late: str = "actual_late") -> DataFrame:
    """On-time % after each order, per ``keys`` in (ts, id) order.
    Unknown outcomes count as not on time, as in the original loop."""
    x = df.withColumns({"_on": F.when(F.col(late) == F.lit(False), 1).otherwise(0), "_one": F.lit(1),
                        "_t": F.unix_micros(F.col(ts).cast("timestamp"))})
    r = running_total(x, keys, "_t", ["_on", "_one"], tiebreak=[id_col])
    return r.withColumn("on_time_rate", F.col("_on_cum") * 100.0 / F.col("_one_cum")).drop(
        "_on", "_one", "_t", "_on_cum", "_one_cum")


def ops_kpis(df: DataFrame, keys: Sequence[str] = (), actual: str = "actual_min",
             predicted: str = "predicted_min") -> DataFrame:
    """Orders, on-time %, at-risk count, mean |actual - predicted|, band."""
    flags = order_sla_flags(df, actual, predicted)
    g = flags.groupBy(*keys) if keys else flags.groupBy()
    out = g.agg(
        F.count(F.lit(1)).alias("orders"),
        (F.sum(F.when(F.col("actual_late") == F.lit(False), 1).otherwise(0)) * 100.0 / F.count(F.lit(1))).alias("on_time_pct"),
        F.sum(F.when(F.col("is_at_risk"), 1).otherwise(0)).cast("bigint").alias("at_risk"),
        F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mean_abs_error"),
    )
    return out.withColumn("band", F.when(F.col("on_time_pct") > 90, "success")
                          .when(F.col("on_time_pct") < 70, "danger").otherwise("default"))


def sla_confusion(df: DataFrame, actual: str = "actual_min", predicted: str = "predicted_min",
                  threshold: float | None = None) -> DataFrame:
    """The full 2x2 (predicted_late, actual_late, orders), zeros included."""
    s = sla_analysis(df, actual, predicted, threshold)
    cells = [("false", "false", "true_positives"), ("false", "true", "false_positives"),
             ("true", "false", "false_negatives"), ("true", "true", "true_negatives")]
    arr = F.array(*[F.struct(F.lit(p == "true").alias("predicted_late"), F.lit(a == "true").alias("actual_late"),
                             F.col(c).alias("orders")) for p, a, c in cells])
    return s.select(F.explode(arr).alias("c")).select("c.*")


# ---- dispatch -----------------------------------------------------------------
#: Rows of a group that one task ranks.
GROUP_ROWS = 100_000


def rank_in_groups(df: DataFrame, keys: Sequence[str], score: str, id_col: str, rank_col: str, rows: int = GROUP_ROWS) -> DataFrame:
    """1-based rank of every row per ``keys`` by (score, id). A group of at most ``rows`` rows is ordered in a
    task; only larger ones go through ``global_rank``, whose bounds for each group and buckets cost more than sorting a small group."""
    keys = list(keys)
    large = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).drop("_n"))
    window = lambda d: d.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(score, id_col)).cast("long"))
    if not large.limit(1).count():
        discard(large)
        return window(df)
    split = global_rank(join_on(df, large, keys, "left_semi"), keys, score, id_col, descending=False, rank_col=rank_col)
    return window(join_on(df, large, keys, "left_anti")).unionByName(split.withColumn(rank_col, F.col(rank_col).cast("long")))


def assign_separable(orders: DataFrame, partners: DataFrame, group: Sequence[str], zone: str,
                     order_id: str = "order_id", time_col: str = "predicted_min",
                     partner_id: str = "partner_id", factor: str = "factor") -> DataFrame:
    """Least-total-time matching for cost = time x factor.

    By the rearrangement inequality the optimum takes the m = min(n, p)
    quickest orders of a group and pairs the slowest of them with the
    smallest factor. Orders are ranked per group and partners per zone
    (``rank_in_groups``), then joined on (zone, rank): no pairs are
    enumerated and no partner cap is needed.
    """
    group = list(group)
    o = rank_in_groups(orders, group, time_col, order_id, "_k")
    n = orders.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    p = rank_in_groups(partners, [zone], factor, partner_id, "_j")
    pc = partners.groupBy(zone).agg(F.count(F.lit(1)).alias("_p"))
    o = join_on(join_on(o, n, group), pc, [zone]).withColumn("_m", F.least("_n", "_p")).where(F.col("_k") <= F.col("_m"))
    o = o.withColumn("_j", F.col("_m") - F.col("_k") + 1)
    j = join_on(o, p.select(zone, "_j", partner_id, factor), [zone, "_j"])
    return j.select(*group, order_id, partner_id, (F.col(time_col) * F.col(factor)).alias("cost"))


def _dispatch(group: Sequence[str]):
    """Rows of a group follow one another, its partners before its orders in sequence: the heap of its
    partners' loads is all that is held of it, however many orders it has."""
    import heapq

    import pyarrow as pa

    def run(batches):
        current, heap, ids, factors = None, [], [], []
        for batch in batches:
            at, partners, costs = [], [], []
            for i, (g, order, t, partner, f) in enumerate(zip(*(batch[c].to_pylist() for c in ("_g", "order_id", "_t", "partner_id", "_f")))):
                if g != current:
                    current, heap, ids, factors = g, [], [], []
                if partner is not None:
                    heap.append((0.0, len(ids)))  # (load, index): ties go to the lowest index
                    ids.append(partner)
                    factors.append(f)
                else:
                    load, k = heap[0]
                    cost = t * factors[k]
                    heapq.heapreplace(heap, (load + cost, k))
                    at.append(i)
                    partners.append(ids[k])
                    costs.append(cost)
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*[rows[g] for g in group], rows["order_id"], pa.array(partners, pa.int64()), pa.array(costs, pa.float64())],
                                             [*group, "order_id", "partner_id", "cost"])
    return run


def assign_least_loaded(orders: DataFrame, partners: DataFrame, group: Sequence[str], zone: str,
                        seq: str = "ts", order_id: str = "order_id", time_col: str = "predicted_min",
                        partner_id: str = "partner_id") -> DataFrame:
    """Orders in sequence, each to the partner with the least total load
    (lowest partner index on ties); index = partner order by id in the zone.

    Sequential by nature inside one dispatch group, parallel across groups. A group
    only ever needs its first min(n, p) partners (with fewer orders than partners, the
    rest stay idle). Groups with a null key are groups, as in G11; an order
    without a time or an id and a partner without a factor or an id take no part.
    """
    group = list(group)
    orders = orders.where(F.col(order_id).isNotNull() & F.col(time_col).isNotNull())
    partners = partners.where(F.col(partner_id).isNotNull() & F.col("factor").isNotNull())
    p = rank_in_groups(partners, [zone], partner_id, partner_id, "_j")
    n = orders.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min(time_col).alias("_tmin"))
    pc = partners.groupBy(zone).agg(F.count(F.lit(1)).alias("_p"), F.min("factor").alias("_fmin"))
    sizes = materialize(join_on(n, pc, [zone]))
    # Fast path, exact: with positive costs and no more orders than partners,
    # every order finds an idle partner, so the k-th order (in sequence) goes
    # to the k-th partner. Only overloaded groups need the sequential loop.
    easy = (F.col("_n") <= F.col("_p")) & (F.col("_tmin") > 0) & (F.col("_fmin") > 0)
    easy_groups = sizes.where(easy).select(*group)
    hard_groups = sizes.where(~easy).select(*group, "_n", "_p")
    seq_ts = orders.withColumn("_s", F.unix_micros(F.col(seq).cast("timestamp")))
    ranked = rank_in_groups(join_on(seq_ts, easy_groups, group, "left_semi"), group, "_s", order_id, "_j")
    fast = join_on(ranked, p.select(zone, "_j", partner_id, "factor"), [zone, "_j"]).select(
        *group, F.col(order_id).cast("long").alias("order_id"), F.col(partner_id).cast("long").alias("partner_id"),
        (F.col(time_col) * F.col("factor")).alias("cost"))
    need = hard_groups.select(*group, F.explode(F.sequence(F.lit(1).cast("long"), F.least("_n", "_p").cast("long"))).alias("_j"))
    own = join_on(need, p.select(zone, F.col("_j").cast("long").alias("_j"), partner_id, "factor"), [zone, "_j"])
    none = lambda t: F.lit(None).cast(t)
    rows = own.select(*group, none("long").alias("order_id"), none("double").alias("_t"), F.col(partner_id).cast("long").alias("partner_id"),
                      F.col("factor").cast("double").alias("_f"), F.col("_j").alias("_at"))
    asked = join_on(seq_ts, hard_groups.select(*group), group, "left_semi")
    rows = rows.unionByName(asked.select(*group, F.col(order_id).cast("long").alias("order_id"), F.col(time_col).cast("double").alias("_t"),
                                         none("long").alias("partner_id"), none("double").alias("_f"), F.col("_s").alias("_at")))
    rows = rows.withColumn("_g", F.to_json(F.struct(*group), {"ignoreNullFields": "false"}))
    rows = rows.repartition("_g").sortWithinPartitions("_g", F.col("partner_id").isNull(), "_at", "order_id")
    schema = ", ".join([f"`{c}` {t}" for c, t in orders.select(*group).dtypes] + ["order_id bigint", "partner_id bigint", "cost double"])
    return fast.unionByName(rows.mapInArrow(_dispatch(group), schema))


def compare_assignment(separable: DataFrame, least_loaded: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group, optimal total (G11), naive total over all orders (the
    original's literal figure), naive total over the same orders G11 served,
    and improvement %, rounded to 1 decimal; empty -> 0. ``improvement_pct``
    compares the same orders; ``improvement_all_orders_pct`` is the original's
    literal figure, whose base also holds orders that G11 leaves unserved."""
    group = list(group)
    separable = materialize(separable.select(*group, "order_id", "cost"))  # each is read twice
    least_loaded = materialize(least_loaded.select(*group, "order_id", "cost"))
    opt = separable.groupBy(*group).agg(F.sum("cost").alias("optimized_total_min"))
    nav = least_loaded.groupBy(*group).agg(F.sum("cost").alias("naive_total_min"))
    same = join_on(least_loaded, separable.select(*group, "order_id"), [*group, "order_id"]) \
        .groupBy(*group).agg(F.sum("cost").alias("naive_same_orders_min"))
    j = join_on(join_on(nav, opt, group, "left"), same, group, "left")
    o = F.coalesce("optimized_total_min", F.lit(0.0))

    def improvement(base: str) -> Column:
        return F.bround(F.coalesce(F.try_divide((F.col(base) - o) * 100.0, F.col(base)), F.lit(0.0)), 1)
    return j.select(
        *group,
        F.bround(o, 1).alias("optimized_total_min"),
        F.bround("naive_total_min", 1).alias("naive_total_min"),
        F.bround(F.coalesce("naive_same_orders_min", F.lit(0.0)), 1).alias("naive_same_orders_min"),
        improvement("naive_same_orders_min").alias("improvement_pct"),
        improvement("naive_total_min").alias("improvement_all_orders_pct"),
    )
