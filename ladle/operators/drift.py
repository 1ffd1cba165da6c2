"""Drift detection and alerting.

The two-sample KS statistic is computed exactly and linearly for any number
of batches against one reference:

* reference and batch values are unioned per feature (no copy of the
  reference per batch);
* a bucketed running total (``running_total``) gives, at every batch value v,
  the reference ECDF both inclusive F_r(v) and exclusive F_r(v-);
* per (feature, batch) running totals give the batch ECDF F_b(v);
* between two consecutive batch points F_b is flat and F_r rises, so
  sup |F_r - F_b| = max over batch points of
  max(|F_r(v) - F_b(v)|, |F_r(v-) - F_b(v_prev)|).

The p-value of each (feature, batch) row is a small pandas UDF: the Kolmogorov
limit, or on request the exact lattice-path probability (for samples).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.config import DEFAULTS
from ladle.plans.scale import long_form, materialize, running_total


def reference_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per numeric column: mean, population std, non-null count."""
    lf = long_form(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return lf.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                     F.count(F.lit(1)).alias("count"))


def sample_side(df: DataFrame, cols: Sequence[str], n: int | None = None, seed: int | None = None,
                key: str | None = None) -> DataFrame:
    """At most ``n`` values per feature, chosen by a seeded hash (stable
    under re-execution). The top-n per feature uses the salted two-round
    top-k, so a large side is never ranked inside one task."""
    from ladle.plans.scale import top_k_per_group
    n = n or DEFAULTS.drift_feature_sample
    seed = DEFAULTS.random_seed if seed is None else seed
    keep = [key] if key else []
    lf = long_form(df, cols, keep=keep).where(F.col("value").isNotNull() & ~F.isnan("value"))
    ident = [F.col(key)] if key else [F.col("value")]
    lf = lf.withColumn("_h", F.xxhash64(F.lit(seed), F.col("feature"), *ident))
    return top_k_per_group(lf, ["feature"], [F.col("_h"), F.col("value")], n).drop("_h", "rank")


def _sides(reference: DataFrame, batches: DataFrame, cols: Sequence[str], batch_col: str | None) -> DataFrame:
    ref = long_form(reference, cols).withColumn("batch_id", F.lit(None).cast("string"))
    keep = [batch_col] if batch_col else []
    bat = long_form(batches, cols, keep=keep)
    bat = bat.withColumn("batch_id", F.col(batch_col).cast("string") if batch_col else F.lit("batch"))
    if batch_col and batch_col != "batch_id":
        bat = bat.drop(batch_col)
    both = ref.unionByName(bat.select("feature", "value", "batch_id"))
    return both.where(F.col("value").isNotNull() & ~F.isnan("value"))


def ks_statistics(reference: DataFrame, batches: DataFrame, cols: Sequence[str], batch_col: str | None = None,
                  min_batch: int = 5) -> DataFrame:
    """Exact two-sample KS statistic per (batch_id, feature), with
    n_reference and n_batch. Features with fewer than ``min_batch`` batch
    values are skipped."""
    return ks_statistics_long(_sides(reference, batches, cols, batch_col), min_batch)


def ks_statistics_long(x: DataFrame, min_batch: int = 5) -> DataFrame:
    """KS statistics from long rows (feature, value, batch_id); a null
    batch_id marks reference rows."""
    is_ref = F.col("batch_id").isNull()
    # one row per (feature, value, side): duplicates collapse map-side
    agg = x.groupBy("feature", "value", "batch_id").agg(F.count(F.lit(1)).alias("c"))
    agg = agg.withColumns({"c_ref": F.when(is_ref, F.col("c")).otherwise(0),
                           "c_bat": F.when(is_ref, 0).otherwise(F.col("c")),
                           # at equal values reference rows sort first: inclusive reference ECDF
                           "_side": F.when(is_ref, 0).otherwise(1)})
    agg = materialize(agg)  # read by five statistics below: the values are counted once
    r = running_total(agg, ["feature"], "value", ["c_ref"], tiebreak=["_side", "batch_id"])
    n_ref = agg.where(is_ref).groupBy("feature").agg(F.sum("c").alias("n_reference"))
    b = r.where(~is_ref).join(agg.where(is_ref).select("feature", "value", F.col("c").alias("_cr_at")),
                               ["feature", "value"], "left")
    b = materialize(b.withColumn("_ref_excl", F.col("c_ref_cum") - F.coalesce("_cr_at", F.lit(0))))
    b = running_total(b, ["feature", "batch_id"], "value", ["c_bat"])
    n_bat = agg.where(~is_ref).groupBy("feature", "batch_id").agg(F.sum("c").alias("n_batch"))
    b = b.join(n_ref, "feature").join(n_bat, ["feature", "batch_id"])
    fr_in = F.col("c_ref_cum") / F.col("n_reference")
    fr_ex = F.col("_ref_excl") / F.col("n_reference")
    fb = F.col("c_bat_cum") / F.col("n_batch")
    fb_prev = (F.col("c_bat_cum") - F.col("c_bat")) / F.col("n_batch")
    b = b.withColumn("_d", F.greatest(F.abs(fr_in - fb), F.abs(fr_ex - fb_prev)))
    out = b.groupBy("batch_id", "feature").agg(
        F.max("_d").alias("ks_statistic"), F.first("n_reference").alias("n_reference"),
        F.first("n_batch").alias("n_batch"))
    return out.where(F.col("n_batch") >= min_batch)


# ---- p-value ------------------------------------------------------------------
def _ks_p_exact(n1: int, n2: int, d: float) -> float:
    """P(D >= d) for two independent samples of sizes n1, n2 under H0, by
    summing the probability of monotone lattice paths that stay strictly
    inside the band |i/n1 - j/n2| < d (Hodges 1957), one anti-diagonal at a
    time (each diagonal is a vector operation)."""
    if n1 > n2:
        n1, n2 = n2, n1
    g = math.gcd(n1, n2)
    lcm = n1 // g * n2
    h = int(math.ceil(d * lcm - 1e-7))  # D is a multiple of 1/lcm
    if h == 0:
        return 1.0
    a, b = lcm // n1, lcm // n2  # step sizes in lcm units
    N = n1 + n2
    prev = np.ones(1)
    plo = 0  # smallest i held by prev
    for k in range(1, N + 1):
        lo, hi = max(0, k - n2), min(k, n1)
        i = np.arange(lo, hi + 1)
        j = k - i
        rem = float(N - (k - 1))
        cur = np.zeros(hi - lo + 1)
        phi = plo + len(prev) - 1
        # step in sample 1: from (i-1, j), valid for i-1 in [plo, phi]
        s_lo, s_hi = max(lo, plo + 1), min(hi, phi + 1)
        if s_lo <= s_hi:
            ii = i[s_lo - lo:s_hi - lo + 1]
            cur[s_lo - lo:s_hi - lo + 1] += prev[s_lo - 1 - plo:s_hi - plo] * ((n1 - ii + 1) / rem)
        # step in sample 2: from (i, j-1), valid for i in [plo, phi] and j >= 1
        s_lo, s_hi = max(lo, plo), min(hi, phi, k - 1)
        if s_lo <= s_hi:
            jj = j[s_lo - lo:s_hi - lo + 1]
            cur[s_lo - lo:s_hi - lo + 1] += prev[s_lo - plo:s_hi - plo + 1] * ((n2 - jj + 1) / rem)
        cur[np.abs(i * a - j * b) >= h] = 0.0
        prev, plo = cur, lo
    return float(min(1.0, max(0.0, 1.0 - prev[-1])))


def kolmogorov_sf(lam: float) -> float:
    """P(K > lam) of the Kolmogorov distribution. The alternating series needs
    few terms for large ``lam`` and does not settle for small ones, where its
    theta-function dual does; the two meet near 1."""
    if lam <= 0:
        return 1.0
    if lam < 1.18:
        q = math.exp(-(math.pi ** 2) / (8 * lam * lam))
        cdf = math.sqrt(2 * math.pi) / lam * sum(q ** ((2 * k - 1) ** 2) for k in range(1, 6))
        return min(1.0, max(0.0, 1.0 - cdf))
    return min(1.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 12)))


def _ks_p_asymptotic(n1: int, n2: int, d: float) -> float:
    en = math.sqrt(n1 * n2 / (n1 + n2))
    return kolmogorov_sf((en + 0.12 + 0.11 / en) * d)


def ks_p_value(n1: int, n2: int, d: float, method: str = "asymptotic") -> float:
    """``method``: "exact" (lattice paths; time grows with n1 + n2 and the band,
    for samples) or "asymptotic" (the limit with Stephens' correction, for any size)."""
    if d <= 0:
        return 1.0
    p = {"exact": _ks_p_exact, "asymptotic": _ks_p_asymptotic}[method]
    return p(int(n1), int(n2), float(d))


def _p_values(method: str):
    def run(n1: pd.Series, n2: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([ks_p_value(a, b, c, method) for a, b, c in zip(n1, n2, d)], dtype="float64")
    return run


def _p_udf(method: str, *cols):
    # built on use: Python workers import this module without a session
    return F.pandas_udf(_p_values(method), "double")(*cols)


def ks_test(reference: DataFrame, batches: DataFrame, cols: Sequence[str], batch_col: str | None = None,
            threshold: float | None = None, long_rows: DataFrame | None = None, method: str = "asymptotic") -> DataFrame:
    """J2 with p-values: one row per (batch_id, feature) with ks_statistic,
    p_value, drifted (p < threshold). ``long_rows`` (feature, value,
    batch_id) may be given instead of the two wide frames; ``method`` as in
    ``ks_p_value``, the same for every row."""
    th = threshold or DEFAULTS.drift_ks_threshold
    s = ks_statistics_long(long_rows) if long_rows is not None else ks_statistics(reference, batches, cols, batch_col)
    # one row per (batch, feature): spread them round-robin so the exact
    # p-values use all cores (a keyed repartition would be dropped, the rows
    # already being partitioned by those keys, and AQE would coalesce it)
    s = s.repartition(s.sparkSession.sparkContext.defaultParallelism)
    return s.withColumn("p_value", _p_udf(method, "n_reference", "n_batch", "ks_statistic")).withColumn(
        "drifted", F.col("p_value") < F.lit(th)).withColumn("threshold", F.lit(float(th)))


def drift_report(ks: DataFrame, feature_order: Sequence[str]) -> DataFrame:
    """Per batch: total features, drifted count, has_drift and the summary
    message naming the first five drifted features (in feature order)."""
    ordm = F.create_map(*[x for i, c in enumerate(feature_order) for x in (F.lit(c), F.lit(i))])
    k = ks.withColumn("_o", ordm[F.col("feature")])
    agg = k.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_features"),
        F.count_if("drifted").alias("drifted_count"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.struct("_o", "feature")))).alias("_d"),
        F.first("threshold").alias("threshold"),
    )
    names = F.transform(F.slice(F.col("_d"), 1, 5), lambda s: s["feature"])
    th = F.format_number(F.col("threshold"), 2)
    msg = F.when(
        F.col("drifted_count") > 0,
        F.format_string("🚨 **Drift Detected!** %d/%d features have drifted (p<%s). Affected: %s",
                        F.col("drifted_count"), F.col("total_features"), th, F.array_join(names, ", ")),
    ).otherwise(F.format_string("✅ No significant drift detected across %d features.", F.col("total_features")))
    return agg.select("batch_id", "total_features", "drifted_count", (F.col("drifted_count") > 0).alias("has_drift"),
                      msg.alias("message"))


def alert_message(ks: DataFrame, feature_order: Sequence[str]) -> DataFrame:
    """The alert text per batch, one line per drifted feature."""
    ordm = F.create_map(*[x for i, c in enumerate(feature_order) for x in (F.lit(c), F.lit(i))])
    k = ks.withColumn("_o", ordm[F.col("feature")])
    line = F.format_string("  • `%s` — p=%.4f, KS=%.3f", F.col("feature"), F.col("p_value"), F.col("ks_statistic"))
    agg = k.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("drifted").alias("n"), F.first("threshold").alias("th"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.struct("_o", line.alias("l"))))).alias("_l"))
    body = F.array_join(F.transform("_l", lambda s: s["l"]), "\n")
    head = F.format_string("🚨 *Drift Detected!*\n\n• %d/%d features drifted (p < %s)\n\n*Affected features:*",
                           F.col("n"), F.col("total"), F.col("th").cast("string"))
    tail = F.lit("\n\n_Recommended action: Review feature distributions and consider triggering a model retrain._")
    msg = F.when(F.col("n") > 0, F.concat(head, F.lit("\n"), body, tail)).otherwise(
        F.format_string("✅ No drift detected across %d features.", F.col("total")))
    return agg.select("batch_id", msg.alias("message"))


def _cooldown_group(pdf: pd.DataFrame, hours: float, ts: str) -> pd.DataFrame:
    pdf = pdf.sort_values(ts, kind="mergesort")
    keep, last = [], None
    window = pd.Timedelta(hours=hours)
    for t in pdf[ts]:
        if last is None or (t - last) >= window:
            keep.append(True)
            last = t
        else:
            keep.append(False)
    pdf = pdf.copy()
    pdf["alerted"] = keep
    return pdf


def apply_cooldown(events: DataFrame, key: str = "feature", ts: str = "detected_at",
                   hours: float | None = None) -> DataFrame:
    """J6 (history form): mark each alert event per key as sent unless an
    earlier sent alert lies within ``hours``; a sent alert restarts the window.

    The rule is sequential inside a key, parallel across keys
    (``applyInPandas``); one key holds one row per batch, so its size is the
    number of batches, not the data volume."""
    hrs = DEFAULTS.drift_alert_cooldown_hours if hours is None else hours
    schema = ", ".join(f"`{c}` {t}" for c, t in events.dtypes) + ", alerted boolean"
    return events.groupBy(key).applyInPandas(lambda p: _cooldown_group(p, hrs, ts), schema)


def log_drift(ks: DataFrame, alerted: DataFrame | None = None, detected_at: str = "detected_at") -> DataFrame:
    """One drift_logs row per drifted (batch, feature) with the true counts."""
    d = ks.where("drifted")
    if alerted is not None:
        d = d.join(alerted.select("batch_id", "feature", "alerted"), ["batch_id", "feature"], "left")
    else:
        d = d.withColumn("alerted", F.lit(False))
    return d.select(
        F.xxhash64("batch_id", "feature").alias("drift_id"), F.col("feature").alias("feature_name"), "ks_statistic",
        "p_value", "threshold", "n_reference", "n_batch", F.coalesce("alerted", F.lit(False)).alias("alerted"),
        F.col(detected_at) if detected_at in d.columns else F.current_timestamp().alias("detected_at"))


def retrain_decision(reports: DataFrame, ts: str = "detected_at", fraction: float | None = None,
                     hours: float | None = None, source: str | None = None) -> DataFrame:
    """A retrain is due when drifted / total >= fraction (0.3) and no
    retrain was triggered within ``hours`` (6); zero features never trigger.

    With ``source`` (a column that names a model or a stream) each source has its own
    cooldown and its own task; a null source is one too. Without it all reports are of one model."""
    fr = DEFAULTS.retrain_drift_fraction if fraction is None else fraction
    hrs = DEFAULTS.retrain_cooldown_hours if hours is None else hours
    r = reports.withColumn("drift_fraction", F.try_divide(F.col("drifted_count"), F.col("total_features")))
    cand = r.withColumn("_eligible", F.col("has_drift") & (F.col("total_features") > 0)
                        & (F.col("drift_fraction") >= F.lit(fr))).withColumn(
        "_k", F.to_json(F.struct(F.col(f"`{source}`").alias("k"))) if source else F.lit("retrain"))
    elig = cand.where("_eligible")
    fired = apply_cooldown(elig.select("_k", "batch_id", ts), key="_k", ts=ts, hours=hrs)
    return cand.join(fired.select("_k", "batch_id", F.col("alerted").alias("retrain")), ["_k", "batch_id"], "left").select(
        *reports.columns, "drift_fraction", F.coalesce("retrain", F.lit(False)).alias("retrain"))
