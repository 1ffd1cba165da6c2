"""Queries for drift detection (J): reference = events before 2024-01-16,
batches = later events in 6-hour windows; a shifted batch adds 5 to value."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators import drift as DR
from ladle.plans.catalog import finish, register
from ladle.sources.fixtures import table

FEATURES = ["value", "user_id", "hour_of_day"]
SPLIT = "2024-01-16 00:00:00"


def _frame(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", "ts", F.col("value"), F.col("user_id").cast("double").alias("user_id"),
                    F.hour("ts").cast("double").alias("hour_of_day"),
                    F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 21600).cast("bigint").cast("string")
                    .alias("batch_id"))


def reference(spark, sf):
    return _frame(spark, sf).where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))


def batches(spark, sf, shift: float = 0.0):
    b = _frame(spark, sf).where(F.col("ts") >= F.lit(SPLIT).cast("timestamp_ntz"))
    return b.withColumn("value", F.col("value") + F.lit(shift)) if shift else b


_BASE = f"""fr AS (SELECT value, CAST(user_id AS DOUBLE) AS user_id, CAST(hour(ts) AS DOUBLE) AS hour_of_day,
 CAST(CAST(floor(epoch(ts) / 21600) AS BIGINT) AS VARCHAR) AS batch_id, ts FROM events),
ref AS (SELECT * FROM fr WHERE ts < TIMESTAMP '{SPLIT}'),
bat AS (SELECT * FROM fr WHERE ts >= TIMESTAMP '{SPLIT}'),"""


def _lf(src: str, batch: str, shift: float = 0.0) -> str:
    v = f"value + {shift}" if shift else "value"
    return (f"SELECT 'value' AS feature, {v} AS value, {batch} AS batch_id FROM {src} UNION ALL "
            f"SELECT 'user_id', user_id, {batch} FROM {src} UNION ALL SELECT 'hour_of_day', hour_of_day, {batch} FROM {src}")


def ks_sql(batch_expr: str, shift: float = 0.0) -> str:
    return f"""WITH {_BASE}
lfr AS ({_lf('ref', 'NULL')}),
lfb AS ({_lf('bat', batch_expr, shift)}),
pairs AS (SELECT b.batch_id, r.feature, r.value, 1 AS cr, 0 AS cb FROM lfr r CROSS JOIN (SELECT DISTINCT batch_id FROM lfb) b
 UNION ALL SELECT batch_id, feature, value, 0, 1 FROM lfb),
c AS (SELECT batch_id, feature, value, sum(cr) AS cr, sum(cb) AS cb FROM pairs GROUP BY ALL),
cum AS (SELECT *, sum(cr) OVER w AS sr, sum(cb) OVER w AS sb, sum(cr) OVER (PARTITION BY batch_id, feature) AS nr,
 sum(cb) OVER (PARTITION BY batch_id, feature) AS nb FROM c
 WINDOW w AS (PARTITION BY batch_id, feature ORDER BY value ROWS UNBOUNDED PRECEDING))
SELECT batch_id, feature, round(max(abs(sr / nr - sb / nb)), 6) + 0.0 AS ks_statistic,
 CAST(max(nr) AS BIGINT) AS n_reference, CAST(max(nb) AS BIGINT) AS n_batch
FROM cum GROUP BY batch_id, feature HAVING max(nb) >= 5"""


@register("reference_stats", f"""WITH {_BASE[:-1]}
SELECT feature, round(avg(value), 6) + 0.0 AS mean, round(stddev_pop(value), 6) + 0.0 AS std,
 CAST(count(*) AS BIGINT) AS count FROM ({_lf('ref', 'NULL')}) GROUP BY feature""")
def q_reference_stats(spark, sf):
    return finish(DR.reference_stats(reference(spark, sf), FEATURES))


@register("ks_statistic", ks_sql("'batch'"))
def q_ks(spark, sf):
    return finish(DR.ks_statistics(reference(spark, sf), batches(spark, sf), FEATURES))


@register("ks_statistic_shifted", ks_sql("'batch'", 5.0))
def q_ks_shifted(spark, sf):
    return finish(DR.ks_statistics(reference(spark, sf), batches(spark, sf, 5.0), FEATURES))


@register("severity_by_batch", ks_sql("batch_id"))
def q_severity(spark, sf):
    """KS per 6-hour batch and feature against one reference."""
    return finish(DR.ks_statistics(reference(spark, sf), batches(spark, sf), FEATURES, batch_col="batch_id"))


# The p-value of the Kolmogorov limit: theta form below 1.18, alternating series above (each to the terms that matter).
_THETA = " + ".join(f"pow(q, {(2 * k - 1) ** 2})" for k in range(1, 6))
_SERIES = " ".join(f"{'+' if k % 2 else '-'} exp({-2 * k * k} * lam * lam)" for k in range(1, 12))


def ks_test_sql(tail: str) -> str:
    """``tail`` reads ks(batch_id, feature, d, n_reference, n_batch, p, drifted, o, detected_at), the shifted batches."""
    ks = ks_sql("batch_id", 5.0).replace("round(max(abs(sr / nr - sb / nb)), 6) + 0.0 AS ks_statistic", "max(abs(sr / nr - sb / nb)) AS d")
    head, select = ks.rsplit("SELECT batch_id, feature, max", 1)
    return f"""{head.rstrip()},
k0 AS (SELECT batch_id, feature, max{select}),
k1 AS (SELECT *, (sqrt(n_reference * n_batch / (n_reference + n_batch)) + 0.12 + 0.11 / sqrt(n_reference * n_batch / (n_reference + n_batch))) * d AS lam FROM k0),
k2 AS (SELECT *, CASE WHEN lam > 0 THEN exp(-pi() * pi() / (8 * lam * lam)) END AS q FROM k1),
k3 AS (SELECT *, CASE WHEN d <= 0 THEN 1.0 WHEN lam < 1.18 THEN least(1.0, greatest(0.0, 1 - sqrt(2 * pi()) / lam * ({_THETA})))
 ELSE least(1.0, greatest(0.0, 2 * (0 {_SERIES}))) END AS p FROM k2),
ks AS (SELECT batch_id, feature, d, n_reference, n_batch, p, p < 0.05 AS drifted,
 CASE feature WHEN 'value' THEN 0 WHEN 'user_id' THEN 1 ELSE 2 END AS o,
 make_timestamp((CAST(batch_id AS BIGINT) + 1) * 21600 * 1000000) AS detected_at FROM k3)
{tail}"""


_REPORT = """SELECT batch_id, CAST(count(*) AS BIGINT) AS total_features, CAST(count(*) FILTER (drifted) AS BIGINT) AS drifted_count,
 count(*) FILTER (drifted) > 0 AS has_drift, CASE WHEN count(*) FILTER (drifted) > 0
 THEN printf('🚨 **Drift Detected!** %d/%d features have drifted (p<%s). Affected: %s', count(*) FILTER (drifted), count(*), '0.05',
  array_to_string(list(feature ORDER BY o) FILTER (drifted), ', '))
 ELSE printf('✅ No significant drift detected across %d features.', count(*)) END AS message FROM ks GROUP BY batch_id"""
# an alert is sent if none was sent in the 24 hours before: followed per feature, alert by alert
_COOLED = """RECURSIVE ev AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY detected_at) AS i FROM ks WHERE drifted),
walk AS (SELECT feature, batch_id, detected_at, p, d, i, detected_at AS last, true AS alerted FROM ev WHERE i = 1
 UNION ALL SELECT e.feature, e.batch_id, e.detected_at, e.p, e.d, e.i, CASE WHEN e.detected_at - w.last >= INTERVAL 24 HOUR THEN e.detected_at ELSE w.last END,
 e.detected_at - w.last >= INTERVAL 24 HOUR FROM walk w JOIN ev e ON e.feature = w.feature AND e.i = w.i + 1)"""


def cooled_sql(tail: str) -> str:
    return ks_test_sql("").rstrip().replace("WITH fr AS", "WITH RECURSIVE fr AS", 1) + ",\n" + _COOLED.removeprefix("RECURSIVE ") + "\n" + tail


@register("ks_test", ks_test_sql("""SELECT batch_id, feature, round(d, 6) + 0.0 AS ks_statistic, n_reference, n_batch, round(p, 6) + 0.0 AS p_value, drifted,
 CAST(0.05 AS DOUBLE) AS threshold FROM ks"""))
def q_ks_test(spark, sf):
    """J2 with p-values of the Kolmogorov limit; both methods are checked in tests/test_drift.py."""
    return finish(DR.ks_test(reference(spark, sf), batches(spark, sf, 5.0), FEATURES, batch_col="batch_id"))


@register("sample_side")
def q_sample(spark, sf):
    """At most 100 values per feature by a seeded hash (sampling is the feature)."""
    return finish(DR.sample_side(reference(spark, sf), FEATURES, 100, 42, key="event_id"))


@register("drift_report", ks_test_sql(_REPORT))
def q_report(spark, sf):
    ks = DR.ks_test(reference(spark, sf), batches(spark, sf, 5.0), FEATURES, batch_col="batch_id")
    return finish(DR.drift_report(ks, FEATURES))


@register("alert_message", ks_test_sql("""SELECT batch_id, CASE WHEN count(*) FILTER (drifted) > 0
 THEN printf('🚨 *Drift Detected!*\n\n• %d/%d features drifted (p < %s)\n\n*Affected features:*', count(*) FILTER (drifted), count(*), '0.05') || chr(10)
 || array_to_string(list(printf('  • `%s` — p=%.4f, KS=%.3f', feature, p, d) ORDER BY o) FILTER (drifted), chr(10))
 || chr(10) || chr(10) || '_Recommended action: Review feature distributions and consider triggering a model retrain._'
 ELSE printf('✅ No drift detected across %d features.', count(*)) END AS message FROM ks GROUP BY batch_id"""))
def q_alert(spark, sf):
    ks = DR.ks_test(reference(spark, sf), batches(spark, sf, 5.0), FEATURES, batch_col="batch_id")
    return finish(DR.alert_message(ks, FEATURES))


def _history(spark, sf):
    ks = DR.ks_test(reference(spark, sf), batches(spark, sf, 5.0), FEATURES, batch_col="batch_id")
    t = F.timestamp_seconds((F.col("batch_id").cast("bigint") + 1) * 21600)
    return ks.withColumn("detected_at", t)


@register("apply_cooldown", cooled_sql("""SELECT feature, batch_id, strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_at,
 round(p, 6) + 0.0 AS p_value, alerted FROM walk"""))
def q_cooldown(spark, sf):
    """24-hour cooldown per feature over the drifted (batch, feature) history."""
    h = _history(spark, sf).where("drifted").select("feature", "batch_id", "detected_at", "p_value")
    return finish(DR.apply_cooldown(h).withColumn("detected_at", F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss")))


@register("log_drift", cooled_sql("""SELECT feature AS feature_name, batch_id, round(d, 6) + 0.0 AS ks_statistic, round(p, 6) + 0.0 AS p_value,
 CAST(0.05 AS DOUBLE) AS threshold, alerted, strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_at, CAST(1 AS BIGINT) AS rows_of_id FROM walk"""))
def q_log(spark, sf):
    h = _history(spark, sf)
    alerted = DR.apply_cooldown(h.where("drifted").select("feature", "batch_id", "detected_at"))
    log = DR.log_drift(h, alerted)
    ids = log.groupBy("drift_id").agg(F.count(F.lit(1)).alias("rows_of_id"))  # an id for each row
    of_batch = h.select(F.xxhash64("batch_id", "feature").alias("drift_id"), "batch_id")
    out = log.join(ids, "drift_id").join(of_batch, "drift_id").withColumn("detected_at", F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss"))
    return finish(out.drop("drift_id", "n_reference", "n_batch"))


_RETRAIN = f"""rep AS (SELECT r.*, drifted_count / total_features AS drift_fraction, t.detected_at FROM ({_REPORT}) r
 JOIN (SELECT batch_id, max(detected_at) AS detected_at FROM ks GROUP BY batch_id) t USING (batch_id)),
due AS (SELECT batch_id, detected_at, row_number() OVER (ORDER BY detected_at) AS i FROM rep WHERE has_drift AND drift_fraction >= 0.3),
fired AS (SELECT batch_id, detected_at AS last, i, true AS fire FROM due WHERE i = 1
 UNION ALL SELECT e.batch_id, CASE WHEN e.detected_at - f.last >= INTERVAL 6 HOUR THEN e.detected_at ELSE f.last END, e.i,
 e.detected_at - f.last >= INTERVAL 6 HOUR FROM fired f JOIN due e ON e.i = f.i + 1)"""


@register("retrain_decision", ks_test_sql("").rstrip().replace("WITH fr AS", "WITH RECURSIVE fr AS", 1) + ",\n" + _RETRAIN + """
SELECT batch_id, total_features, drifted_count, has_drift, message, strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_at,
 round(drift_fraction, 6) + 0.0 AS drift_fraction, coalesce(fire, false) AS retrain FROM rep LEFT JOIN fired USING (batch_id)""")
def q_retrain(spark, sf):
    h = _history(spark, sf)
    rep = DR.drift_report(h, FEATURES).join(
        h.groupBy("batch_id").agg(F.max("detected_at").alias("detected_at")), "batch_id")
    return finish(DR.retrain_decision(rep).withColumn("detected_at", F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss")))


@register("recent_drift", cooled_sql("""SELECT feature AS feature_name, round(d, 6) + 0.0 AS ks_statistic, round(p, 6) + 0.0 AS p_value,
 strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_at FROM walk WHERE alerted ORDER BY walk.detected_at DESC, feature LIMIT 10"""))
def q_recent_drift(spark, sf):
    """I12 over the drift log."""
    from ladle.operators.lookups import recent_drift
    h = _history(spark, sf)
    alerted = DR.apply_cooldown(h.where("drifted").select("feature", "batch_id", "detected_at"))
    log = recent_drift(DR.log_drift(h, alerted), 10, only_alerted=True)
    return finish(log.select("feature_name", "ks_statistic", "p_value", F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss").alias("detected_at")))


@register("drift_summary", cooled_sql("""SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (alerted) AS BIGINT) AS alerted,
 CAST(count(DISTINCT feature) AS BIGINT) AS features, strftime(max(detected_at), '%Y-%m-%d %H:%M:%S') AS last_detected_at FROM walk"""))
def q_drift_summary(spark, sf):
    """I13 over the drift log."""
    from ladle.operators.lookups import drift_summary
    h = _history(spark, sf)
    alerted = DR.apply_cooldown(h.where("drifted").select("feature", "batch_id", "detected_at"))
    return finish(drift_summary(DR.log_drift(h, alerted)).withColumn("last_detected_at", F.date_format("last_detected_at", "yyyy-MM-dd HH:mm:ss")))


@register("ks_test_sampled")
def q_ks_sampled(spark, sf):
    """J3 then J2 as the original runs them: at most 100 values per feature and
    side (seeded hash sample), KS with exact p-values on the samples."""
    ref = DR.sample_side(reference(spark, sf), FEATURES, 100, 42, key="event_id").withColumn(
        "batch_id", F.lit(None).cast("string"))
    bat = DR.sample_side(batches(spark, sf, 5.0), FEATURES, 100, 42, key="event_id").withColumn(
        "batch_id", F.lit("batch"))
    rows = ref.select("feature", "value", "batch_id").unionByName(bat.select("feature", "value", "batch_id"))
    return finish(DR.ks_test(None, None, FEATURES, long_rows=rows, method="exact"))
