"""Queries for the streaming operators (L): the events table is read as a
file stream, run over everything available and the sink read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators import delivery_features as DFT
from ladle.plans.catalog import finish, register
from ladle.plans.common import WEATHER_TEXT
from ladle.sources.io import scratch_path
from ladle.streaming import ops as L


def event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/events*.parquet")


def outcome_stream(spark, sf):
    e = event_stream(spark, sf)
    eid = F.col("event_id")
    return e.select(eid.alias("order_id"), "ts", (15 + eid % 47).cast("double").alias("actual_min"),
                    (15 + eid % 47 + (eid * 7) % 11 - 5).cast("double").alias("predicted_min"))


@register("stream_ops_kpis", """WITH o AS (SELECT ts, CAST(15 + event_id % 47 AS DOUBLE) AS a,
 CAST(15 + event_id % 47 + (event_id * 7) % 11 - 5 AS DOUBLE) AS p FROM events),
g AS (SELECT date_trunc('hour', ts) AS ws, count(*) AS orders,
 sum(CASE WHEN a > 40 THEN 0 ELSE 1 END) * 100.0 / count(*) AS pct, sum(CASE WHEN p > 40 THEN 1 ELSE 0 END) AS at_risk,
 avg(abs(a - p)) AS mae FROM o GROUP BY 1)
SELECT CAST(ws AS VARCHAR) AS window_start, CAST(orders AS BIGINT) AS orders, round(pct, 6) + 0.0 AS on_time_pct,
 CAST(at_risk AS BIGINT) AS at_risk, round(mae, 6) + 0.0 AS mean_abs_error,
 CASE WHEN pct > 90 THEN 'success' WHEN pct < 70 THEN 'danger' ELSE 'default' END AS band
FROM g WHERE ws + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def q_stream_kpis(spark, sf):
    out = L.run_to_table(L.stream_ops_kpis(outcome_stream(spark, sf)), scratch_path(spark, "stream-kpis"))
    df = spark.read.parquet(out)
    return finish(df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")))


@register("stream_score")
def q_stream_score(spark, sf):
    """L2: arriving events -> delivery features -> linear ETA model."""
    from ladle.plans.q_models import _eta_model
    e = event_stream(spark, sf)
    eid = F.col("event_id")
    d = e.select(
        eid.alias("order_id"), F.col("ts").alias("order_ts"),
        F.expr("CAST(12.90 + (user_id % 200) / 1000.0 AS DOUBLE)").alias("restaurant_latitude"),
        F.expr("CAST(77.50 + (user_id % 250) / 1000.0 AS DOUBLE)").alias("restaurant_longitude"),
        F.expr("CAST(12.90 + (event_id % 211) / 1000.0 AS DOUBLE)").alias("delivery_latitude"),
        F.expr("CAST(77.50 + (event_id % 241) / 1000.0 AS DOUBLE)").alias("delivery_longitude"),
        F.when(eid % 10 == 0, "Yes").otherwise("No").alias("festival"),
        F.element_at(F.array(*[F.lit(x) for x in ["Low", "Medium", "High", "Jam", "Unknown"]]),
                     (1 + eid % 5).cast("int")).alias("road_traffic_density"),
        (18 + eid % 40).cast("double").alias("delivery_person_age"),
        F.element_at(F.array(*[F.lit(x) for x in WEATHER_TEXT]), (1 + eid % len(WEATHER_TEXT)).cast("int")).alias("weather_conditions"))
    f = DFT.eta_contract(DFT.add_delivery_features(d, date_col="order_ts", drop_incomplete=False))
    s = L.stream_score(f, _eta_model(spark, sf)).select("order_id", "predicted_minutes", "is_at_risk")
    out = L.run_to_table(s, scratch_path(spark, "stream-score"))
    return finish(spark.read.parquet(out))


@register("stream_drift")
def q_stream_drift(spark, sf):
    """L3: per micro-batch KS against the reference, idempotent per epoch."""
    from ladle.plans.q_drift import FEATURES, reference
    e = event_stream(spark, sf).where(F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    e = e.select((F.col("value") + 5).alias("value"), F.col("user_id").cast("double").alias("user_id"),
                 F.hour("ts").cast("double").alias("hour_of_day"))
    path = scratch_path(spark, "stream-drift")
    q = (e.writeStream.foreachBatch(L.drift_sink(reference(spark, sf), FEATURES, f"{path}/logs"))
         .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return finish(spark.read.parquet(f"{path}/logs"))


@register("stream_alert_cooldown")
def q_stream_cooldown(spark, sf):
    """L4: the drift history (J) written as files, replayed as a stream
    through the keyed cooldown state."""
    from ladle.plans.q_drift import _history
    hist = _history(spark, sf).where("drifted").select("feature", "batch_id", "detected_at")
    src = scratch_path(spark, "drift-history")
    hist.write.parquet(src)
    s = spark.readStream.schema(hist.schema).parquet(src)
    out = L.run_to_table(L.stream_alert_cooldown(s), scratch_path(spark, "stream-cooldown"))
    return finish(spark.read.parquet(out))
