"""Streaming operators (L1-L4).

Each takes a streaming DataFrame and returns a streaming DataFrame (or starts
a query with an idempotent ``foreachBatch`` sink). Event time arrives as
``timestamp_ntz`` in Parquet; watermarks need ``timestamp``, so it is cast
with the session time zone (UTC).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ladle.config import DEFAULTS


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp"))


def stream_ops_kpis(orders: DataFrame, ts: str = "ts", window: str = "1 hour", delay: str = "10 minutes",
                    actual: str = "actual_min", predicted: str = "predicted_min") -> DataFrame:
    """L1: G9 per tumbling event-time window; late rows inside the watermark
    still count; a window is emitted once the watermark passes its end
    (append mode)."""
    th = DEFAULTS.sla_threshold_minutes
    o = event_time(orders, ts).withWatermark(ts, delay)
    on_time = F.when(F.col(actual) > th, 0).when(F.col(actual).isNotNull(), 1).otherwise(0)
    g = o.groupBy(F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).alias("orders"),
        (F.sum(on_time) * 100.0 / F.count(F.lit(1))).alias("on_time_pct"),
        F.sum(F.when(F.col(predicted) > th, 1).otherwise(0)).cast("bigint").alias("at_risk"),
        F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mean_abs_error"))
    return g.select(F.col("w.start").alias("window_start"), "orders", "on_time_pct", "at_risk", "mean_abs_error",
                    F.when(F.col("on_time_pct") > 90, "success").when(F.col("on_time_pct") < 70, "danger")
                    .otherwise("default").alias("band"))


def stream_score(features: DataFrame, model, threshold: float | None = None) -> DataFrame:
    """L2: stateless scoring of arriving orders with a fitted pipeline."""
    from ladle.operators.models import score_eta
    return score_eta(features, model, threshold)


def drift_sink(reference: DataFrame, cols, out_path: str, feature_order=None) -> Callable:
    """L3: a ``foreachBatch`` function running J2/J4 on each micro-batch and
    writing the drift rows under ``batch_id=<epoch>`` with dynamic partition
    overwrite, so a replayed epoch replaces its own rows (idempotent)."""
    from ladle.operators.drift import ks_test
    from ladle.plans.scale import materialize

    kept = materialize(reference.select(*cols))  # stored once, not computed again for every batch

    def run(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        batch = batch.persist()  # read for each feature
        ks = ks_test(kept, batch, cols)
        (ks.where("drifted").withColumn("epoch", F.lit(epoch))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out_path))
        batch.unpersist()
    return run


def _cooldown_state(hours: float):
    window = hours * 3600.0

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(pdfs)).sort_values("t")
        keep = []
        for t in rows["t"]:
            if last is None or (t - last) >= window:
                keep.append(True)
                last = t
            else:
                keep.append(False)
        if last is not None:
            state.update((float(last),))
        out = rows.copy()
        out["alerted"] = keep
        yield out[["feature", "batch_id", "t", "alerted"]]
    return fn


def stream_alert_cooldown(events: DataFrame, hours: float | None = None) -> DataFrame:
    """L4: J6 as keyed state per feature: the time of the last sent alert is
    the state; an alert is sent when none was sent within ``hours``.
    ``applyInPandasWithState`` keeps the state in the state store (RocksDB
    provider in our sessions), checkpointed with the query."""
    hrs = DEFAULTS.drift_alert_cooldown_hours if hours is None else hours
    e = events.select("feature", "batch_id", F.unix_seconds(F.col("detected_at").cast("timestamp")).cast("double").alias("t"))
    return e.groupBy("feature").applyInPandasWithState(
        _cooldown_state(hrs), outputStructType="feature string, batch_id string, t double, alerted boolean",
        stateStructType="last double", outputMode="append", timeoutConf=GroupStateTimeout.NoTimeout)


def run_to_table(stream: DataFrame, path: str, mode: str = "append") -> str:
    """Drive a streaming query over everything available now into Parquet."""
    q = (stream.writeStream.outputMode(mode).format("parquet").option("path", f"{path}/data")
         .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{path}/data"
