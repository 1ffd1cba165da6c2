import datetime as dt

from pyspark.sql import functions as F

from ladle.sources.io import scratch_path
from ladle.streaming import ops as L


def test_late_rows_inside_the_watermark_count(spark):
    """Two micro-batches: the second carries one order 5 minutes late (inside
    the 10-minute watermark) and one 3 hours late (behind it, dropped)."""
    src = scratch_path(spark, "late-src")
    schema = "order_id long, ts timestamp_ntz, actual_min double, predicted_min double"
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    first = [(1, t0 + dt.timedelta(minutes=5), 30.0, 30.0), (2, t0 + dt.timedelta(minutes=70), 50.0, 30.0)]
    second = [(3, t0 + dt.timedelta(minutes=65), 20.0, 45.0),   # 5 minutes behind the newest: kept
              (4, t0 + dt.timedelta(minutes=190), 20.0, 20.0),  # advances the watermark
              (5, t0 + dt.timedelta(minutes=10), 90.0, 90.0)]   # its window already closed: dropped
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{src}/a")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    out_path = scratch_path(spark, "late-out")
    q = (L.stream_ops_kpis(stream).writeStream.outputMode("append").format("parquet")
         .option("path", f"{out_path}/data").option("checkpointLocation", f"{out_path}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    spark.createDataFrame(second, schema).coalesce(1).write.parquet(f"{src}/b")
    q = (L.stream_ops_kpis(stream).writeStream.outputMode("append").format("parquet")
         .option("path", f"{out_path}/data").option("checkpointLocation", f"{out_path}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["window_start"].replace(tzinfo=None): r["orders"] for r in spark.read.parquet(f"{out_path}/data").collect()}
    # after batch 1 the watermark is 11:10 - 10 min = 11:00, so the 10:00 window is
    # final and the 10:10 order (id 5) of batch 2 is behind it: dropped.
    assert got[dt.datetime(2024, 1, 1, 10, 0)] == 1
    # the 11:05 order arrives after the 11:10 one but within the watermark: counted
    assert got[dt.datetime(2024, 1, 1, 11, 0)] == 2
