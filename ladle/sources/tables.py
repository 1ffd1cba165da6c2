"""Stored tables: schemas (A13), builders (A3, A4, A9) and the upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.config import DEFAULTS

S, D, L, B, TS = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.TimestampType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# The five stored tables, with nullability.
RESTAURANTS = _schema(
    ("restaurant_id", L, False), ("name", S, False), ("rate", D, True), ("bayesian_rating", D, True),
    ("cost_for_two", D, True), ("location", S, True), ("cuisines", S, True), ("votes", L, True),
    ("votes_log", D, True), ("online_order_binary", L, True), ("book_table_binary", L, True),
    ("cuisine_count", L, True), ("avg_sentiment", D, True), ("reliability_score", D, True),
    ("latitude", D, True), ("longitude", D, True), ("created_at", TS, False), ("updated_at", TS, False))
ORDERS = _schema(
    ("order_id", L, False), ("restaurant_id", L, True), ("user_id", L, True), ("distance_km", D, False),
    ("traffic_level", L, False), ("is_festival", B, True), ("delivery_person_age", D, True),
    ("delivery_person_rating", D, True), ("vehicle_condition", L, True), ("predicted_eta", D, False),
    ("actual_eta", D, True), ("sla_threshold", D, False), ("is_at_risk", B, True), ("actual_late", B, True),
    ("created_at", TS, False))
PREDICTIONS = _schema(
    ("prediction_id", L, False), ("model_name", S, False), ("model_version", S, True), ("input_hash", S, False),
    ("input_data", S, True), ("output_value", D, False), ("shap_values", T.MapType(S, D), True),
    ("created_at", TS, False))
EXPERIMENTS = _schema(
    ("experiment_id", L, False), ("task", S, False), ("model_name", S, False), ("mae", D, False), ("rmse", D, False),
    ("r2", D, True), ("train_time_s", D, False), ("run_id", S, True), ("is_winner", B, True),
    ("created_at", TS, False))
DRIFT_LOGS = _schema(
    ("drift_id", L, False), ("feature_name", S, False), ("ks_statistic", D, False), ("p_value", D, False),
    ("threshold", D, False), ("n_reference", L, False), ("n_batch", L, False), ("alerted", B, True),
    ("detected_at", TS, False))

SCHEMAS = {"restaurants": RESTAURANTS, "orders": ORDERS, "predictions": PREDICTIONS,
           "experiment_results": EXPERIMENTS, "drift_logs": DRIFT_LOGS}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the stored schema (missing nullable columns become null) and
    fail early when a non-nullable column is absent."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.nullable:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"missing required column {f.name}")
    return df.select(*cols)


def check_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows violating NOT NULL columns (empty when the batch conforms)."""
    cond = F.lit(False)
    for f in schema.fields:
        if not f.nullable:
            cond = cond | F.col(f.name).isNull()
    return df.where(cond)


def restaurants_frame(stored: DataFrame, cap: int | None = None) -> DataFrame:
    """A3: the 15 serving columns, ordered by name; the cap is optional."""
    cols = ["name", "rate", "bayesian_rating", "cost_for_two", "location", "cuisines", "votes", "votes_log",
            "online_order_binary", "book_table_binary", "cuisine_count", "avg_sentiment", "reliability_score",
            "latitude", "longitude"]
    out = stored.select("restaurant_id", *cols)
    return out.orderBy("name", "restaurant_id").limit(cap) if cap else out


def orders_frame(stored: DataFrame, cap: int | None = None) -> DataFrame:
    """A4: orders projected for modelling; minutes = actual else predicted, newest first."""
    out = stored.select(
        "order_id", "restaurant_id", F.col("distance_km").alias("haversine_distance_km"),
        F.col("traffic_level").alias("traffic_ordinal"), F.col("is_festival").cast("bigint").alias("is_festival"),
        "delivery_person_age", F.col("delivery_person_rating").alias("delivery_person_ratings"), "vehicle_condition",
        F.coalesce("actual_eta", "predicted_eta").alias("time_taken_min"), "created_at")
    return out.orderBy(F.desc("created_at"), F.desc("order_id")).limit(cap) if cap else out


def orders_from_deliveries(features: DataFrame, predictions: DataFrame | None = None,
                           threshold: float | None = None) -> DataFrame:
    """Delivery features -> stored orders. predicted = model prediction, else
    the actual minutes, else 30; is_at_risk = predicted > sla, actual_late =
    actual > sla (null when unknown). Predictions join on order_id."""
    th = float(threshold or DEFAULTS.sla_threshold_minutes)
    df = features
    if predictions is not None:
        df = df.join(predictions.select("order_id", F.col("prediction").alias("_pred")), "order_id", "left")
    pred = F.coalesce(*( [F.col("_pred")] if predictions is not None else []), F.col("time_taken_min"), F.lit(30.0))
    cols = set(df.columns)
    g = lambda c: F.col(c) if c in cols else F.lit(None)
    out = df.select(
        "order_id", g("restaurant_id").alias("restaurant_id"), g("user_id").alias("user_id"),
        F.coalesce(g("haversine_distance_km"), F.lit(0.0)).alias("distance_km"),
        F.coalesce(g("traffic_ordinal"), F.lit(0)).alias("traffic_level"),
        (F.coalesce(g("is_festival"), F.lit(0)) == 1).alias("is_festival"),
        g("delivery_person_age").alias("delivery_person_age"),
        g("delivery_person_ratings").alias("delivery_person_rating"),
        g("vehicle_condition").alias("vehicle_condition"),
        pred.alias("predicted_eta"), F.col("time_taken_min").alias("actual_eta"), F.lit(th).alias("sla_threshold"),
        (pred > th).alias("is_at_risk"), (F.col("time_taken_min") > th).alias("actual_late"),
        F.coalesce(g("order_ts").cast("timestamp"), F.current_timestamp()).alias("created_at"))
    return conform(out, ORDERS)


def upsert_by_name(target: DataFrame, batch: DataFrame, seq_col: str, now_col=None) -> DataFrame:
    """Merge a batch into the stored restaurants by ``name``.

    * batch rows with a null name are skipped;
    * per name and column, the latest non-null batch value wins (``seq_col``
      orders the batch; null cells never overwrite), latitude/longitude move
      as one pair;
    * matched rows keep ``created_at`` and renew ``updated_at``; new names are
      inserted with the ids that follow the current maximum, in order of a hash of the name.

    One aggregation of the batch and one full outer join with the target: no
    per-row round trips. Returns the new version of the table; write it to a
    new path and swap (A10).
    """
    now = now_col if now_col is not None else F.current_timestamp()
    b = batch.where(F.col("name").isNotNull())
    b = b.withColumn("_seq", F.col(seq_col))
    value_cols = [c for c in RESTAURANTS.fieldNames()
                  if c in b.columns and c not in ("restaurant_id", "name", "latitude", "longitude", "created_at",
                                                  "updated_at")]
    aggs = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_seq"))).alias(c) for c in value_cols]
    if "latitude" in b.columns and "longitude" in b.columns:
        pair_ok = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        aggs.append(F.max_by(F.struct("latitude", "longitude"), F.when(pair_ok, F.col("_seq"))).alias("_ll"))
    nb = b.groupBy("name").agg(*aggs)
    t = target.alias("t")
    n = nb.alias("n")
    j = t.join(n, F.col("t.name") == F.col("n.name"), "full_outer")
    from ladle.plans.scale import global_rank, one_row
    mid = one_row(target.agg(F.coalesce(F.max("restaurant_id"), F.lit(0)).alias("m")))["m"]
    sel = []
    for f in RESTAURANTS.fields:
        c = f.name
        if c == "restaurant_id":
            sel.append(F.col("t.restaurant_id").alias(c))
        elif c == "name":
            sel.append(F.coalesce(F.col("t.name"), F.col("n.name")).alias(c))
        elif c in ("latitude", "longitude"):
            if "_ll" in nb.columns:
                sel.append(F.coalesce(F.col(f"n._ll.{c}"), F.col(f"t.{c}")).alias(c))
            else:
                sel.append(F.col(f"t.{c}").alias(c))
        elif c == "created_at":
            sel.append(F.coalesce(F.col("t.created_at"), now).alias(c))
        elif c == "updated_at":
            sel.append(F.when(F.col("n.name").isNotNull(), now).otherwise(F.col("t.updated_at")).alias(c))
        elif c in value_cols:
            sel.append(F.coalesce(F.col(f"n.{c}"), F.col(f"t.{c}")).cast(f.dataType).alias(c))
        else:
            sel.append(F.col(f"t.{c}").alias(c))
    merged = j.select(*sel, F.col("t.name").isNull().alias("_new"), F.col("n.name").alias("_nn"))
    old = merged.where(~F.col("_new")).drop("_new", "_nn")
    new = merged.where(F.col("_new"))
    # ids by rank: unique, and the same on a re-run; ordered within buckets of a hash, never all in one task
    new = global_rank(new.withColumn("_o", F.xxhash64("_nn").cast("double")), [], "_o", "_nn", descending=False, rank_col="_rank", split_ties=False)
    new = new.withColumn("restaurant_id", mid + F.col("_rank")).drop("_new", "_nn", "_o", "_rank")
    return old.unionByName(new)
