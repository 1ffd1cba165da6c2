"""Read the given tables and derive the application-shaped views from them.

Each view grows with its base table (no id subsets, no caps). The same
definitions, written in portable SQL, are in ``ladle.plans.views_sql`` and
serve the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixture vocabularies (test-data definitions, not application constants).
FIXTURE_CUISINES = [
    "North Indian", "Chinese", "South Indian", "Mughlai", "Cafe", "Bakery",
    "Italian", "Fast Food", "Continental", "Desserts", "Biryani", "Street Food",
]
FIXTURE_AREAS = [
    "Koramangala", "Indiranagar", "HSR Layout", "Whitefield", "JP Nagar", "MG Road", "Jayanagar", "Atlantis",
]
FIXTURE_TRAFFIC = ["Low", "Medium", "High", "Jam", "Unknown"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], one_based_index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), one_based_index.cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def _thousandths(whole: Column) -> Column:
    """A whole number of thousandths as a double: the quotient of two whole numbers is the double
    nearest to the decimal, which decimal arithmetic also gives, at many times the cost a row."""
    return whole.cast("double") / F.lit(1000.0)


def restaurants_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    votes = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    pk, size = F.col("p_partkey"), F.col("p_size")
    return (
        part.join(votes, part.p_partkey == votes.l_partkey, "left")
        .select(
            pk.alias("restaurant_id"),
            F.concat(F.col("p_name"), F.lit(" "), _s(pk)).alias("name"),
            F.when(pk % 17 == 0, "NEW").when(pk % 19 == 0, "-")
            .when(pk % 23 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit(" "), _s(1 + size % 4), F.lit("."), _s(pk % 10), F.lit(" /5")))
            .alias("rate"),
            F.when(pk % 29 == 0, F.lit(None).cast("string"))
            .when(size % 2 == 0, _s(100 + pk % 900))
            .otherwise(F.concat(F.lit("₹"), _s(1 + size % 3), F.lit(","), F.lpad(_s(pk % 1000), 3, "0")))
            .alias("cost_text"),
            F.when(pk % 31 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(_pick(FIXTURE_CUISINES, 1 + pk % 12), F.lit(", "),
                                _pick(FIXTURE_CUISINES, 1 + size % 12)))
            .alias("cuisines"),
            _pick(FIXTURE_AREAS, 1 + pk % 8).alias("location"),
            F.when(size % 3 == 0, "Yes").when(size % 3 == 1, "No").alias("online_order"),
            F.coalesce(F.col("votes"), F.lit(0)).cast("bigint").alias("votes"),
        )
    )


def deliveries_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.select(
        eid.alias("order_id"),
        F.col("user_id"),
        F.col("ts").alias("order_ts"),
        F.when(eid % 97 == 0, "NAN").otherwise(F.concat(_s(5 + eid % 130), F.lit(" min"))).alias("time_text"),
        _thousandths(12900 + F.col("user_id") % 200).alias("restaurant_latitude"),
        _thousandths(77500 + F.col("user_id") % 250).alias("restaurant_longitude"),
        _thousandths(12900 + eid % 211).alias("delivery_latitude"),
        _thousandths(77500 + eid % 241).alias("delivery_longitude"),
        F.when(eid % 10 == 0, "Yes").when(eid % 10 == 1, F.lit(None).cast("string")).otherwise("No").alias("festival"),
        _pick(FIXTURE_TRAFFIC, 1 + eid % 5).alias("road_traffic_density"),
        (18 + eid % 40).cast("bigint").alias("courier_age"),
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    eid = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        eid.alias("order_id"),
        F.col("ts"),
        (15 + eid % 47).cast("double").alias("actual_min"),
        (15 + eid % 47 + (eid * 7) % 11 - 5).cast("double").alias("predicted_min"),
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly every line is a group of its own, so the lines that a task groups are bounded."""
    from ladle.plans.scale import spread
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        spread(li.join(od, li.l_orderkey == od.o_orderkey).select("o_custkey", "l_partkey", "l_quantity"), ["o_custkey", "l_partkey"], li)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("restaurant_id"))
        .agg(F.avg(1 + F.col("l_quantity") % 5).alias("rating"))
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    cid, t = F.col("conv_id"), F.col("turn")
    k = t % 6
    msg = (
        F.when(k == 0, F.concat(F.lit("Find "), _pick(FIXTURE_CUISINES, 1 + cid % 12), F.lit(" food in "),
                                _pick(FIXTURE_AREAS, 1 + cid % 8)))
        .when(k == 1, F.concat(F.lit("something cheap under "), _s(100 + cid % 900)))
        .when(k == 2, F.lit("How long does delivery from Truffles take?"))
        .when(k == 3, F.lit("reliability score for Truffles?"))
        .when(k == 4, F.lit("namaste"))
        .otherwise(F.col("text"))
    )
    return cv.select(cid, t, msg.alias("message"))
