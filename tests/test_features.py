import math

from pyspark.sql import functions as F

from ladle.functions import encode as E
from ladle.functions import geo as G
from ladle.functions import time as TM
from ladle.operators import restaurant_features as RF


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("o")).first()["o"]


def test_haversine(spark):
    assert one(spark, G.haversine_km("a", "b", "c", "d"), "a double, b double, c double, d double",
               (12.97, 77.59, 12.97, 77.59)) == 0.0
    d = one(spark, G.haversine_km("a", "b", "c", "d"), "a double, b double, c double, d double",
            (12.9352, 77.6245, 12.9758, 77.6062))
    assert 2 < d < 5


def test_city_zone(spark):
    s = "a double, b double"
    assert one(spark, G.city_zone("a", "b"), s, (12.97, 77.61)) == "central"
    assert one(spark, G.city_zone("a", "b"), s, (13.10, 77.57)) == "north"
    assert one(spark, G.city_zone("a", "b"), s, (float("nan"), 77.57)) == "unknown"
    assert one(spark, G.city_zone("a", "b"), s, (None, 77.57)) == "unknown"


def test_rush_and_cyclical(spark):
    df = spark.createDataFrame([(9,), (3,), (0,), (24,)], "h int")
    r = df.select(TM.is_rush_hour("h").alias("r"), TM.cyclical_sin("h", 24).alias("s"),
                  TM.cyclical_cos("h", 24).alias("c")).collect()
    assert [x["r"] for x in r] == [1, 0, 0, 0]
    assert math.isclose(r[2]["s"], r[3]["s"], abs_tol=1e-9) and math.isclose(r[2]["c"], r[3]["c"], abs_tol=1e-9)


def test_cost_bucket_right_closed(spark):
    df = spark.createDataFrame([(200.0,), (200.5,), (0.0,), (2000.0,), (5000.0,)], "c double")
    assert [r["b"] for r in df.select(E.cost_bucket("c").alias("b")).collect()] == \
        ["budget", "affordable", None, "premium", "luxury"]


def test_geocode_priority(spark):
    df = spark.createDataFrame([("hsr",), ("HSR Layout",), ("Near MG Road",), ("Atlantis",), ("",)], "location string")
    got = [(r["latitude"], r["longitude"]) for r in RF.geocode(df).collect()]
    assert got[0] == (12.9116, 77.6389)          # exact match of "HSR"
    assert got[1] == (12.9116, 77.6389)
    assert got[2] == (12.9758, 77.6062)          # contained
    assert got[3] == (None, None)
    assert got[4] == (12.9352, 77.6245)          # empty text hits the first centroid


def test_cuisine_flags_substring(spark):
    df = spark.createDataFrame([("South Indian, Chinese",), (None,)], "cuisines string")
    out = RF.encode_cuisines_fixed(df).collect()
    assert out[0]["cuisine_south_indian"] == 1 and out[0]["cuisine_chinese"] == 1 and out[0]["cuisine_north_indian"] == 0
    assert out[1]["cuisine_chinese"] == 0


def test_eta_minutes_rule(spark):
    from ladle.operators.text_rules import eta_minutes
    df = spark.createDataFrame([(None, None), (12.97, 77.59), (12.9352, 77.6245)], "lat double, lon double")
    got = [r["m"] for r in df.select(eta_minutes(F.col("lat"), F.col("lon")).alias("m")).collect()]
    assert got[0] == 30  # no coordinates: 5 km -> 3 * 5 + 15
    assert got[1] == 15  # at the centre: 0 km -> max(10, 15)
    assert got[2] > 15


def test_traffic_resolution_order(spark):
    from ladle.operators.traffic import resolve_traffic
    orders = spark.createDataFrame([(1, 1, 9, 1), (2, 2, 9, 1), (3, 3, 3, 6)],
                                   "event_id long, segment_id long, order_hour int, day_of_week int")
    speed = spark.createDataFrame([(1, 30.0, 100.0)], "segment_id long, current_speed double, free_flow_speed double")
    cong = spark.createDataFrame([(1, "low"), (2, "JAM")], "segment_id long, congestion_level string")
    r = {x["event_id"]: (x["traffic_level"], x["traffic_label"], x["source"])
         for x in resolve_traffic(orders, speed, cong).collect()}
    assert r[1] == (3, "Jam", "speed_feed")          # ratio 0.3: the speed feed wins over the congestion feed
    assert r[2] == (3, "Jam", "congestion_feed")
    assert r[3] == (0, "Low", "time_of_day")         # weekend 03:00
