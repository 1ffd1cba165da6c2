import datetime as dt

from pyspark.sql import functions as F

from ladle.operators.text_rules import validate_requests
from ladle.sources import tables as TB


def stored(spark):
    ts = dt.datetime(2024, 1, 1)
    rows = [(1, "Alpha", 4.0, 300.0, "Cafe", 10, 12.9, 77.6, ts, ts), (2, "Beta", 3.5, 500.0, "Thai", 5, None, None, ts, ts)]
    df = spark.createDataFrame(rows, "restaurant_id long, name string, rate double, cost_for_two double, cuisines string, "
                                     "votes long, latitude double, longitude double, created_at timestamp, updated_at timestamp")
    return TB.conform(df, TB.RESTAURANTS)


def test_upsert_rules(spark):
    now = dt.datetime(2024, 3, 1)
    batch = spark.createDataFrame([
        ("Alpha", None, 11, None, 13.0, None, 1),      # null cuisines and half a coordinate pair never overwrite
        ("Alpha", "Bakery", None, None, None, None, 2),  # later non-null cuisines wins, votes from seq 1 stay
        ("Gamma", "Goan", 1, 100.0, 12.5, 77.5, 1),    # a new name is inserted
        (None, "X", 99, None, None, None, 1),          # a null name is skipped
    ], "name string, cuisines string, votes long, cost_for_two double, latitude double, longitude double, seq int")
    out = {r["name"]: r for r in TB.upsert_by_name(stored(spark), batch, "seq", F.lit(now)).collect()}
    assert set(out) == {"Alpha", "Beta", "Gamma"}
    a = out["Alpha"]
    assert a["cuisines"] == "Bakery" and a["votes"] == 11 and a["cost_for_two"] == 300.0
    assert (a["latitude"], a["longitude"]) == (12.9, 77.6)
    assert a["created_at"] == dt.datetime(2024, 1, 1) and a["updated_at"] == now
    assert out["Beta"]["updated_at"] == dt.datetime(2024, 1, 1)
    g = out["Gamma"]
    assert g["restaurant_id"] == 3 and g["created_at"] == now and (g["latitude"], g["longitude"]) == (12.5, 77.5)


def test_validate_requests(spark):
    df = spark.createDataFrame([(1, 5.0, 1, 30.0), (2, 0.0, 4, 30.0), (3, None, 1, 10.0)],
                               "request_id long, distance_km double, traffic_level int, delivery_person_age double")
    v = {r["request_id"]: (r["valid"], r["reasons"]) for r in validate_requests(df).collect()}
    assert v[1] == (True, [])
    assert v[2][0] is False and len(v[2][1]) == 2
    assert v[3][0] is False and len(v[3][1]) == 2  # missing distance and age under 18
