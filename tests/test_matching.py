from pyspark.sql import functions as F

from ladle.operators.matching import match_requests
from ladle.operators.text_rules import contains_lookup

ROWS = [(1, "North Indian, Chinese", "Indiranagar"), (2, "Chinese", "HSR"), (3, None, "HSR"), (4, "a+b (c)", ""),
        (5, "Thai, chinese", None), (6, "", "hsr layout"), (7, "x", "Indiranagar")]
ASKS = [("k1", "CHINESE", None), ("k2", "ch", "hsr"), ("k3", None, None), ("k4", "", "HSR"), ("k5", "a+b", ""), ("k6", "zzz", "HSR"),
        ("k7", "x", "indira"), ("k8", ".", None), ("k9", "indian", "Indiranagar")]


def brute(rows, asks):
    hold = lambda text, part: not part or (text is not None and part.lower() in text.lower())
    return sorted((k, i) for k, c, a in asks for i, cs, lo in rows if hold(cs, c) and hold(lo, a))


def tables(spark, rows, asks):
    return (spark.createDataFrame(asks, "key string, cuisine string, area string"),
            spark.createDataFrame(rows, "id long, cuisines string, location string"))


def run(asks, rows, **kw):
    return match_requests(asks, "key", rows, [("cuisine", "cuisines"), ("area", "location")], "id", **kw)


def test_matches_equal_brute_force(spark):
    asks, rows = tables(spark, ROWS, ASKS)
    for salt_rows in (1, 2, 20_000):  # many salts a gram, few, one
        got = run(asks, rows, salt_rows=salt_rows)
        assert sorted((r["key"], r["id"]) for r in got.collect()) == brute(ROWS, ASKS)


def test_hot_gram_is_spread_and_no_nested_loop(spark):
    many = [(i, "Chinese" if i % 3 == 0 else f"kind{i}", "HSR") for i in range(600)]
    asks, rows = tables(spark, many, ASKS)
    got = run(asks, rows, salt_rows=20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert sorted((r["key"], r["id"]) for r in got.collect()) == brute(many, ASKS)


def test_empty_tables(spark):
    asks, rows = tables(spark, ROWS, ASKS)
    assert run(asks.limit(0), rows).count() == 0 and run(asks, rows.limit(0)).count() == 0


def test_lookup_of_short_and_long_texts(spark):
    q = spark.createDataFrame([("T",), ("ch",), ("chinese",), ("nope",), (None,), ("",)], "q string")
    t = spark.createDataFrame(ROWS, "id long, cuisines string, location string")
    got = {r["_q"]: r["id"] for r in contains_lookup(q, "q", t, "cuisines", "id").collect()}
    assert got == {"t": 1, "ch": 1, "chinese": 1, "": 1}
    assert t.where(F.col("cuisines").isNull()).count() == 1


def test_budgets_alone_meet_no_pairs_of_rows(spark):
    import random

    from ladle.operators.matching import first_within
    rng = random.Random(1)
    table = [(i, rng.choice([None, float("nan"), 0.0, -1.0, *[float(x) for x in range(0, 400, 7)]])) for i in range(3000)]
    table += [(9000 + i, 1000.0 - i) for i in range(100)]  # ever cheaper with the id: nobody's first rows rule others out
    limits = [None, 0.0, -5.0, 3.5, 1e9, *[float(x) for x in range(1, 420, 3)], *[900.0 + x for x in range(100)], 5.0, 5.0]
    want = {}
    for key, b in enumerate(limits):
        fine = [i for i, c in table if b in (None, 0.0) or (c is not None and c <= b)]
        want[key] = sorted(fine)[:5]
    df = first_within(spark.createDataFrame(list(enumerate(limits)), "key long, budget double"), "key", "budget",
                      spark.createDataFrame(table, "id long, cost double"), "cost", "id", 5)
    got = {key: [] for key in want}
    for r in df.collect():
        got[r["key"]].append(r["id"])
    assert {k: sorted(v) for k, v in got.items()} == want
    none = first_within(spark.createDataFrame([], "key long, budget double"), "key", "budget",
                        spark.createDataFrame(table, "id long, cost double"), "cost", "id", 5)
    assert none.count() == 0
