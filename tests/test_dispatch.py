"""G12 with null groups, crowded groups and batches that cut a group."""
import heapq
import random

from pyspark.sql import functions as F

from ladle.operators.business import assign_least_loaded, assign_separable


def brute(orders, partners):
    out = set()
    for g in {(o[1], o[2]) for o in orders}:
        mine = sorted((i, f) for i, z, f in partners if z == g[0])
        heap = [(0.0, k) for k in range(len(mine))]
        for i, _, _, ts, t in sorted((o for o in orders if (o[1], o[2]) == g), key=lambda o: (o[3], o[0])):
            if heap:
                load, k = heapq.heappop(heap)
                cost = t * mine[k][1]
                heapq.heappush(heap, (load + cost, k))
                out.add((g[0], g[1], i, mine[k][0], round(cost, 9)))
    return out


def test_null_groups_and_crowded_groups(spark):
    r = random.Random(3)
    orders = [(i, r.choice([None, 1, 1, 1, 2, 9]), r.choice([None, "a", "a", "a", "b"]), r.randrange(50), float(r.randrange(1, 30))) for i in range(900)]
    partners = [(i, r.choice([None, 1, 2]), 0.8 + r.randrange(40) / 100) for i in range(40)]
    o = spark.createDataFrame(orders, "order_id long, zone int, w string, s int, predicted_min double").withColumn(
        "ts", F.timestamp_seconds(F.col("s") + 1_700_000_000)).repartition(4)
    p = spark.createDataFrame(partners, "partner_id long, zone int, factor double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = assign_least_loaded(o, p, ["zone", "w"], "zone").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == len({x.order_id for x in got})
    assert {(x.zone, x.w, x.order_id, x.partner_id, round(x.cost, 9)) for x in got} == brute(orders, partners)


def test_serves_the_groups_that_the_optimum_serves(spark):
    o = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, None)], "order_id long, zone int").withColumns(
        {"w": F.lit("x"), "ts": F.timestamp_seconds(F.col("order_id")), "predicted_min": F.col("order_id").cast("double")})
    p = spark.createDataFrame([(7, None, 1.0), (8, 1, 1.0)], "partner_id long, zone int, factor double")
    groups = lambda d: {(x.zone, x.w) for x in d.collect()}
    assert groups(assign_least_loaded(o, p, ["zone", "w"], "zone")) == groups(assign_separable(o, p, ["zone", "w"], "zone")) == {(None, "x"), (1, "x")}
