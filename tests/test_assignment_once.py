"""Assignments that a comparison reads several times are computed once, and small groups are ranked in a task."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ladle.operators import business as B


def counted(df):
    """``df`` and an accumulator of the rows that were computed of it."""
    acc = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b
    return df.mapInArrow(run, df.schema), acc


def test_assignments_are_computed_once(spark):
    sep, n = counted(spark.createDataFrame([(1, "a", i, 2.0) for i in range(4)], "zone int, win string, order_id long, cost double"))
    ll, m = counted(spark.createDataFrame([(1, "a", i, 3.0) for i in range(6)], "zone int, win string, order_id long, cost double"))
    got = B.compare_assignment(sep, ll, ["zone", "win"]).collect()
    assert [tuple(r)[2:] for r in got] == [(8.0, 18.0, 12.0, 33.3, 55.6)]
    assert (n.value, m.value) == (4, 6)


@pytest.mark.parametrize("limit", [3, 1000])
def test_rank_in_groups(spark, limit):
    rows = [(None if i % 5 == 0 else i % 3, None if i % 7 == 0 else float(i % 4), i) for i in range(60)]
    df = spark.createDataFrame(rows, "g int, t double, id long").repartition(3)
    got = {r["id"]: r["k"] for r in B.rank_in_groups(df, ["g"], "t", "id", "k", rows=limit).collect()}
    want = df.withColumn("k", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")))
    assert got == {r["id"]: r["k"] for r in want.collect()}


def test_small_groups_have_no_bounds(spark):
    o = spark.createDataFrame([(1, "a", i, float(i)) for i in range(5)], "zone int, win string, order_id long, predicted_min double")
    p = spark.createDataFrame([(i, 1, 1.0) for i in range(3)], "partner_id long, zone int, factor double")
    plan = B.assign_separable(o, p, ["zone", "win"], "zone")._jdf.queryExecution().toString()
    assert "percentile_approx" not in plan
