from pyspark.sql import functions as F

from ladle.functions.parse import parse_cost, parse_minutes, parse_rating
from ladle.operators import clean as C


def col(spark, values, t="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {t}")


def vals(df, c="out"):
    return [r[c] for r in df.orderBy("i").collect()]


def test_parse_rating(spark):
    df = col(spark, ["4.1/5", "3.5/5", "5.0/5", "NEW", "-", None, "  4.1 / 5  "])
    assert vals(df.select("i", parse_rating("v").alias("out"))) == [4.1, 3.5, 5.0, None, None, None, 4.1]


def test_parse_cost(spark):
    df = col(spark, ["1,200", "₹1,500", "abc", "", "1d", "nan"])
    assert vals(df.select("i", parse_cost("v").alias("out"))) == [1200.0, 1500.0, None, None, None, None]


def test_parse_minutes(spark):
    df = col(spark, ["25 min", "(min) 30", "NAN", None])
    assert vals(df.select("i", parse_minutes("v").alias("out"))) == [25.0, 30.0, None, None]


def test_dedupe_drop_normalize(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", None)], "`Online Order` string, rate double")
    assert C.dedupe_rows(df).count() == 2
    assert C.drop_missing_target(df, "rate").count() == 2
    assert C.normalize_columns(df).columns == ["online_order", "rate"]


def test_geo_and_duration_filters(spark):
    df = spark.createDataFrame([(12.9, 77.6, 25.0), (999.0, 77.6, 30.0), (None, 77.6, 20.0), (12.9, 77.6, 150.0)],
                               "restaurant_latitude double, restaurant_longitude double, time_taken_min double")
    g = C.filter_geo_range(df)
    assert g.count() == 3  # 999 dropped, null passes
    assert C.filter_duration(g).count() == 2  # 150 dropped


def test_mode_ties_smallest_and_median(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("a", 3.0), ("b", 10.0), (None, None)], "s string, x double")
    out = C.fill_median(C.fill_mode(df)).collect()
    last = [r for r in out if r["s"] is not None and r["x"] == 2.5]
    assert len(last) == 1 and last[0]["s"] == "a"  # tie a/b -> smallest; median of 1,2,3,10 = 2.5


def test_all_null_string_becomes_unknown(spark):
    df = spark.createDataFrame([(None,), (None,)], "s string")
    assert {r["s"] for r in C.fill_mode(df).collect()} == {"Unknown"}


def test_clean_restaurants_shape(spark, sf):
    from ladle.sources.fixtures import restaurants_raw
    r = C.clean_restaurants(restaurants_raw(spark, sf))
    assert "cost_for_two" in r.columns
    assert r.where(F.col("rate").isNull() | F.col("cost_for_two").isNull() | F.col("cuisines").isNull()).count() == 0


def test_texts_are_parsed_once_and_after_the_duplicates(spark):
    from ladle.operators.clean import clean_deliveries, dedupe_rows, drop_missing_target  # noqa: F401
    raw = spark.createDataFrame([(1, "25 min", 12.9, "No"), (1, "25 min", 12.9, "No"), (2, None, 12.9, None), (3, "500 min", 12.9, "x")],
                                "order_id long, time_text string, restaurant_latitude double, festival string")
    out = clean_deliveries(raw, checkpoint=False)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and plan[plan.rindex("Aggregate"):].count("RLIKE") == 0  # no filter on parsed text below the duplicates
    assert [tuple(r) for r in out.collect()] == [(1, 25.0, 12.9, "No")]


def test_thousandths_are_the_decimals(spark):
    from pyspark.sql import functions as F

    from ladle.sources.fixtures import _thousandths
    x = spark.range(-300, 300).select(_thousandths(12900 + F.col("id") % 250).alias("a"), _thousandths(77500 + F.col("id") % 250).alias("c"),
                                      F.expr("CAST(12.90 + (id % 250) / 1000.0 AS DOUBLE)").alias("b"),
                                      F.expr("CAST(77.50 + (id % 250) / 1000.0 AS DOUBLE)").alias("d"))
    assert x.where("a <> b OR c <> d").count() == 0
