"""File sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESTAURANT_CSV_COLUMNS = ["name", "rate", "approx_cost(for two people)", "cuisines", "location", "votes",
                          "online_order", "book_table", "reviews_list"]
DELIVERY_CSV_COLUMNS = ["ID", "Delivery_person_ID", "Delivery_person_Age", "Delivery_person_Ratings",
                        "Restaurant_latitude", "Restaurant_longitude", "Delivery_location_latitude",
                        "Delivery_location_longitude", "Type_of_order", "Type_of_vehicle", "Time_taken(min)",
                        "order_date", "Festival", "City", "Road_traffic_density", "Weather_conditions"]


def all_string(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Header CSV with every column as text (typed later by the parse
    operators); multi-line quoted fields allowed (reviews hold newlines). A
    missing path is an error, as in the original loader."""
    r = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
         .option("mode", "PERMISSIVE"))
    if columns is not None:
        r = r.schema(all_string(columns))
    else:
        r = r.option("inferSchema", False)
    return r.csv(path)


def read_restaurants(spark: SparkSession, path: str) -> DataFrame:
    """A1."""
    return read_csv(spark, path)


def read_deliveries(spark: SparkSession, path: str) -> DataFrame:
    """A2."""
    return read_csv(spark, path)


def read_with_fallback(primary: DataFrame, secondary) -> DataFrame:
    """A5: the stored table if it has rows, else the file source (``secondary``
    is a DataFrame or a zero-argument callable that builds one). One cheap
    ``isEmpty`` probe decides which plan to run."""
    if not primary.isEmpty():
        return primary
    return secondary() if callable(secondary) else secondary


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, null count, distinct-row duplicates of the table,
    and the row count, as a long table from a single aggregate pass (plus one
    distinct count for duplicates)."""
    n = F.count(F.lit(1))
    aggs = [n.alias("_rows")] + [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}")
                                 for i, c in enumerate(df.columns)]
    stats = df.agg(*aggs)
    dup = df.distinct().agg(F.count(F.lit(1)).alias("_distinct"))
    from ladle.plans.scale import one_row
    d = one_row(dup)["_distinct"]
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"_null_{i}").alias("nulls"))
                    for i, (c, t) in enumerate(df.dtypes)])
    return stats.select(F.col("_rows").alias("rows"), (F.col("_rows") - d).alias("duplicate_rows"),
                        F.explode(arr).alias("c")).select("c.column", "c.type", "c.nulls", "rows", "duplicate_rows")


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows as read (a short look; any n rows would do)."""
    return df.limit(n)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None) -> str:
    """Write a processed or result table (parquet, csv or json)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = (w.option("header", True).option("ignoreLeadingWhiteSpace", False)
             .option("ignoreTrailingWhiteSpace", False).option("escape", '"'))
    w.format(fmt).save(path)
    return path


def replace_all(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """A10: write every table to a fresh versioned folder; the caller swaps the
    pointer (returned paths) only after all writes succeed, so readers never
    see a half-replaced set."""
    version = uuid.uuid4().hex[:12]
    out = {}
    for name, df in tables.items():
        out[name] = write_table(df, f"{root.rstrip('/')}/{name}/v={version}")
    return out


def write_report_json(df: DataFrame, path: str) -> str:
    """A nested report (structs / arrays) as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local)."""
    from ladle.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/ladle-io/{name}-{uuid.uuid4().hex[:8]}"
