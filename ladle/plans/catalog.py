"""Registry of named query plans: name -> (callable(spark, sf_dir), oracle SQL or None).

Queries read the given tables (or views Spark derives from them) in full.
``finish`` gives every result a stable, comparable schema: integral types
become bigint, floating types double rounded to 6 decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)  # -0.0 -> 0.0
        elif isinstance(t, T.TimestampNTZType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # importing the modules fills REGISTRY
    from ladle.plans import (  # noqa: F401
        q_clean, q_features, q_business, q_lookup, q_drift, q_recommend, q_text, q_models, q_streaming,
        q_sentiment, q_io,
    )
    return REGISTRY
