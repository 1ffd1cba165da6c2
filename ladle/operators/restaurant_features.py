"""Restaurant features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.dims import CENTROIDS, CUISINES
from ladle.functions.encode import cost_bucket, cuisine_count, votes_log, yes_no_flag


def cuisine_column(name: str) -> str:
    return "cuisine_" + name.lower().replace(" ", "_")


def top_cuisines(df: DataFrame, n: int = 30, col: str = "cuisines") -> DataFrame:
    """Split on ',', trim, count, top n (ties broken by name)."""
    parts = df.select(F.explode(F.split(F.col(col), ",")).alias("c")).select(F.trim("c").alias("cuisine"))
    return (
        parts.groupBy("cuisine").agg(F.count(F.lit(1)).alias("n_restaurants"))
        .orderBy(F.desc("n_restaurants"), F.asc("cuisine"))
        .limit(n)
    )


def _cuisine_flags(names: Sequence[str], col: str = "cuisines") -> dict:
    # case-insensitive search over the whole text; names are no patterns
    return {
        cuisine_column(nm): F.coalesce(F.lower(F.col(col)).contains(nm.lower()), F.lit(False)).cast("bigint")
        for nm in names
    }


def encode_cuisines(df: DataFrame, n: int = 30, col: str = "cuisines") -> DataFrame:
    """0/1 column per top-n cuisine. The n names are a bounded driver list."""
    if col not in df.columns:
        return df
    names = [r["cuisine"] for r in top_cuisines(df, n, col).collect()]
    return df.withColumns(_cuisine_flags(names, col))


def encode_cuisines_fixed(df: DataFrame, col: str = "cuisines") -> DataFrame:
    """Same over the 30 canonical names (no job at plan time)."""
    return df.withColumns(_cuisine_flags(CUISINES, col)) if col in df.columns else df


def add_restaurant_features(df: DataFrame, n: int = 30, fixed: bool = False) -> DataFrame:
    """C4-C7 plus cuisine flags, each guarded by column presence."""
    cols = set(df.columns)
    new = {}
    if "cost_for_two" in cols:
        new["cost_for_two_bucket"] = cost_bucket("cost_for_two")
    if "cuisines" in cols:
        new["cuisine_count"] = cuisine_count("cuisines")
    if "online_order" in cols:
        new["online_order_binary"] = yes_no_flag("online_order")
    if "book_table" in cols:
        new["book_table_binary"] = yes_no_flag("book_table")
    if "votes" in cols:
        new["votes_log"] = votes_log("votes")
    out = df.withColumns(new) if new else df
    return encode_cuisines_fixed(out) if fixed else encode_cuisines(out, n)


RATING_BASE_FEATURES = ["cost_for_two", "votes_log", "online_order_binary", "book_table_binary",
                        "cuisine_count", "avg_sentiment"]


def rating_feature_cols(df: DataFrame) -> list[str]:
    """All cuisine_* plus the six named columns that exist (unique, ordered)."""
    cols = [c for c in df.columns if c.startswith("cuisine_") and c != "cuisine_count"]
    cols += [c for c in RATING_BASE_FEATURES if c in df.columns]
    return list(dict.fromkeys(cols))


def rating_features(df: DataFrame) -> DataFrame:
    cols = rating_feature_cols(df)
    return df.na.fill(0, subset=cols)


def geocode_expr(col) -> "F.Column":
    """Centroid (struct latitude, longitude) for an area text, or null.

    Exact case-insensitive match first, else the first centroid in list order
    that is contained in, or contains, the text. With 20 fixed areas this is a
    pure projection: no join, no shuffle, whole-stage codegen.
    """
    c = F.col(col) if isinstance(col, str) else col
    loc = F.lower(F.trim(c))
    pt = lambda la, lo: F.struct(F.lit(la).alias("latitude"), F.lit(lo).alias("longitude"))
    expr = None
    rules = [(loc == F.lit(a.lower()), la, lo) for a, la, lo in CENTROIDS]
    rules += [(loc.contains(F.lit(a.lower())) | F.lit(a.lower()).contains(loc), la, lo) for a, la, lo in CENTROIDS]
    for cond, la, lo in rules:
        expr = F.when(cond, pt(la, lo)) if expr is None else expr.when(cond, pt(la, lo))
    return expr


def geocode(df: DataFrame, col: str = "location") -> DataFrame:
    """Add latitude / longitude of the matched area centroid."""
    g = geocode_expr(col)
    return df.withColumns({"latitude": g["latitude"], "longitude": g["longitude"]})
