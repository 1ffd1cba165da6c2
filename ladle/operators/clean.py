"""Cleaning operators (B1-B13): projections, filters and null filling."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.parse import parse_cost, parse_minutes, parse_rating
from ladle.plans.scale import computed_once, exact_quantiles, materialize, with_stats

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL both mean missing upstream; keep only NULL from here on."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return computed_once(df, {c: F.when(~F.isnan(c), F.col(c)) for c in fl}) if fl else df


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Exact full-row duplicates removed (nulls compare equal)."""
    return df.distinct()


def drop_missing_target(df: DataFrame, col: str) -> DataFrame:
    """B4."""
    return df.na.drop(subset=[col])


def trim_strings(df: DataFrame) -> DataFrame:
    """B8."""
    cols = string_columns(df)
    return df.withColumns({c: F.trim(c) for c in cols}) if cols else df


def snake_name(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Plan-time rename to snake_case; collisions are an error."""
    new = [snake_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"column names collide after normalising: {new}")
    return df.toDF(*new)


def filter_geo_range(df: DataFrame) -> DataFrame:
    """Every *latitude* in [6, 37], every *longitude* in [68, 98].

    Unparsable values become null and nulls pass (they are filled later).
    """
    lat = [c for c in df.columns if "latitude" in c.lower()]
    lon = [c for c in df.columns if "longitude" in c.lower()]
    out = df.withColumns({c: F.col(c).try_cast("double") for c in lat + lon}) if lat + lon else df
    out = nan_to_null(out) if lat + lon else out
    cond = F.lit(True)
    for c in lat:
        cond = cond & (F.col(c).isNull() | F.col(c).between(6, 37))
    for c in lon:
        cond = cond & (F.col(c).isNull() | F.col(c).between(68, 98))
    return out.where(cond)


def filter_duration(df: DataFrame, col: str = "time_taken_min", upper: float = 120.0) -> DataFrame:
    """0 < minutes <= upper; null dropped."""
    return df.where(F.col(col).isNotNull() & (F.col(col) > 0) & (F.col(col) <= upper))


def _needing_fill(df: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    """(feature, value) rows of the columns that have a null, and of no other: the nulls are
    counted in one pass over the rows, so columns that need no filling are never unpivoted."""
    typed = {c: F.col(c).cast(cast) for c in cols}
    x = with_stats(df.select(*cols), df.agg(*[F.count_if(v.isNull()).alias(c) for c, v in typed.items()]), "_nulls")
    long = F.array(*[F.when(F.col("_nulls")[c] > 0, F.struct(F.lit(c).alias("feature"), v.alias("value"))) for c, v in typed.items()])
    return x.select(F.explode(F.array_compact(long)).alias("_kv")).select("_kv.feature", "_kv.value")


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, one column per input column: its most frequent non-null value,
    smallest on ties. Built from a distributed ``groupBy(feature, value)``
    count, so a high-cardinality column never sits in one aggregation buffer."""
    counts = _needing_fill(df, cols, "string").where(F.col("value").isNotNull()) \
        .groupBy("feature", "value").count()
    best = counts.groupBy("feature").agg(
        F.min_by("value", F.struct((-F.col("count")).alias("c"), F.col("value").alias("v"))).alias("mode")
    )
    return best.agg(*[F.max(F.when(F.col("feature") == c, F.col("mode"))).alias(c) for c in cols])


def column_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: exact interpolated median per column (nulls ignored)."""
    q = exact_quantiles(_needing_fill(df, cols, "double"), ["feature"], "value", [0.5], names=["median"])
    return q.agg(*[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(c) for c in cols])


def fill_mode(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls of every string column with its mode; 'Unknown' if all null."""
    cols = list(cols if cols is not None else string_columns(df))
    if not cols:
        return df
    x = with_stats(df, column_modes(df, cols), "_modes")
    return x.withColumns({c: F.coalesce(F.col(c), F.col("_modes")[c], F.lit("Unknown")) for c in cols}).drop("_modes")


def fill_median(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls of every numeric column with its exact median."""
    cols = list(cols if cols is not None else numeric_columns(df))
    if not cols:
        return df
    typed = {f.name: f.dataType for f in df.schema.fields}
    x = with_stats(df, column_medians(df, cols), "_medians")
    return x.withColumns({c: F.coalesce(F.col(c), F.col("_medians")[c].cast(typed[c])) for c in cols}).drop("_medians")


def clean_restaurants(df: DataFrame, rate_col: str = "rate", cost_col: str = "cost_text",
                      keep_numeric_unfilled: Sequence[str] = (), checkpoint: bool = True) -> DataFrame:
    """Dedupe -> parse rating and cost (cost renamed cost_for_two) ->
    drop missing rating -> mode / median fill (taken after the drop) -> snake_case."""
    out = dedupe_rows(df)
    parsed = {c: parse(c) for c, parse in ((rate_col, parse_rating), (cost_col, parse_cost)) if c in out.columns}
    if parsed:
        out = computed_once(out, parsed).withColumnsRenamed({cost_col: "cost_for_two"})
    out = drop_missing_target(out, rate_col)
    if checkpoint:
        out = materialize(out)
    out = fill_mode(out)
    num = [c for c in numeric_columns(out) if c not in keep_numeric_unfilled]
    out = fill_median(out, num)
    return normalize_columns(out)


def clean_deliveries(df: DataFrame, time_col: str = "time_text",
                     keep_numeric_unfilled: Sequence[str] = (), checkpoint: bool = True) -> DataFrame:
    """Dedupe -> trim -> parse minutes (renamed time_taken_min) -> geo range
    -> duration filter -> mode / median fill -> snake_case.

    With ``checkpoint`` the filtered rows are written once before the fill
    statistics read them (several passes)."""
    out = trim_strings(dedupe_rows(df))
    if time_col in out.columns:
        out = computed_once(out, {time_col: parse_minutes(time_col)}).withColumnRenamed(time_col, "time_taken_min")
    out = filter_geo_range(out)
    if "time_taken_min" in out.columns:
        out = filter_duration(out)
    if checkpoint:
        out = materialize(out)
    out = fill_mode(out)
    num = [c for c in numeric_columns(out) if c not in keep_numeric_unfilled]
    out = fill_median(out, num)
    return normalize_columns(out)
