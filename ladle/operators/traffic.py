"""Traffic level resolution over feed tables.

The original asks two HTTP providers per request and falls back to a
time-of-day rule. Here each provider is a table of readings keyed by road
segment; resolution is two left joins and a ``coalesce``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.dims import CONGESTION_CODES

_LEVEL_NAMES = ("Low", "Medium", "High", "Jam")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def level_label(level) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in _LEVEL_NAMES]), (_c(level) + 1).cast("int"))


def expected_traffic_level(hour, dow) -> Column:
    """Weekend 11-20 -> 1 else 0; weekday 8-10 and 18-20 -> 2; 11-17 -> 1; else 0."""
    h, d = _c(hour), _c(dow)
    return (
        F.when(d >= 5, F.when(h.between(11, 20), 1).otherwise(0))
        .when(h.isin(8, 9, 10, 18, 19, 20), 2)
        .when(h.between(11, 17), 1)
        .otherwise(0)
    ).cast("bigint")


def speed_ratio_of_level(level) -> Column:
    lv = _c(level)
    return F.when(lv == 0, 0.9).when(lv == 1, 0.7).when(lv == 2, 0.5).otherwise(0.3)


def traffic_from_speed(current_speed, free_flow_speed) -> dict[str, Column]:
    """Ratio (0.5 when free flow <= 0) -> level, label, ratio rounded to 2."""
    cur, free = _c(current_speed).cast("double"), _c(free_flow_speed).cast("double")
    ratio = F.when(free > 0, cur / free).otherwise(F.lit(0.5))
    level = F.when(ratio >= 0.8, 0).when(ratio >= 0.6, 1).when(ratio >= 0.4, 2).otherwise(3).cast("bigint")
    return {"level": level, "label": level_label(level), "speed_ratio": F.bround(ratio, 2)}


def traffic_from_congestion(label) -> dict[str, Column]:
    """low/medium/high/jam -> 0..3 (else 1); ratio 1 - 0.25 * level."""
    m = F.create_map(*[x for k, v in CONGESTION_CODES.items() for x in (F.lit(k), F.lit(v))])
    level = F.coalesce(m[F.lower(_c(label))], F.lit(1)).cast("bigint")
    return {"level": level, "label": level_label(level), "speed_ratio": 1.0 - level * 0.25}


def resolve_traffic(orders: DataFrame, speed_feed: DataFrame, congestion_feed: DataFrame,
                    key: str = "segment_id", hour: str = "order_hour", dow: str = "day_of_week") -> DataFrame:
    """First available of speed feed -> congestion feed -> time-of-day rule.

    Feeds have one row per ``key`` (speed feed: current_speed, free_flow_speed;
    congestion feed: congestion_level). They are equi-joined on the segment
    key; Spark picks broadcast or sort-merge from their measured size (AQE).
    """
    s = traffic_from_speed("current_speed", "free_flow_speed")
    sf = speed_feed.select(F.col(key), s["level"].alias("_l1"), s["speed_ratio"].alias("_r1"))
    c = traffic_from_congestion("congestion_level")
    cf = congestion_feed.select(F.col(key), c["level"].alias("_l2"), c["speed_ratio"].alias("_r2"))
    lv0 = expected_traffic_level(hour, dow)
    j = orders.join(sf, key, "left").join(cf, key, "left")
    level = F.coalesce("_l1", "_l2", lv0)
    return j.select(
        *orders.columns,
        level.alias("traffic_level"),
        level_label(level).alias("traffic_label"),
        F.coalesce("_r1", "_r2", speed_ratio_of_level(lv0)).alias("speed_ratio"),
        F.when(F.col("_l1").isNotNull(), "speed_feed").when(F.col("_l2").isNotNull(), "congestion_feed")
        .otherwise("time_of_day").alias("source"),
    )
