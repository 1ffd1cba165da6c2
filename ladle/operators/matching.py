"""Request texts held by table texts, as equi-joins on character n-grams (H9, K5).

A text that holds a request's text also holds each of its grams (three
characters; the whole text where it is shorter). So a request meets only the
rows with its rarest gram, over all of its texts, and the containment is then
checked in full. A request without any text meets all rows, through the empty
gram that every row has. Only grams that some request asks for leave the scan
of the table. A gram of many rows is dealt to as many salts as its rows fill,
so a common gram and the empty one are spread over tasks.

Requests' nulls and empty texts ask for nothing, a null text holds nothing,
case doesn't matter, and no pattern characters are special.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators.recommend import holds
from ladle.plans.scale import materialize, running_total, top_k_per_group, with_stats

GRAM = 3
SALT_ROWS = 20_000


def _windows(text: Column, size: int) -> Column:
    last = F.length(text) - (size - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, size))
                  ).otherwise(F.array().cast("array<string>"))


def _asked(text: Column) -> Column:
    """Grams of a request's text: all of three characters, or the text where it is shorter."""
    text = F.lower(text)
    return F.when(F.length(text) >= GRAM, F.array_distinct(_windows(text, GRAM))).when(F.length(text) > 0, F.array(text))


def _held(text: Column) -> Column:
    """Every gram that a request could ask of a row's text."""
    text = F.lower(text)
    return F.array_distinct(F.concat(*[_windows(text, n) for n in range(1, GRAM + 1)]))


def _tagged(i: int, grams: Column) -> Column:
    """Grams with the number of their text column; none for a null text."""
    none = F.array().cast("array<struct<_col:int,_gram:string>>")
    return F.coalesce(F.transform(grams, lambda g: F.struct(F.lit(i).alias("_col"), g.alias("_gram"))), none)


def match_requests(requests: DataFrame, key: str, table: DataFrame, texts: Sequence[tuple[str, str]], id_col: str,
                   salt_rows: int = SALT_ROWS) -> DataFrame:
    """Rows of ``table`` beside each request whose texts they all hold.

    ``texts`` lists (request column, table column); ``key`` is unique among the
    requests, ``id_col`` in the table. Columns of both sides must differ."""
    open_gram = F.array(F.struct(F.lit(-1).alias("_col"), F.lit("").alias("_gram")))
    asked = F.concat(*[_tagged(i, _asked(F.col(q))) for i, (q, _) in enumerate(texts)])
    wants = requests.select(key, F.explode(F.when(F.size(asked) > 0, asked).otherwise(open_gram)).alias("_g")).select(key, "_g.*")
    has = F.concat(open_gram, *[_tagged(i, _held(F.col(t))) for i, (_, t) in enumerate(texts)])
    rows = table.select(id_col, F.explode(has).alias("_g")).select(id_col, "_g.*")
    rows = materialize(rows.join(wants.select("_col", "_gram").distinct(), ["_col", "_gram"], "left_semi"))  # grams are taken once
    counts = rows.groupBy("_col", "_gram").agg(F.count(F.lit(1)).alias("_n"))
    # a gram that no row has rules its request out
    best = materialize(wants.join(counts, ["_col", "_gram"], "left").groupBy(key).agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_col", "_gram")).alias("_g")).select(key, "_g.*").where("_n > 0"))
    salts = F.ceil(F.col("_n") / salt_rows).cast("int")
    used = best.select("_col", "_gram", salts.alias("_salts")).distinct()
    met = (rows.join(used, ["_col", "_gram"])
           .withColumn("_salt", F.pmod(F.xxhash64(id_col), F.col("_salts")).cast("int")).drop("_salts"))
    dealt = best.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_n").join(requests, key)
    pairs = dealt.join(met, ["_col", "_gram", "_salt"]).drop("_col", "_gram", "_salt").join(table, id_col)
    for q, t in texts:
        pairs = pairs.where(F.col(q).isNull() | (F.col(q) == "") | holds(F.col(t), F.col(q)))
    return pairs


def first_within(requests: DataFrame, key: str, limit: str, table: DataFrame, cost: str, id_col: str, k: int) -> DataFrame:
    """(``key``, ``id_col``): the ``k`` smallest ids of ``table`` whose ``cost`` is at most a request's ``limit``.

    A limit that is null or 0 lets every row pass; else a row without a cost fails. ``key`` is unique among the
    requests, ``id_col`` in the table. No pair of a request and a row is made: a row goes to the smallest limit
    that holds it, limits are numbered in order, and blocks of 1, 2, 4, ... limits keep their k smallest ids. The
    limits up to a request's own are at most one block of each size."""
    any_cost = F.col(limit).isNull() | (F.col(limit) == 0)
    free = requests.where(any_cost).select(key).crossJoin(F.broadcast(table.select(id_col).orderBy(id_col).limit(k)))  # k rows
    capped = requests.where(~any_cost).select(key, F.col(limit).cast("double").alias("_v"))
    limits = capped.select("_v").distinct()
    costs = table.select(id_col, F.col(cost).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    costs = top_k_per_group(costs, ["_v"], [F.asc(id_col)], k).drop("rank")
    both = costs.withColumn("_is", F.lit(0)).unionByName(limits.withColumn("_is", F.lit(1)), allowMissingColumns=True)
    at = running_total(both, [], "_v", ["_is"], tiebreak=["_is"])  # a row comes before a limit of its cost
    ranked = at.where("_is = 1").select("_v", F.col("_is_cum").alias("_r"))
    n = ranked.agg(F.coalesce(F.max("_r"), F.lit(0)).alias("n"))
    rows = with_stats(at.where("_is = 0").select(id_col, F.col("_is_cum").alias("_at")), n, "_n").where(F.col("_at") < F.col("_n.n"))
    rows = top_k_per_group(rows, ["_at"], [F.asc(id_col)], k).drop("rank")
    sizes = F.sequence(F.lit(0), F.floor(F.log2(F.col("_n.n"))).cast("int"))
    blocks = rows.select(id_col, F.explode(F.transform(sizes, lambda j: F.struct(
        j.alias("_size"), F.call_function("shiftright", F.col("_at"), j).alias("_block")))).alias("_b")).select(id_col, "_b.*")
    blocks = top_k_per_group(blocks, ["_size", "_block"], [F.asc(id_col)], k).drop("rank")
    halves = lambda j: F.call_function("shiftright", F.col("_r"), j)
    parts = F.filter(F.sequence(F.lit(0), F.floor(F.log2(F.col("_r"))).cast("int")), lambda j: halves(j) % 2 == 1)
    wants = ranked.select("_v", F.explode(F.transform(parts, lambda j: F.struct(
        j.alias("_size"), (halves(j) - 1).alias("_block")))).alias("_b")).select("_v", "_b.*")
    found = top_k_per_group(wants.join(blocks, ["_size", "_block"]).select("_v", id_col), ["_v"], [F.asc(id_col)], k).drop("rank")
    return capped.join(found, "_v").select(key, id_col).unionByName(free.select(key, id_col))
