"""WARC fixity audit with Merkle trees over ordered record ranges.

``records`` turns pages into WARC records: a file holds the records of 4096
consecutive ids, in order of id, and a record's offset in it follows from the
lengths before it. ``tree`` hashes one replica. A slot (an id) has the SHA-256
of each of its records, added up word by word with their number and bytes, so a
slot with very many records is summed in parts like any other; a node above has
the hash of its up to 16 children in order, with the number of records and of
bytes in each child's range. Levels go on to one root.

``audit`` compares the roots of two replicas and goes down, level by level, into
nodes that differ (or that one replica lacks) only; equal branches are not read
below their top. At the slots it ends in it compares records: every record that
one replica holds more often than the other is reported with its file, offset
and length.

A hash says how many bytes a range has, not where it begins, so a lost or longer
record damages its own branch and not all that follow it in the file.

Defined results: null urls and payloads are empty; records with a null id share
a slot and a file of their own (null); repeated records count as often as they
are there; other columns are not read; equal replicas, and two empty ones, give
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import stored

FILE_BITS = 12
FANOUT_BITS = 4


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(key, record): each page as a WARC resource record."""
    text = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    key = F.col(f"`{id_col}`").cast("long")
    lines = ["WARC/1.1", "WARC-Type: resource", F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">")),
             F.concat(F.lit("WARC-Target-URI: "), text(url_col)), "Content-Type: text/html; charset=utf-8",
             F.concat(F.lit("Content-Length: "), F.octet_length(text(payload_col))), "", text(payload_col), "", ""]
    return pages.select(key.alias("key"), F.concat_ws("\r\n", *[x if isinstance(x, Column) else F.lit(x) for x in lines]).alias("record"))


def manifest(replica: DataFrame) -> DataFrame:
    """(key, sha256, bytes) of every record."""
    return replica.select("key", F.sha2(F.encode("record", "UTF-8"), 256).alias("sha256"), F.octet_length("record").cast("long").alias("bytes"))


def tree(entries: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes (node, hash, records, bytes) of a manifest, one table for each level from the slots up."""
    words = [F.sum(F.conv(F.substring("sha256", 1 + 13 * i, 13), 16, 10).cast("decimal(20,0)")) for i in range(5)]
    slots = entries.groupBy(F.col("key").alias("node")).agg(
        F.sha2(F.concat_ws(":", F.count(F.lit(1)), F.sum("bytes"), *words), 256).alias("hash"), F.count(F.lit(1)).alias("records"), F.sum("bytes").alias("bytes"))
    out = [slots]
    for _ in range(levels):
        child = F.struct("node", F.concat_ws(":", "hash", "records", "bytes").alias("h"))
        out.append(out[-1].groupBy(F.shiftright("node", FANOUT_BITS).alias("node")).agg(  # at most 16 children
            F.sha2(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(child)), lambda c: c["h"])), 256).alias("hash"),
            F.sum("records").alias("records"), F.sum("bytes").alias("bytes")))
    return out


def _differing(one: DataFrame, two: DataFrame) -> DataFrame:
    a, b = one.select("node", "hash").alias("a"), two.select("node", "hash").alias("b")
    both = a.join(b, F.col("a.node").eqNullSafe(F.col("b.node")), "full_outer")
    missing = F.col("a.hash").isNull() | F.col("b.hash").isNull()
    return both.where(missing | (F.col("a.hash") != F.col("b.hash"))).select(F.coalesce("a.node", "b.node").alias("_bad"))


def _below(nodes: DataFrame, bad: DataFrame) -> DataFrame:
    return nodes.join(bad, F.shiftright("node", FANOUT_BITS).eqNullSafe(F.col("_bad")), "left_semi")


def _placed(entries: DataFrame, bad: DataFrame, name: str) -> DataFrame:
    """Records of the bad slots, each distinct one with its number and first offset; only their files are laid out."""
    file = F.shiftright("key", FILE_BITS)
    files = bad.select(F.shiftright("_bad", FILE_BITS).alias("_f")).distinct()
    order = Window.partitionBy("file").orderBy("key", "sha256").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = entries.join(files, file.eqNullSafe(F.col("_f")), "left_semi").withColumn("file", file).withColumn("_end", F.sum("bytes").over(order))
    return laid.join(bad, F.col("key").eqNullSafe(F.col("_bad")), "left_semi").groupBy("file", "key", "sha256", "bytes").agg(
        F.count(F.lit(1)).alias(name), F.min(F.col("_end") - F.col("bytes")).alias("offset"))


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """(file, page_id, sha256, n_expected, n_found, offset, length): records the replicas don't hold equally often.

    ``offset`` is the first in the primary's file, or in the replica's where the primary has none."""
    one, two = stored(manifest(primary)), stored(manifest(replica))
    keys = one.select("key").unionByName(two.select("key")).agg(F.min("key").alias("a"), F.max("key").alias("b")).first()
    levels = max(1, -(-max((x if x >= 0 else ~x).bit_length() for x in (keys["a"] or 0, keys["b"] or 0)) // FANOUT_BITS))
    a, b = ([stored(level) for level in tree(x, levels)] for x in (one, two))
    bad = _differing(a[-1], b[-1])
    for x, y in zip(a[-2::-1], b[-2::-1]):
        bad = _differing(_below(x, bad), _below(y, bad))
    bad = stored(bad)
    x, y = _placed(one, bad, "n_expected"), _placed(two, bad, "n_found")
    same = (F.col("x.key").eqNullSafe(F.col("y.key"))) & (F.col("x.sha256") == F.col("y.sha256")) & (F.col("x.bytes") == F.col("y.bytes"))
    both = x.alias("x").join(y.alias("y"), same, "full_outer")
    first = lambda c: F.coalesce(f"x.{c}", f"y.{c}")
    out = both.select(first("file").alias("file"), first("key").alias("page_id"), first("sha256").alias("sha256"),
                      F.coalesce("n_expected", F.lit(0)).alias("n_expected"), F.coalesce("n_found", F.lit(0)).alias("n_found"),
                      first("offset").alias("offset"), first("bytes").alias("length"))
    return out.where("n_expected <> n_found")
