"""Document fingerprints: a digest of bucket quartiles over hashed byte triplets.

Every window of four bytes adds its first byte with each two of the other three
(three triplets) to one of 128 buckets. A bucket is written as two bits: in which
quartile of the text's own bucket counts it lies. The digest is the length on a
logarithmic scale (a byte) and the 128 two-bit codes, in hex. The difference of
two digests is the sum over the buckets of the code's distance, where the
farthest (3) counts 6, plus the distance of the length codes; ``likeness`` is 1
for a difference of 0, falls evenly, and is 0 from the difference that two
unrelated random digests have on average.

``fingerprint_pairs`` also makes each text's edited form (its last quarter
replaced by the start of the next text in order of id) and compares the text
with that and with the next text. The order is cut into ranges of ids, a task
streams through its ranges in order, and the first row of each range is sent to
the range before it as well, so no task sees more than its ranges.

Defined results: null texts count as empty; the empty text has the code of
length 0 and all codes 0; a text shorter than a window has its length alone.
Ids sort with null first; among equal ids, texts decide the order. After the
last text comes the first. One row alone is its own neighbour. Other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import bounded_batches, partitions, tidy
from ladle.plans.scale import count_below

BUCKETS = 128
LENGTH_BASE = 1.1
#: Mean difference of two unrelated digests: a bucket's code is each of 0..3 with the same chance.
CHANCE = BUCKETS * (6 * 1 + 4 * 2 + 2 * 6) / 16
_COST = np.array([0, 1, 2, 6])


def _triplets(flat: np.ndarray) -> list[np.ndarray]:
    """Buckets of the three triplets of every window of four bytes."""
    a = flat.astype(np.uint32)
    c1, c2, c3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
    w, x, y, z = a[:-3] * c1, a[1:-2], a[2:-1], a[3:]
    out = []
    for salt, (p, q) in enumerate(((x, y), (x, z), (y, z))):
        h = w + p * c2 + q * c3 + np.uint32(salt * 0x27D4EB2F)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out.append((h >> np.uint32(25)).astype(np.intp))
    return out


def counts(data: bytes) -> np.ndarray:
    flat = np.frombuffer(data, np.uint8)
    total = np.zeros(BUCKETS, np.int64)
    if len(flat) >= 4:
        for t in _triplets(flat):
            total += np.bincount(t, minlength=BUCKETS)
    return total


def codes(data: bytes) -> np.ndarray:
    """129 small numbers: the quartile of each bucket and the code of the length."""
    c = counts(data)
    q1, q2, q3 = np.sort(c)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    length = 0 if not data else min(255, 1 + int(np.log(len(data)) / np.log(LENGTH_BASE)))
    return np.append((c > q1).astype(np.uint8) + (c > q2) + (c > q3), np.uint8(length))


def digest(code: np.ndarray) -> str:
    q = code[:-1].reshape(-1, 4)
    return bytes([int(code[-1]), *(q[:, 0] << 6 | q[:, 1] << 4 | q[:, 2] << 2 | q[:, 3]).tolist()]).hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    d = int(_COST[np.abs(a[:-1].astype(np.int16) - b[:-1])].sum()) + abs(int(a[-1]) - int(b[-1]))
    return max(0.0, 1.0 - d / CHANCE)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (whole code points) replaced by as much of the start of ``following``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


_OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range follow one another; the last of a range (``_guest``) is the next range's first."""
    before = None  # id, text, codes of the row that waits for its next
    for batch in batches:
        out: list[tuple] = []
        for key, guest, text in zip(batch["_id"].to_pylist(), batch["_guest"].to_pylist(), batch["_text"].to_pylist()):
            own = codes(text.encode())
            if before is not None:
                i, t, c = before
                e = edited(t, text)
                ec = codes(e.encode())
                out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), digest(c), digest(ec), likeness(c, ec), likeness(c, own)))
            before = None if guest else (key, text, own)
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], kind) for j, (_, kind) in enumerate(_OUT)], [n for n, _ in _OUT])


def fingerprint_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness; see the module."""
    spark = bounded_batches(df.sparkSession)
    n = partitions(spark)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    probs = [i / (4 * n) for i in range(1, 4 * n)]
    bounds = rows.agg(F.percentile_approx("_id", probs, 100 * n).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    if bounds:
        at = count_below(F.array(*[F.lit(b) for b in bounds]), F.col("_id"), len(bounds))
        rows = rows.withColumn("_range", F.when(F.col("_id").isNull(), F.lit(0)).otherwise(at))
    else:
        rows = rows.withColumn("_range", F.lit(0))
    # one row for each range: which ranges have rows, and the first id of each (null sorts first)
    firsts = rows.groupBy("_range").agg(F.min("_id").alias("m"), F.count_if(F.col("_id").isNull()).alias("nulls")).collect()
    firsts = sorted(((r["_range"], None if r["nulls"] else r["m"]) for r in firsts), key=lambda x: x[0])
    if not firsts:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                         "edited_fingerprint string, near_edited double, near_next double")
    goes = [(firsts[i][0], firsts[i][1], firsts[i - 1][0]) for i in range(len(firsts))]  # the first range's goes to the last
    first_of = spark.createDataFrame(goes, "_range int, _first long, _to int")
    x = rows.join(F.broadcast(first_of), "_range")  # a row for each range, four times the partitions
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("g"))
    guest = F.struct(F.col("_to").alias("r"), F.lit(True).alias("g"))
    x = x.withColumn("_place", F.explode(F.when(F.col("_id").eqNullSafe(F.col("_first")), F.array(own, guest)).otherwise(F.array(own))))
    x = x.select(F.col("_place.r").alias("_r"), F.col("_place.g").alias("_guest"), "_id", "_text")
    x = x.repartition(n, "_r").sortWithinPartitions("_r", "_guest", F.asc_nulls_first("_id"), "_text")
    return x.mapInArrow(tidy(_stream), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")
