"""Target-distribution importance resampling: the documents that read most like a target set.

Features of a text are its words and runs of two and three words; each is
hashed (crc32) into one of ``BUCKETS`` buckets. The counts of all documents and
of all target texts per bucket are two arrays of a fixed length, and so is a
bucket's gain, the logarithm of its share in the target over its share in the
documents. A document's weight is read off that array: the sum of the gains of
its features. Gumbel noise, fixed by the document's id, turns the weights into
keys whose largest ones are a sample without replacement.

The winners are found without sorting the losers: weighted median-of-medians.
Every partition names the median of its keys that are still in question and how
many those are; the median of the medians, weighted by these sizes, has at
least a quarter of the remaining keys on either side, so a count of the keys
before it discards that quarter (those before it are in, or those after it are
out). When few are left the exact cutoff key is read from them. Only the winners are then
sorted, over ranges of keys, and ranked by their place in their range.

Crc32 of a run of words is put together from those of its words: crc32 is linear, so
the checksum of ``a + b`` is that of ``a`` moved on by the length of ``b``, plus that of ``b``.

Defined results: a null text has no features and weight 0; repeated rows count and are
judged one by one (of rows with one id and score the one with fewer features comes first);
a null id has no noise: its row counts as a text, its score and rank are null
and it is not drawn; without any target text all gains are as the formula
gives them for T = 0; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import Words, bounded_batches, chunks, stored, tidy

BUCKETS = 10_000
LONGEST = 3
#: Keys in question that are few enough to be read by the driver (24 bytes each).
FEW = 5000
#: Winners that one task sorts, at most about.
SORTED_ROWS = 1_000_000
#: Words of more bytes than this are hashed one at a time.
LONG_WORD = 64

# Bytes that are not letters, digits or parts of other code points than ASCII stand between words.
_APART = np.ones(256, bool)
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _table()


class _Shift:
    """Moves checksums on by any number of bytes: a step for each bit of the number."""

    def __init__(self) -> None:
        c = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
        self.steps = [_CRC[c & np.uint32(255)] ^ (c >> np.uint32(8))]

    @staticmethod
    def _apply(t: np.ndarray, c: np.ndarray) -> np.ndarray:
        m = np.uint32(255)
        return t[0][c & m] ^ t[1][c >> np.uint32(8) & m] ^ t[2][c >> np.uint32(16) & m] ^ t[3][c >> np.uint32(24)]

    def __call__(self, crc: np.ndarray, by: np.ndarray) -> np.ndarray:
        out = crc.copy()
        for bit in range(int(by.max()).bit_length() if len(by) else 0):
            if bit == len(self.steps):
                self.steps.append(self._apply(self.steps[-1], self.steps[-1]))
            at = np.flatnonzero(by >> bit & 1)
            out[at] = self._apply(self.steps[bit], out[at])
        return out


_shift = _Shift()


def word_crcs(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """crc32 of every word, and of the word with a space before it."""
    size = w.ends - w.starts
    crc = np.full(len(w), 0xFFFFFFFF, np.uint32)
    at = np.flatnonzero(size <= LONG_WORD)
    for k in range(LONG_WORD):
        at = at[size[at] > k]
        if not len(at):
            break
        c = crc[at]
        crc[at] = _CRC[(c ^ w.flat[w.starts[at] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG_WORD):
        crc[i] = zlib.crc32(w.word(i))
    space = np.full(len(w), zlib.crc32(b" "), np.uint32)
    return crc, _shift(space, size) ^ crc


def features(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(crc32 of every run of n words, its text) for n = 1 to ``LONGEST``."""
    crc, spaced = word_crcs(w)
    size = w.ends - w.starts + 1
    out, at, runs = [], np.arange(len(w)), crc
    for n in range(1, LONGEST + 1):
        if n > 1:
            ok = at + n - 1 < len(w)
            ok[ok] = w.doc[at[ok]] == w.doc[at[ok] + n - 1]
            at, runs = at[ok], runs[ok]
            runs = _shift(runs, size[at + n - 1]) ^ spaced[at + n - 1]
        out.append((runs, w.doc[at]))
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a task: how many features fall into each bucket."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, flat, at in chunks(batch["_text"]):
            for crc, _ in features(Words(flat, at, lower=True, apart=_APART)):
                total += np.bincount(crc % np.uint32(BUCKETS), minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["_bucket", "_n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features per bucket over all rows of ``_text``; the driver gets one number for each bucket."""
    rows = texts.mapInArrow(tidy(_counts), "_bucket long, _n long").groupBy("_bucket").agg(F.sum("_n").alias("_n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in rows.collect():  # at most BUCKETS rows
        out[r["_bucket"]] = r["_n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the source)), with 1 added to every count."""
    s, t = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + BUCKETS) / ((a + 1.0) * (t + BUCKETS))))
                     for a, b in zip(source.tolist(), target.tolist())], np.int64)


def _weigh(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, count, weight = (np.zeros(n, np.int64) for _ in range(3))
            for i, j, flat, at in chunks(batch["_text"]):
                w = Words(flat, at, lower=True, apart=_APART)
                words[i:j] = w.per_doc
                for crc, doc in features(w):
                    cuts = np.searchsorted(doc, np.arange(j - i + 1))
                    sums = np.concatenate(([0], np.cumsum(gain[crc % np.uint32(BUCKETS)])))
                    count[i:j] += np.diff(cuts)
                    weight[i:j] += sums[cuts[1:]] - sums[cuts[:-1]]
            yield pa.RecordBatch.from_arrays([batch["_id"], pa.array(words), pa.array(count), pa.array(weight)], ["_id", "_words", "_n", "_weight"])
    return run


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise), from the first 32 bits of sha256('<seed>:<doc_id>')."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


Key = tuple[int, int, int]  # -score, id, number of features: smaller is better


def before(key: Key, also: bool = False) -> Column:
    """Rows with a better key than ``key``, or (``also``) the same one. The first condition alone goes down to the files."""
    score, doc, n = (F.lit(x).cast("long") for x in (-key[0], key[1], key[2]))
    s, d, f = F.col("_score"), F.col("_id"), F.col("_n")
    last = f <= n if also else f < n
    return (s >= score) & ((s > score) | (d < doc) | ((d == doc) & last))


def after(key: Key) -> Column:
    score, doc, n = (F.lit(x).cast("long") for x in (-key[0], key[1], key[2]))
    s, d, f = F.col("_score"), F.col("_id"), F.col("_n")
    return (s <= score) & ((s < score) | (d > doc) | ((d == doc) & (f > n)))


def _median(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The median key of a partition and how many keys it has."""
    got = [[batch[c].to_numpy() for c in ("_score", "_id", "_n")] for batch in batches if batch.num_rows]
    if got:
        score, doc, n = (np.concatenate(x) for x in zip(*got))
        i = np.lexsort((n, doc, -score))[(len(n) - 1) // 2]
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (len(n), -score[i], doc[i], n[i])], ["size", "a", "b", "c"])


def weighted_median(medians: list[tuple[int, Key]]) -> Key:
    medians = sorted(medians, key=lambda x: x[1])
    half, seen = sum(s for s, _ in medians) / 2, 0
    for size, key in medians:
        seen += size
        if seen >= half:
            return key
    raise ValueError("no medians")


def cutoff(keys: DataFrame, k: int, few: int = FEW) -> Key:
    """The k-th best key of the stored table ``keys`` (_score, _id, _n), 1 <= k <= its rows."""
    left, need = keys, k
    while True:
        medians = [(r["size"], (r["a"], r["b"], r["c"])) for r in
                   left.mapInArrow(_median, "size long, a long, b long, c long").collect()]  # a row for each partition
        if sum(s for s, _ in medians) <= few:
            rest = sorted((-r["_score"], r["_id"], r["_n"]) for r in left.collect())  # at most ``few`` rows
            return rest[need - 1]
        pivot = weighted_median(medians)
        c = left.agg(F.count_if(before(pivot)).alias("less"), F.count_if(before(pivot, also=True)).alias("upto")).first()
        if c["less"] < need <= c["upto"]:
            return pivot
        if need <= c["less"]:
            left = left.where(before(pivot))
        else:
            left, need = left.where(after(pivot)), need - c["upto"]


def ranked(winners: DataFrame, k: int) -> DataFrame:
    """The rows with ``_rank``, from their place in ranges of keys that are sorted apart."""
    order = [F.desc("_score"), F.asc("_id"), F.asc("_n")]
    parts = max(1, -(-k // SORTED_ROWS))
    x = stored(winners.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted((r["p"], r["n"]) for r in x.groupBy(part.alias("p")).count().toDF("p", "n").collect())  # a row for each range
    offsets, total = [], 0
    for p, n in sizes:
        offsets.append((p, total))
        total += n
    start = x.sparkSession.createDataFrame(offsets, "_part long, _start long")
    place = F.col("_at") - F.shiftleft(F.col("_part"), 33) + F.col("_start") + 1
    return x.withColumn("_part", part).join(F.broadcast(start), "_part").withColumn("_rank", F.when(place <= k, place)).drop("_at", "_part", "_start")


def resample(df: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, id_col: str = "doc_id",
             text_col: str = "text", target_col: str = "text", few: int = FEW) -> DataFrame:
    """Every row's doc_id, n_features, weight, score and, for the drawn ones, rank: of the N documents with
    ``least_words`` words, the floor(percent * N / 100) highest scores."""
    bounded_batches(df.sparkSession)
    source = bucket_counts(df.select(F.col(f"`{text_col}`").alias("_text")))
    gain = gains(source, bucket_counts(target.select(F.col(f"`{target_col}`").alias("_text"))))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    weighed = rows.mapInArrow(tidy(_weigh(gain)), "_id long, _words long, _n long, _weight long")
    # sorted files: a condition on the score then leaves out most of a file
    scored = stored(weighed.withColumn("_score", F.col("_weight") + gumbel(F.col("_id"), seed)).sortWithinPartitions("_score"))
    may = (F.col("_words") >= least_words) & F.col("_id").isNotNull()
    keys = scored.where(may).select("_score", "_id", "_n")
    k = percent * keys.count() // 100
    none = F.lit(None).cast("long")
    if k:
        last = cutoff(keys, k, few)
        drawn = may & before(last, also=True)
        won = ranked(scored.where(drawn), k)
        out = won.select("_id", "_n", "_weight", "_score", "_rank").unionByName(
            scored.where(~F.coalesce(drawn, F.lit(False))).select("_id", "_n", "_weight", "_score", none.alias("_rank")))
    else:
        out = scored.select("_id", "_n", "_weight", "_score", none.alias("_rank"))
    return out.toDF("doc_id", "n_features", "weight", "score", "rank")
