"""Helpers shared by the operators: words and word hashes of whole texts.

A Spark string column arrives in a task as an Arrow array. ``chunks`` cuts it
into runs of rows of a bounded number of bytes (a longer text is a run of its
own) and ``Words`` finds and hashes the words of such a run with numpy, so a
task's memory follows the chunk, not the table.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.plans.scale import materialize

CHUNK_BYTES = 1 << 20
#: Odd 64-bit constants of the hash functions (fixed values).
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back; see ``materialize`` for ``group_rows``."""
    return materialize(df, group_rows)


def bounded_batches(spark: SparkSession, size: int = 8 << 20) -> SparkSession:
    """Texts go to Python in batches of up to about ``size`` bytes (Spark's default is 64 MB), so two
    tasks of an executor with all their workers fit beside its heap."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return spark


def release() -> None:
    """Give freed memory back to the system. Spark keeps Python workers for the next stages; several idle
    ones beside an executor's heap shouldn't hold on to what their last task needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library: it decides itself


def tidy(run):
    """``run`` for mapInArrow, with ``release`` when a task's batches are done."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()
    return wrapped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def doc_crc(doc_id: Column) -> Column:
    """crc32 of the id written as text, for the fixed folds."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * MIX_1
    h = (h ^ (h >> np.uint64(27))) * MIX_2
    return h ^ (h >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)


class _Powers:
    """Powers of the multiplier and of its inverse modulo 2**64, grown on demand."""

    inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, CHUNK_BYTES + 1)
            for name, base in (("up", MULTIPLIER), ("down", self.inverse)):
                x = np.full(n, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))


_POWERS = _Powers()


def binary(texts: pa.Array) -> pa.Array:
    """The UTF-8 bytes of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())


def layout(raw: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large_binary array and the offsets of its rows."""
    _, offsets, data = raw.buffers()
    at = np.frombuffer(offsets, np.int64)[raw.offset:raw.offset + len(raw) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0]:at[-1]], at - at[0]


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows) for runs of rows of up to ``size`` bytes."""
    flat, at = layout(binary(texts))
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield i, j, flat[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a run of texts.

    starts/ends: byte range of each word; first: index of each text's first
    word (one more entry at the end); doc: the text each word is in.
    """

    def __init__(self, flat: np.ndarray, at: np.ndarray, lower: bool = False, apart: np.ndarray = _SPACE):
        """``apart``: which of the 256 bytes stand between words."""
        self.flat = _LOWER[flat] if lower else flat
        self._total: np.ndarray | None = None
        space = apart[flat]
        edge = np.zeros(len(flat) + 1, bool)  # a text begins here
        edge[at[:-1]] = True
        inside = ~space
        before = np.zeros(len(flat), bool)
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.ones(len(flat), bool)
        if len(flat):
            after[:-1] = space[1:] | edge[1:-1]
        self.ends = np.flatnonzero(inside & after) + 1
        self.first = np.searchsorted(self.starts, at)
        self.per_doc = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(at) - 1), self.per_doc)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial over its bytes, from prefix sums, mixed."""
        return self.range_hashes(self.starts, self.ends)

    def range_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The same hash of any ranges of bytes."""
        if self._total is None:
            _POWERS.need(len(self.flat) + 1)
            self._total = np.zeros(len(self.flat) + 1, np.uint64)
            np.cumsum(_CODES[self.flat] * _POWERS.up[:len(self.flat)], out=self._total[1:])
        h = (self._total[ends] - self._total[starts]) * _POWERS.down[starts]
        return mix(h + (ends - starts).astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.flat[self.starts[i]:self.ends[i]].tobytes()


def gram_hashes(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words inside one text, and the index of its first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g = h[:n].copy()
    for j in range(1, k):
        g = g * MULTIPLIER + h[j:n + j]
    last = np.repeat(first[1:], np.diff(first))[:n]
    ok = np.flatnonzero(np.arange(n) + k <= last)
    return mix(g[ok]), ok
