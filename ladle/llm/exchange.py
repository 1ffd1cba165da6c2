"""Questions of chunks of rows about keys that other chunks hold too.

A chunk (a bounded run of documents) asks about its distinct keys, with one
whole number for each. The questions are dealt by the key's hash into parts; a
part meets all numbers of a key and answers each chunk in the order of its
question. A key is in a part once for each chunk that holds it, however often
its documents repeat it, so a key held by a third of all documents adds as
many entries as there are chunks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

QUESTION = "_chunk long, _part int, _keys array<bigint>, _values array<bigint>"
ANSWER = "_chunk long, _part int, _answers array<bigint>"
#: The same with lists as ``pack_lists`` writes them.
PACKED_QUESTION = QUESTION.replace("array<bigint>", "binary")
PACKED_ANSWER = ANSWER.replace("array<bigint>", "binary")
_ZSTD = pa.Codec("zstd", 1)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def range_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Parts by the order of the keys: the keys of a part share their first bits."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def squeeze(x: np.ndarray, ascending: bool = False) -> bytes:
    """Whole numbers (64 bits) as bytes, about as short as their entropy: of all numbers first the lowest byte, then the next
    and so on, each of the eight compressed by itself, so that random, rare and empty bytes don't share a code.
    ``ascending``: differences instead (runs of sorted numbers; any others come back right too)."""
    x = np.ascontiguousarray(x).view(np.uint64)
    if ascending:
        x = np.diff(x, prepend=np.uint64(0))
    planes = [_ZSTD.compress(np.ascontiguousarray(p), asbytes=True) if p.any() else b"" for p in x.view(np.uint8).reshape(-1, 8).T]
    return np.array([len(x), *map(len, planes)], "<u4").tobytes() + b"".join(planes)


def expand(raw: bytes, ascending: bool = False) -> np.ndarray:
    """The numbers that ``squeeze`` wrote, as int64."""
    n, *sizes = np.frombuffer(raw, "<u4", 9).tolist()
    out, at = np.zeros((n, 8), np.uint8), 36
    for i, size in enumerate(sizes):
        if size:
            out[:, i] = np.frombuffer(_ZSTD.decompress(raw[at:at + size], decompressed_size=n, asbytes=True), np.uint8)
            at += size
    x = out.reshape(-1).view(np.uint64)
    return (np.cumsum(x, dtype=np.uint64) if ascending else x).view(np.int64)


def pack_lists(batch: pa.RecordBatch | pa.Table, *columns: str, ascending: bool = False):
    """Lists of whole numbers as ``squeeze`` writes them."""
    for c in columns:
        packed = [squeeze(x.values.to_numpy(zero_copy_only=False), ascending) for x in batch[c]]
        batch = batch.set_column(batch.schema.get_field_index(c), c, pa.array(packed, pa.binary()))
    return batch


def unpack_lists(table: pa.Table, *columns: str, ascending: bool = False) -> pa.Table:
    for c in columns:
        flat = [expand(x.as_py(), ascending) for x in table[c]]
        offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in flat], dtype=np.int64))), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int64), pa.int64()))
        table = table.set_column(table.schema.get_field_index(c), c, lists)
    return table


def long_list(values: np.ndarray) -> pa.Array:
    """One row: a list of whole numbers."""
    flat = pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64), pa.int64())
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def question(chunk: int, keys: np.ndarray, values: np.ndarray, parts: int, deal: Callable = part_of) -> pa.RecordBatch | None:
    """Rows of ``QUESTION`` for distinct keys (uint64) and a number for each."""
    part = deal(keys, parts)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    used = np.flatnonzero(np.diff(cuts))
    if not len(used):
        return None
    offsets = pa.array(np.append(cuts[used], cuts[-1]), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in
             (keys[order].view(np.int64), values[order].astype(np.int64))]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(used), chunk), pa.int64()), pa.array(used, pa.int32()), *lists], ["_chunk", "_part", "_keys", "_values"])


def numbers(column: pa.ChunkedArray | pa.Array, i: int = 0) -> np.ndarray:
    """The list in row ``i`` as an array."""
    return np.asarray(column[i].values.to_numpy(zero_copy_only=False)) if column[i].is_valid else np.zeros(0, np.int64)


def flat_lists(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False)


def answers(table: pa.Table, per_entry: np.ndarray) -> pa.Table:
    """``ANSWER`` rows for a part's questions, from a number for each entry."""
    sizes = np.array([len(x.values) for x in table["_keys"]], np.int64)
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
    lists = pa.ListArray.from_arrays(offsets, pa.array(per_entry.astype(np.int64), pa.int64()))
    return pa.table({"_chunk": table["_chunk"], "_part": table["_part"], "_answers": lists})


def ask(questions: DataFrame, parts: int, reply: Callable[[pa.Table], pa.Table], schema: str = ANSWER) -> DataFrame:
    """Deal questions to their parts; ``reply`` gets all questions of one part."""
    return questions.repartition(parts, "_part").groupBy("_part").applyInArrow(reply, schema)


def aligned(keys: np.ndarray, parts: int, table: pa.Table, deal: Callable = part_of) -> np.ndarray:
    """The answers to one chunk's question, in the order of its keys."""
    out = np.zeros(len(keys), np.int64)
    part = deal(keys, parts)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p, row in zip(table["_part"].to_pylist(), table["_answers"]):
        out[order[cuts[p]:cuts[p + 1]]] = row.values.to_numpy(zero_copy_only=False)
    return out
