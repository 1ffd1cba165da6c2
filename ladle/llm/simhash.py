"""SimHash near-duplicates with pigeonring filtering.

A text's fingerprint has 64 bits; each is the majority of that bit over the XXH64
hashes of the text's word shingles, repeats included. Equal fingerprints are one
(their documents come back at the end); two of them are linked if they differ in
``BUDGET`` = 3 bits or fewer.

Candidates. A fingerprint is a ring of ``SEGMENTS`` = 4 segments of 16 bits. If
two differ in 3 bits or fewer, there is a segment where a chain can start all of whose
beginnings keep to their share of the budget (Qin and Xiao, 2018): over l consecutive
segments the differences sum up to at most floor(3 * l / 4), that is 0, 1, 2 and 3. The
first segment of the chain is therefore equal: every fingerprint goes to four
groups, one for each segment and value. In its group a pair has to stand the next
two budgets (1 bit over two segments, 2 over three) before all 64 bits are compared.

Groups that are too large for one task are told apart by the next budgets, with the bits
that may differ taken out: first by the next segment without one of its bits (16
groups for each fingerprint, of members that differ in 33 bits), and groups too
large even then by the next two segments without two bits, at most one of them in the
first (376 groups, of members that differ in 18 bits). Such a group
has at most 2**18 members however large the table is; if it is still too large to be compared, its
links follow from one array of 2**18 places: fingerprints that are equal without three of the bits are linked to
one another, so the least label of every such face of the cube is shared in turn until nothing
changes. No step emits the pairs of a group: a task keeps the links that join its
components, fewer than it has members.

Defined results: words are split at ASCII white space, A-Z in lower case; fewer words than a
shingle are one shingle; a null text or one without words has fingerprint 0 and is
linked like any other; a null id has a fingerprint, is linked with nothing and its component is null;
rows that repeat an id are judged one by one; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import MULTIPLIER, Words, bounded_batches, chunks, mix, stored, tidy
from ladle.llm.neardup import components

SEED = 42
BITS, BUDGET, SEGMENTS = 64, 3, 4
WIDTH = BITS // SEGMENTS
#: Members of a group that are compared with one another in one task; larger groups are told apart further.
GROUP = 4096
#: Shingles whose bits are counted at once.
BLOCK = 1 << 18
_ONE = np.uint64(1)
_SEGMENT = np.uint64((1 << WIDTH) - 1)


def fingerprints(texts: pa.Array, k: int) -> np.ndarray:
    """The fingerprint of each text."""
    out = []
    for _, _, flat, at in chunks(texts):
        w = Words(flat, at, lower=True)
        # the words with one space between them, so every shingle is a range of bytes
        size = w.ends - w.starts
        ends = np.cumsum(size + 1) - 1
        joined = np.full(int((size + 1).sum()), 0x20, np.uint8)
        to = np.repeat(ends - size, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        joined[to] = w.flat[np.repeat(w.starts, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
        n = np.where(w.per_doc > 0, np.maximum(w.per_doc - k + 1, 1), 0)  # shingles of each text
        doc = np.repeat(np.arange(len(n)), n)
        first = w.first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        last = np.minimum(first + k, w.first[doc + 1]) - 1
        view, hash_of = memoryview(joined), xxhash.xxh64_intdigest
        h = np.fromiter((hash_of(view[a:b], SEED) for a, b in zip((ends - size)[first].tolist(), ends[last].tolist())), np.uint64, len(doc))
        ones = np.zeros((len(n), BITS), np.int64)
        for i in range(0, len(h), BLOCK):
            bits = np.unpackbits(h[i:i + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            own = doc[i:i + BLOCK]
            begin = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            ones[own[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
        out.append(np.packbits(2 * ones > n[:, None], axis=1).reshape(-1).view(">u8").astype(np.uint64))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _fingerprint(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["_id"], pa.array(fingerprints(batch["_text"], k).view(np.int64))], ["_id", "_print"])
    return run


def chain(x: np.ndarray, start: int) -> np.ndarray:
    """Values whose segment ``start`` comes first (highest), then the others around the ring."""
    by = np.uint64(start * WIDTH)
    return x << by | x >> np.uint64(BITS - start * WIDTH) if start else x


def _group_keys(start: int, c: np.ndarray, part: np.ndarray, level: int) -> np.ndarray:
    """A key for each value: its level, the chain's start and what the group's members have in common."""
    return mix(mix(part * MULTIPLIER + np.uint64(8 * level + start)) + c * MULTIPLIER)


def keys_1(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, chain value, start) for the groups of equal first segments."""
    out = []
    for s in range(SEGMENTS):
        c = chain(prints, s)
        out.append((c >> np.uint64(48) | np.uint64(s << 16), c, np.full(len(c), s, np.int8)))
    return tuple(np.concatenate(x) for x in zip(*out))


#: The bits that may differ, as masks over a chain value: one of the second segment; two of the second
#: and third with at most one of them in the second.
_MASKS_2 = [1 << (32 + i) for i in range(WIDTH)]
_MASKS_3 = [1 << (32 + i) | 1 << (16 + j) for i in range(WIDTH) for j in range(WIDTH)] + [
    1 << (16 + i) | 1 << (16 + j) for i, j in combinations(range(WIDTH), 2)]


def keys_of(c: np.ndarray, start: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, index of the value) for the groups of a deeper level; the mask is part of the key."""
    masks, low = (_MASKS_2, 32) if level == 2 else (_MASKS_3, 16)
    m = np.array(masks, np.uint64)
    common = (c[:, None] & ~m[None, :]) >> np.uint64(low)
    key = mix(mix(common * MULTIPLIER + np.arange(1, len(m) + 1, dtype=np.uint64)[None, :]) + (start.astype(np.uint64) * np.uint64(4) + np.uint64(level))[:, None])
    return key.reshape(-1), np.repeat(np.arange(len(c)), len(m))


class Links:
    """Components of places 0 to n - 1; only links that join two of them are kept."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def find(self, i: int) -> int:
        label = self.label
        while label[i] != i:
            label[i] = i = label[label[i]]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.label[a] != self.label[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            x, y = self.find(x), self.find(y)
            if x != y:
                self.label[max(x, y)] = min(x, y)
        if apart.any():
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def within(x: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among sorted groups of chain values: pairs at a growing distance in their group, by budgets."""
    n = len(x)
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if n else np.zeros(1, np.int64)
    end = np.repeat(cuts[1:], np.diff(cuts))
    links, at, d = Links(n), np.arange(n), 1
    while True:
        at = at[at + d < end[at]]
        if not len(at):
            break
        diff = x[at] ^ x[at + d]
        found, rest = at, diff
        for low in (32, 16, 0):  # the beginnings of the chain: two, three and four segments
            ok = np.bitwise_count(rest >> np.uint64(low)) <= BUDGET * (BITS - low) // BITS
            found, rest = found[ok], rest[ok]
        links.add(found, found + d)
        d += 1
    tied = np.flatnonzero(links.label != np.arange(n))
    return links.label[tied], tied


def on_cube(places: np.ndarray, bits: int = WIDTH + 2) -> np.ndarray:
    """For distinct places of a cube, the place each is tied to: places that are equal without some three
    bits are one, and so on."""
    none = 1 << bits
    label = np.full(none, none, np.int64)
    label[places] = places
    shape = (2,) * bits
    while True:
        old = label.copy()
        for axes in combinations(range(bits), min(BUDGET, bits)):
            cube = label.reshape(shape)
            label = np.where(cube < none, cube.min(axis=axes, keepdims=True), none).reshape(-1)
        if (label == old).all():
            return label[places]


def _collapse(c: np.ndarray, mask: int) -> np.ndarray:
    """The bits in which members of a last group may differ: the two of the mask and the last segment."""
    out, at = c & _SEGMENT, WIDTH
    for b in range(BITS):
        if mask >> b & 1:
            out = out | ((c >> np.uint64(b)) & _ONE) << np.uint64(at)
            at += 1
    return out.astype(np.int64)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of whole groups; rows come sorted by their key, so a group that a batch cuts waits for the next."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch["_key"].to_numpy(), batch["_chain"].to_numpy().view(np.uint64), batch["_start"].to_numpy()]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        last = int(np.searchsorted(rows[0], rows[0][-1], "left"))
        held = [x[last:] for x in rows]
        yield _linked(*[x[:last] for x in rows])
    if held is not None:
        yield _linked(*held)


def _linked(key: np.ndarray, c: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    a, b = within(c, key)
    back = np.uint64(BITS) - start.astype(np.uint64) * np.uint64(WIDTH)

    def turned(i: np.ndarray) -> pa.Array:
        by = back[i] % np.uint64(BITS)
        return pa.array((c[i] << by | c[i] >> (np.uint64(BITS) - by) % np.uint64(BITS)).view(np.int64) if len(i) else np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays([turned(a), turned(b)], ["_a", "_b"])


def _first_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, c, start = keys_1(batch["_print"].to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(c.view(np.int64)), pa.array(start)], ["_key", "_chain", "_start"])


def _deeper_groups(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                c, start = part["_chain"].to_numpy(), part["_start"].to_numpy()
                key, at = keys_of(c.view(np.uint64), start, level)
                mask = np.tile(np.arange(len(key) // max(1, len(c)), dtype=np.int16), len(c))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(c[at]), pa.array(start[at]), pa.array(mask)],
                                                 ["_key", "_chain", "_start", "_mask"])
    return run


def _cube_links(table: pa.Table) -> pa.Table:
    """Links of one last group: at most 2**18 members."""
    c, start, mask = table["_chain"].to_numpy().view(np.uint64), table["_start"].to_numpy(), table["_mask"].to_numpy()
    # members of one key that a hash collision brought together would differ in other bits too
    m = np.uint64(_MASKS_3[mask[0]])
    common = (c & ~m) >> np.uint64(WIDTH)
    same = (common == common[0]) & (mask == mask[0]) & (start == start[0])
    c = c[same]
    places = _collapse(c, _MASKS_3[mask[0]])
    order = np.argsort(places)
    tied = on_cube(places)
    to = order[np.searchsorted(places[order], tied)]
    i = np.flatnonzero(tied != places)
    one = _turn_back(c[i], int(start[0])), _turn_back(c[to[i]], int(start[0]))
    return pa.table([pa.array(x.view(np.int64)) for x in one], names=["_a", "_b"])


def _turn_back(c: np.ndarray, start: int) -> np.ndarray:
    return chain(c, (SEGMENTS - start) % SEGMENTS)


_GROUPS = "_key long, _chain long, _start byte"


def _split(rows: DataFrame, group: int, few_keys: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups of up to ``group`` members, and those of larger ones if there are any;
    ``few_keys``: there are at most SEGMENTS * 2**WIDTH groups, so a list of the large ones is small."""
    large = stored(rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > group).select("_key"))
    if not large.limit(1).count():
        return rows, None
    listed = F.broadcast(large) if few_keys else large
    return rows.join(listed, "_key", "left_anti"), stored(rows.join(listed, "_key", "left_semi"))


def links(prints: DataFrame, group: int = GROUP, cube: int = GROUP) -> DataFrame:
    """(_a, _b): links between distinct fingerprints (``_print``) whose components are those of all links."""
    pair = "_a long, _b long"
    compared = lambda x: x.repartition("_key").sortWithinPartitions("_key").mapInArrow(tidy(_compare), pair)
    fit, large = _split(prints.mapInArrow(_first_groups, _GROUPS), group, few_keys=True)
    out = compared(fit)
    if large is not None:
        fit, larger = _split(large.mapInArrow(_deeper_groups(2), _GROUPS + ", _mask short"), group)
        out = out.unionByName(compared(fit))
        if larger is not None:
            values = larger.select("_chain", "_start").distinct()
            fit, largest = _split(values.mapInArrow(_deeper_groups(3), _GROUPS + ", _mask short"), cube)
            out = out.unionByName(compared(fit))
            if largest is not None:
                out = out.unionByName(largest.groupBy("_key").applyInArrow(_cube_links, pair))
    return out


def simhash_components(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """One row for each row of ``df``: _id, _print (the fingerprint as a long) and _component."""
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    docs = stored(rows.mapInArrow(tidy(_fingerprint(shingle)), "_id long, _print long"))
    known = docs.where("_id IS NOT NULL")
    prints = stored(known.groupBy("_print").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_n")))
    joined = components(links(prints.select("_print"), group)).toDF("_print", "_root")
    rooted = prints.join(joined, "_print", "left").withColumn("_root", F.coalesce("_root", "_print"))
    of_root = rooted.groupBy("_root").agg(F.min("_low").alias("_component"))
    of_print = stored(rooted.join(of_root, "_root").select("_print", "_component", "_n"))
    # a fingerprint that very many rows share is in a list of at most HOT, the others are dealt by it
    hot = of_print.where(F.col("_n") > HOT_ROWS).orderBy(F.desc("_n"), "_print").limit(HOT).select("_print", "_component")
    hot = stored(hot)
    listed = known.join(F.broadcast(hot), "_print")
    rest = known.join(F.broadcast(hot), "_print", "left_anti").join(of_print.select("_print", "_component"), "_print")
    cols = ["_id", "_print", "_component"]
    return listed.select(cols).unionByName(rest.select(cols)).unionByName(
        docs.where("_id IS NULL").select("_id", "_print", F.lit(None).cast("long").alias("_component")))


#: Fingerprints of more than HOT_ROWS rows, the HOT most frequent of them, are joined by a broadcast list.
HOT, HOT_ROWS = 10_000, 1000


def labels(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the fingerprint as 16 hexadecimal digits and component_id."""
    return simhash_components(df, 3, id_col, text_col).select(
        F.col("_id").alias("doc_id"), F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), F.col("_component").alias("component_id"))
