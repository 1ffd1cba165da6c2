"""Near-duplicate components by a chosen-path set similarity join.

A document is the set of its word shingles. Documents with equal sets are one
(their copies come back at the end). Each of the others has minhash values
under independent hash functions. A tree chooses one of them per level: all
documents start in its root, and the documents of a node that have the same
value at the node's level go to the same child, so documents meet in a child
with the probability of their Jaccard similarity. Every tree uses other hash
functions, so a pair of similarity s is still together after d levels in one of
T trees with probability 1 - (1 - s**d)**T. The number of trees follows the
threshold (``forest``): it is 0.9995 or more for a pair at the threshold after the
last level (6), and over 1 - 1e-13 after the first, where nearly all nodes are small
already. Documents whose nodes are large and open even then (near copies that
are mostly less alike than the threshold) go to further trees at depth 12, again
as many as 0.9995 takes. So a pair at the threshold is found with 0.999 in the
worst case (25 and 107 trees at 0.80, 17 and 50 at 0.85).

In every node all documents are compared with the node's smallest first, which
keeps a node linear in its size. A node whose documents are then in one known
component is done. Others are compared exhaustively, for documents of different
components, if they are small; else they branch on. Nothing is capped: a node
that is still large and open at the last level is compared exhaustively too, by
blocks of a bounded number of bytes: a task meets one block, or two.

A pair is compared in two steps: by the share of equal minhash values, which
only refuses pairs far below the threshold (by more than 6 standard
deviations), then by the full sets: |intersection| * 100 >= percent * |union| on
64-bit shingle hashes. Components are taken over confirmed links with
large-star/small-star rounds.

Defined results: words are split at ASCII white space, A-Z in lower case; a text
of fewer words than a shingle is one shingle; null texts and texts without words
have the empty set and are linked with nothing; a null id is a document of its
own, is linked with nothing and its component is null; rows that repeat an id
are judged one by one; an empty table gives no rows. Other columns are not read
by ``labels`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import MULTIPLIER, Words, bounded_batches, chunks, gram_hashes, mix, stored, tidy
from ladle.plans.scale import discard

class Forest:
    """Independent trees; ``depths``: how many minhash values documents have been split by after each round."""

    def __init__(self, trees: int, depths: tuple[int, ...], seed: int):
        self.trees, self.depths, n = trees, depths, trees * depths[-1]
        key = np.arange(1, 2 * n + 1, dtype=np.uint64) + np.uint64(seed << 32)
        self.salts = mix(key * MULTIPLIER).astype(np.uint32).reshape(2, -1)
        self.roots = (np.arange(1, trees + 1, dtype=np.uint64) + np.uint64(seed << 32)) * MULTIPLIER
        self.steps = np.arange(1, depths[-1] + 1, dtype=np.uint64) * MULTIPLIER


#: The least probability that a pair at the threshold meets in a node of a forest's last depth.
RECALL = 0.9995
SMALL_NODE = 32
#: Bytes of sets in a block of a node of the last depth; a task compares one block, or two with each other.
BLOCK_BYTES = 8 << 20
#: All trees of the first forest, as bits.
ALL_TREES = -1
#: Minhash values (a byte of each) that pairs are compared by first, and how far below the
#: threshold the share of equal ones may be: 6 standard deviations at 0.8 and above.
BRIEF = 64
MARGIN = 0.3
#: Texts for comparing are picked by a broadcast list of ids up to this many (16 bytes each), else by a shuffle.
BROADCAST_IDS = 500_000
ROWS_PER_TASK = 25_000


def forest(percent: int, depths: tuple[int, ...], fewest: int, most: int, seed: int) -> Forest:
    """As many trees as ``RECALL`` takes for pairs at the threshold; for low thresholds that ``most`` trees
    don't reach at the last of ``depths``, less deep ones."""
    s = min(max(percent, 1), 99) / 100
    need = lambda d: math.ceil(math.log(1 - RECALL) / math.log1p(-s**d))
    last = max((d for d in range(1, depths[-1] + 1) if need(d) <= most), default=1)
    return Forest(max(fewest, -(-BRIEF // last), need(last)), (*[d for d in depths if d < last], last), seed)


def first_forest(percent: int) -> Forest:
    return forest(percent, (1, 3, 6), 16, 32, 0)


def second_forest(percent: int) -> Forest:
    """For documents whose nodes are still large and open after the first: groups of near copies many of which are
    somewhat less alike than the threshold. More and deeper trees, over minhash values of these documents only."""
    return forest(percent, (12,), 32, 128, 1)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    for _, _, flat, at in chunks(texts):
        w = Words(flat, at, lower=True)
        h = w.hashes()
        grams, where = gram_hashes(h, w.first, k)
        cuts = np.searchsorted(where, w.first)
        for d in range(len(at) - 1):
            n = w.per_doc[d]
            if 0 < n < k:
                yield gram_hashes(h[w.first[d]:w.first[d + 1]], np.array([0, n]), n)[0] + np.uint64(n)
            else:
                yield np.unique(grams[cuts[d]:cuts[d + 1]])


def minhashes(h: np.ndarray, first: np.ndarray, forest: Forest) -> np.ndarray:
    """Per run of ``h`` that begins at ``first`` (none empty) the smallest value under each hash function."""
    low = (h >> np.uint64(32)).astype(np.uint32)
    return np.stack([np.minimum.reduceat((low ^ x) * (y | np.uint32(1)), first) for x, y in forest.salts.T], axis=1)


_SKETCH = "_id long, _mark long, _n long, _set string, _sketch binary"


def _sketches(k: int, forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            n = np.zeros(batch.num_rows, np.int64)
            names: list[str | None] = [None] * batch.num_rows
            sketches: list[bytes | None] = [None] * batch.num_rows

            def flush(upto: int) -> None:
                at = [i for i in range(upto - len(sets), upto) if n[i]]
                if at:
                    every = np.concatenate(sets)
                    first = np.concatenate(([0], np.cumsum(n[at])[:-1]))
                    one, two = np.add.reduceat(every, first), np.add.reduceat(mix(every * MULTIPLIER), first)
                    for i, x, y, m in zip(at, one, two, minhashes(every, first, forest)):
                        # the size and two sums of mixed hashes name the set
                        names[i], sketches[i] = f"{n[i]}-{int(x):x}-{int(y):x}", m.tobytes()
                sets.clear()

            held = 0
            for i, s in enumerate(shingle_sets(batch["_text"], k)):
                n[i], held = len(s), held + len(s)
                sets.append(s)
                if held > 200_000:
                    flush(i + 1)
                    held = 0
            flush(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["_mark"], pa.array(n), pa.array(names, pa.string()), pa.array(sketches, pa.binary())],
                ["_id", "_mark", "_n", "_set", "_sketch"])
    return run


def _brief(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A byte of every other minhash value."""
    for batch in batches:
        if batch.num_rows:
            values = np.frombuffer(b"".join(batch["_sketch"].to_pylist()), np.uint32).reshape(batch.num_rows, -1)
            brief = np.ascontiguousarray(values[:, :BRIEF] & np.uint32(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch["_id"], pa.array([r.tobytes() for r in brief], pa.binary())], ["_id", "_brief"])


def _deeper(k: int, forest: Forest):
    """Minhash values of texts for another forest, and their sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sets = list(shingle_sets(batch["_text"], k))
                sketches = [minhashes(s, np.zeros(1, np.int64), forest)[0].tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([batch["_id"], pa.array(sketches, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 ["_id", "_sketch", "_members"])
    return run


def _exhaust(percent: int):
    """All documents of one block of a node (or of two blocks) against each other, by an index of their shingles;
    the links that join their components."""
    def run(table: pa.Table) -> pa.Table:
        ids, label = table["_id"].to_numpy(), table["_component"].to_numpy().copy()
        block = table["_block"].to_numpy()
        two = table["_x"][0].as_py() != table["_y"][0].as_py()
        sets = [np.frombuffer(x, np.uint64) for x in table["_members"].to_pylist()]
        n = np.array([len(s) for s in sets])
        flat, cuts = np.concatenate(sets), np.concatenate(([0], np.cumsum(n)))
        holders = np.repeat(np.arange(len(ids)), n)[np.argsort(flat, kind="stable")]
        _, place, size = np.unique(flat, return_inverse=True, return_counts=True)
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        out = []
        for x in np.flatnonzero(label != table["_low"][0].as_py()):
            own = place[cuts[x]:cuts[x + 1]]
            to = size[own]
            at = np.repeat(begin[own] - np.concatenate(([0], np.cumsum(to)[:-1])), to) + np.arange(to.sum())
            both = np.bincount(holders[at], minlength=len(ids))
            alike = (100 * both >= percent * (n[x] + n - both)) & (label != label[x])
            for y in np.flatnonzero(alike & (block != block[x]) if two else alike):
                if label[y] != label[x]:
                    out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                    label[label == label[y]] = label[x]
        return pa.table([pa.array([r[c] for r in out], pa.int64()) for c in (0, 1)], names=["_a", "_b"])
    return run


def _paths(forest: Forest, depth: int):
    """The node of each set at ``depth`` in the trees that the bits of ``_trees`` name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch["_id"].to_numpy()
            values = np.frombuffer(b"".join(batch["_sketch"].to_pylist()), np.uint32).reshape(len(ids), forest.trees, -1)
            wanted = batch["_trees"].to_numpy().view(np.uint64)
            doc, tree = np.nonzero(wanted[:, None] >> np.minimum(np.arange(forest.trees), 63).astype(np.uint64) & np.uint64(1))
            node = forest.roots[tree]
            for j in range(depth):
                node = mix(node ^ (values[doc, tree, j].astype(np.uint64) + forest.steps[j]))
            yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(tree.astype(np.int16)), pa.array(ids[doc])], ["_node", "_tree", "_id"])
    return run


def _alike(least: float):
    """Pairs whose sketches don't refuse them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("_sa", "_sb"))
                ok = (a == b).mean(axis=1) >= least
                yield pa.RecordBatch.from_arrays([batch["_a"].filter(pa.array(ok)), batch["_b"].filter(pa.array(ok))], ["_a", "_b"])
    return run


def _confirm(k: int, percent: int):
    """Links among the pairs by their full sets; rows come sorted by ``_a``, so its set is kept for its pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = None, None
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            firsts, seconds = batch["_a"].to_pylist(), shingle_sets(batch["_tb"], k)
            for i, (a, other) in enumerate(zip(firsts, seconds)):
                if a != known:
                    known, own = a, next(shingle_sets(pa.array([batch["_ta"][i].as_py()], pa.string()), k))
                both = len(np.intersect1d(own, other, assume_unique=True))
                ok[i] = 100 * both >= percent * (len(own) + len(other) - both)
            yield pa.RecordBatch.from_arrays([batch["_a"].filter(pa.array(ok)), batch["_b"].filter(pa.array(ok))], ["_a", "_b"])
    return run


def tasks(rows: int) -> int:
    """How many tasks so many short rows are worth: small steps shouldn't pay for all shuffle partitions."""
    return max(8, -(-rows // ROWS_PER_TASK))


def components(links: DataFrame, a: str = "_a", b: str = "_b") -> DataFrame:
    """(_id, _component): the smallest id reachable, for every id with a link.

    Large-star and small-star rounds (Kiveris et al., 2014): each links the
    neighbours of an id to the smallest of them, until nothing changes. All
    groups are aggregates; no neighbourhood is gathered in a task."""
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == mark or not now["n"]:
            break
        mark, k = now, tasks(now["n"])
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").coalesce(k).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # an id's larger neighbours now name the smallest: one pass more over the same grouping
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.distinct().join(low, "u").coalesce(k)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        last, edges = edges, stored(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().coalesce(k))
        discard(last)
    stars = edges.select(F.col("u").alias("_id"), F.col("v").alias("_component"))
    return stars.unionByName(edges.select(F.col("v").alias("_id"), F.col("v").alias("_component")).distinct())


class _Join:
    """Components of distinct sets (_id: the set's name hashed), level by level."""

    def __init__(self, rows: DataFrame, sets: DataFrame, k: int, percent: int):
        self.rows, self.sets, self.k, self.percent = rows, sets, k, percent
        self.first, self.second = first_forest(percent), second_forest(percent)
        self.made: list[DataFrame] = []
        self.brief = self._stored(sets.select("_id", "_sketch").mapInArrow(tidy(_brief), "_id long, _brief binary"))
        self.tried = self.texts = None
        self.known = sets.sparkSession.createDataFrame([], "_id long, _component long")

    def _stored(self, df: DataFrame) -> DataFrame:
        self.made.append(stored(df))
        return self.made[-1]

    def _fetch(self, ids: DataFrame, k: int) -> None:
        """Add the texts of the sets that aren't stored yet, one text for each set."""
        if self.texts is not None:
            ids = ids.join(self.texts.select("_id"), "_id", "left_anti")
        wanted = self._stored(ids.join(self.sets.select("_id", "_doc", "_mark"), "_id").coalesce(k).select(
            F.col("_id").alias("_set_id"), F.col("_doc").alias("_id"), "_mark"))
        n = wanted.count()
        if n:
            picked = self.rows.join(F.broadcast(wanted) if n <= BROADCAST_IDS else wanted, ["_id", "_mark"])
            picked = self._stored(picked.dropDuplicates(["_set_id"]).coalesce(max(tasks(n), n // 500)).select(F.col("_set_id").alias("_id"), "_text"))
            self.texts = picked if self.texts is None else self.texts.unionByName(picked)

    def _merge(self, links: DataFrame) -> None:
        """Take links into the known components: only links between two of them are followed."""
        of = lambda x: F.coalesce(f"_c{x}", f"_{x}")
        x = links.join(self.known.toDF("_a", "_ca"), "_a", "left").join(self.known.toDF("_b", "_cb"), "_b", "left")
        between = self._stored(x.select(of("a").alias("_a"), of("b").alias("_b")).where("_a <> _b").distinct())
        n = between.count()
        if n:
            new = self._stored(components(between).toDF("_component", "_to"))
            old = self.known.join(new, "_component", "left").select("_id", F.coalesce("_to", "_component").alias("_component"))
            first_seen = new.toDF("_id", "_component").join(self.known.select("_id"), "_id", "left_anti")
            self.known = self._stored(old.unionByName(first_seen).coalesce(tasks(n)))

    def compare(self, pairs: DataFrame, k: int) -> None:
        """Confirm pairs (_a < _b) not tried before and merge their components."""
        new = pairs.distinct()
        if self.tried is not None:
            new = new.join(self.tried, ["_a", "_b"], "left_anti")
        x = new.join(self.brief.toDF("_a", "_sa"), "_a").coalesce(k).join(self.brief.toDF("_b", "_sb"), "_b").coalesce(k)
        new = self._stored(x.select("_a", "_b", "_sa", "_sb").mapInArrow(tidy(_alike(self.percent / 100 - MARGIN)), "_a long, _b long"))
        n = new.count()
        if not n:
            return
        self.tried = new if self.tried is None else self.tried.unionByName(new)
        k = max(tasks(n), n // 1000)  # rows with texts from here on
        self._fetch(new.select(F.col("_a").alias("_id")).unionByName(new.select(F.col("_b").alias("_id"))).distinct(), k)
        x = new.join(self.texts.toDF("_b", "_tb"), "_b").coalesce(k).join(self.texts.toDF("_a", "_ta"), "_a").coalesce(k)
        x = x.select("_a", "_ta", "_b", "_tb").sortWithinPartitions("_a")
        self._merge(self._stored(x.mapInArrow(tidy(_confirm(self.k, self.percent)), "_a long, _b long")))

    def open_nodes(self, nodes: DataFrame, k: int) -> DataFrame:
        """Rows of the nodes that hold two components or more, with the component of each document."""
        x = nodes.join(self.known, "_id", "left").coalesce(k).withColumn("_component", F.coalesce("_component", "_id"))
        of = x.groupBy("_node").agg(F.min("_component").alias("_low"), F.max("_component").alias("_high"), F.count(F.lit(1)).alias("_size"))
        return x.join(of.where("_low <> _high").select("_node", "_low", "_size"), "_node").coalesce(k)

    def _round(self, nodes: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """Compare in the nodes of one depth; returns the rows of those that are large and open still.

        With ``sets`` (_id, _members) it is the last one: nodes are cut into blocks of a bounded number of bytes,
        and each block is compared with itself and the others in a task."""
        least = nodes.groupBy("_node").agg(F.min("_id").alias("_a"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
        nodes = self._stored(nodes.join(least, "_node").select("_node", "_tree", "_id", "_a"))
        k = tasks(nodes.count())
        self.compare(nodes.where("_id <> _a").select("_a", F.col("_id").alias("_b")), k)
        left = self._stored(self.open_nodes(nodes.select("_node", "_tree", "_id"), k))
        k = tasks(left.count())
        if sets is not None:
            rows = left.join(sets, "_id").select("_node", "_id", "_component", "_low", "_members")
            blocks = rows.groupBy("_node").agg(F.ceil(F.sum(F.length("_members")) / BLOCK_BYTES).alias("_blocks"))
            rows = rows.join(blocks, "_node").withColumn("_block", F.pmod(F.xxhash64("_id"), F.col("_blocks")))
            rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            rows = rows.select("_node", F.least("_block", "_other").alias("_x"), F.greatest("_block", "_other").alias("_y"), "_block", "_id", "_component", "_low", "_members")
            self._merge(self._stored(rows.groupBy("_node", "_x", "_y").applyInArrow(_exhaust(self.percent), "_a long, _b long")))
            return left
        few = left.where(F.col("_size") <= SMALL_NODE)
        # of two components one isn't the node's lowest
        one = few.where("_component <> _low").select("_node", F.col("_id").alias("_x"), F.col("_component").alias("_cx"))
        two = few.select("_node", F.col("_id").alias("_y"), F.col("_component").alias("_cy"))
        pairs = one.join(two, "_node").where("_cx <> _cy").coalesce(k).select(F.least("_x", "_y").alias("_a"), F.greatest("_x", "_y").alias("_b"))
        self.compare(pairs, k)
        return self._stored(left.where(F.col("_size") > SMALL_NODE).select("_tree", "_id").coalesce(k))

    def run(self) -> DataFrame:
        nodes_of = lambda rows, forest, depth: rows.select("_id", "_trees", "_sketch").mapInArrow(
            _paths(forest, depth), "_node long, _tree short, _id long")
        every = F.lit(ALL_TREES).cast("long").alias("_trees")
        active = self.sets.select("_id", "_sketch", every)
        for depth in self.first.depths:
            large = self._round(nodes_of(active, self.first, depth))
            n = large.count()
            if not n:
                break
            # a set goes on in the trees whose node is large and open, and in no others
            trees = large.groupBy("_id").agg(F.expr("bit_or(shiftleft(1L, CAST(_tree AS INT)))").alias("_trees"))
            active = self._stored(self.sets.select("_id", "_sketch").join(trees, "_id").coalesce(tasks(n)))
        else:
            self._fetch(active.select("_id"), tasks(n))
            deep = self._stored(active.select("_id").join(self.texts, "_id").coalesce(max(tasks(n), n // 5000)).mapInArrow(
                _deeper(self.k, self.second), "_id long, _sketch binary, _members binary"))
            self._round(nodes_of(deep.select("_id", "_sketch", every), self.second, self.second.depths[-1]), deep.select("_id", "_members"))
        discard(*[t for t in self.made if t is not self.known])
        return self.known


def near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _mark, _n, _component) for every row: its id, the xxhash64 of its text, the size
    of its set and the smallest id of its component."""
    bounded_batches(df.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.xxhash64(text).alias("_mark"), text.alias("_text"))
    sketches = stored(rows.mapInArrow(tidy(_sketches(shingle, first_forest(percent))), _SKETCH))
    # a hashed name stands for the set; its first document stands for its copies
    full = sketches.where("_set IS NOT NULL AND _id IS NOT NULL")
    doc = F.min(F.struct("_id", "_mark"))
    sets = stored(full.groupBy("_set").agg(doc.alias("_d"), F.first("_sketch").alias("_sketch")).select(
        F.xxhash64("_set").alias("_id"), F.col("_d._id").alias("_doc"), F.col("_d._mark").alias("_mark"), "_sketch"))
    roots = _Join(rows, sets, shingle, percent).run().toDF("_id", "_root")
    known = sets.select("_id", "_doc").join(roots, "_id", "left").withColumn("_root", F.coalesce("_root", "_id"))
    lowest = known.groupBy("_root").agg(F.min("_doc").alias("_component"))
    of_set = known.join(lowest, "_root").select(F.col("_id").alias("_set_id"), "_component")
    out = sketches.select("_id", "_mark", "_n", F.when(F.col("_id").isNotNull(), F.xxhash64("_set")).alias("_set_id"), F.col("_set").isNull().alias("_empty"))
    whole = out.where(~F.col("_empty")).join(of_set, "_set_id", "left")
    none = out.where("_empty").withColumn("_component", F.col("_id"))
    cols = ["_id", "_mark", "_n", F.coalesce("_component", "_id").alias("_component")]
    return whole.select(*cols).unionByName(none.select(*cols))


def labels(df: DataFrame, shingle: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and whether it is the one that stays."""
    return near_duplicates(df, shingle, percent, id_col, text_col).select(
        F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_component")).alias("kept"))


def drop_near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose document stands for its component; rows that repeat an id and text stay once."""
    found = near_duplicates(df, shingle, percent, id_col, text_col)
    stay = found.where(F.col("_id").eqNullSafe(F.col("_component"))).select(F.col("_id").alias("_k"), F.col("_mark").alias("_m")).distinct()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    inner = [f"_c{i}" for i in range(len(df.columns))]
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, inner)], F.col(f"`{id_col}`").cast("long").alias("_k"), F.xxhash64(text).alias("_m"))
    with_id = rows.where("_k IS NOT NULL").join(stay, ["_k", "_m"], "left_semi").dropDuplicates(["_k", "_m"])
    both = with_id.unionByName(rows.where("_k IS NULL"))
    return both.select(*[F.col(n).alias(c) for n, c in zip(inner, df.columns)])
