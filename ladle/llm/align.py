"""Alignment of two tokenizers' tokens over the same texts, and how often which ids stand for each other.

Both tokenizers encode a whole text first: A (byte-level BPE) with a space before
it, B (SentencePiece) adds that space itself. A text is aligned if the bytes of its
A tokens and of its B tokens both are the space and the text.

Anchors. Offsets where an A and a B token both end cut a text into groups, the smallest
runs of A and of B tokens that cover the same bytes. Where the next tokens are marked by
a space, such an end is an anchor: anchors cut the text into windows of a word or a few, a window being the
tuple of its A ids and the tuple of its B ids. What happens inside a window depends on these
tuples alone, so a chunk (a bounded run of documents) aligns each pair of tuples once, all of them
in one pass over arrays, and every window with these ids gets the remembered groups and id pairs.

Counts. A chunk keeps its distinct id pairs, and for each document
the places of its pairs among them. The chunks' document counts add up to
the corpus-wide count of every pair; each A id's highest count is one row for each id of A's
vocabulary, which is what is broadcast. Each chunk then gets the counts of its own pairs: a pair is
sent once for each chunk that holds it, however often its documents repeat it.

Defined results: null and empty texts and those whose bytes don't come back (for example, a text with
U+2581, which B reads as a space) have no tokens: zeros and an empty digest; special tokens' strings in
texts are plain text; rows that repeat an id count as documents of their own, as do rows with a null
id; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import _POWERS, MULTIPLIER, bounded_batches, chunks, mix, release, stored, tidy
from ladle.llm.exchange import flat_lists, numbers
from ladle.llm.packing import tokenizer_path
from ladle.llm.pieces import MARK, model_path

CHUNK = 2 << 20
#: Chunks of a stored row group: what a task holds of them when it writes or reads them, whatever its share of the table.
GROUP_CHUNKS = 4


class Vocabularies:
    """The two tokenizers and the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        # the vocabulary of the tokenizer file as ranks: tiktoken gives the same ids in half the time
        with open(path_a.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.encode_a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a[rank] = token
        model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.encode_b = model.encode
        self.b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode()
                  for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))]
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in x], np.int64) for x in (self.a, self.b))
        self.marked = np.array([t[:1] == b" " for t in self.a])
        numbers = [str(i).encode() for i in range(max(len(self.a), len(self.b)))]
        self.digits = np.frombuffer(b"".join(numbers), np.uint8)
        self.digit_sizes = np.array([len(x) for x in numbers], np.int64)
        self.digit_starts = np.cumsum(self.digit_sizes) - self.digit_sizes

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of A and B, or none where their bytes are not the text's."""
        if text:
            raw, a, b = b" " + text.encode(), self.encode_a(" " + text), self.encode_b(text)
            if b"".join([self.a[i] for i in a]) == raw == b"".join([self.b[i] for i in b]):
                return a, b
        return [], []


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


def _hashes(ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ids; runs end at ``cuts``."""
    _POWERS.need(len(ids) + 1)
    total = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(mix((ids + 1).astype(np.uint64) * MULTIPLIER) * _POWERS.up[:len(ids)], out=total[1:])
    starts = np.concatenate(([0], cuts[:-1]))
    return mix((total[cuts] - total[starts]) * _POWERS.down[starts] + (cuts - starts).astype(np.uint64))


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _before(cuts: np.ndarray) -> np.ndarray:
    return np.concatenate((cuts[:1] * 0, cuts[:-1]))


class Groups:
    """The smallest runs of A and B ids that end together; both ids' bytes are the same in all.

    a_to/b_to: where each group ends among the A and the B ids; ends: its last byte."""

    def __init__(self, a: np.ndarray, b: np.ndarray, voc: Vocabularies):
        self.a, self.b = a, b
        ends_a, ends_b = np.cumsum(voc.sizes_a[a]), np.cumsum(voc.sizes_b[b])
        self.ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.a_to, self.b_to = np.searchsorted(ends_a, self.ends) + 1, np.searchsorted(ends_b, self.ends) + 1
        self.a_from, self.b_from = _before(self.a_to), _before(self.b_to)
        self.n_a, self.n_b = self.a_to - self.a_from, self.b_to - self.b_from

    def text(self, voc: Vocabularies) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2;`` in bytes, and where each group's part ends."""
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        mark = np.full(len(ids), ord(","), np.uint8)
        ids[np.arange(len(self.a)) + np.repeat(self.b_from, self.n_a)] = self.a
        ids[np.arange(len(self.b)) + np.repeat(self.a_to, self.n_b)] = self.b
        last = self.a_to + self.b_to
        mark[last - self.n_b - 1], mark[last - 1] = ord("|"), ord(";")
        size = voc.digit_sizes[ids]
        to = np.cumsum(size + 1)
        out = np.empty(int(to[-1]) if len(to) else 0, np.uint8)
        out[to - 1] = mark
        out[_runs(to - size - 1, size)] = voc.digits[_runs(voc.digit_starts[ids], size)]
        return out.tobytes(), to[last - 1]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(group, id pair as a << 32 | b) of every link."""
        n = self.n_a * self.n_b
        group = np.repeat(np.arange(len(n)), n)
        k = _runs(n * 0, n)
        a, b = self.a[self.a_from[group] + k // self.n_b[group]], self.b[self.b_from[group] + k % self.n_b[group]]
        return group, a << 32 | b


class Aligned:
    """The windows of a run of texts, each distinct one (by its A and B ids) aligned once.

    place: for each window its number among the distinct ones; first: each text's first window (one more
    entry at the end)."""

    def __init__(self, texts: list[str | None], voc: Vocabularies):
        tokens = [voc.tokens(t) for t in texts]
        self.n_a, self.n_b = (np.array([len(t[k]) for t in tokens], np.int64) for k in (0, 1))
        a, b = (np.fromiter(chain.from_iterable(t[k] for t in tokens), np.int64, int(n.sum())) for k, n in ((0, self.n_a), (1, self.n_b)))
        del tokens
        ends_a, ends_b = np.cumsum(voc.sizes_a[a]), np.cumsum(voc.sizes_b[b])
        # ends before A tokens that a space marks (every text begins with one) and of B tokens too
        cut_a = np.flatnonzero(np.append(voc.marked[a[1:]], True)) + 1 if len(a) else np.zeros(0, np.int64)
        at_b = np.minimum(np.searchsorted(ends_b, ends_a[cut_a - 1]), max(0, len(b) - 1))
        shared = ends_b[at_b] == ends_a[cut_a - 1]
        cut_a, cut_b = cut_a[shared], at_b[shared] + 1
        from_a, from_b = _before(cut_a), _before(cut_b)
        key = mix(_hashes(a, cut_a) * MULTIPLIER + _hashes(b, cut_b))
        _, at, self.place = np.unique(key, return_index=True, return_inverse=True)
        self.first = np.concatenate(([0], np.searchsorted(cut_a, np.cumsum(self.n_a), "right")))
        # the distinct windows one after the other: groups never cross their ends
        size_a, size_b = (cut_a - from_a)[at], (cut_b - from_b)[at]
        g = Groups(a[_runs(from_a[at], size_a)], b[_runs(from_b[at], size_b)], voc)
        self.window = np.searchsorted(np.cumsum(size_a), g.a_to)  # the window of each group
        self.n_groups = np.bincount(self.window, minlength=len(at))
        self.n_links = np.bincount(self.window, weights=g.n_a * g.n_b, minlength=len(at)).astype(np.int64)
        group, pair = g.links()
        self.distinct, of = np.unique(pair, return_inverse=True)
        # the distinct pairs of each window: where its run begins, the pairs, how often
        both, self.often = np.unique(self.window[group] * max(1, len(self.distinct)) + of, return_counts=True)
        self.pair = both % max(1, len(self.distinct))
        self.n_pairs = np.bincount(both // max(1, len(self.distinct)), minlength=len(at))
        text, to = g.text(voc)
        to = to[np.cumsum(self.n_groups) - 1].tolist()
        self.texts = [text[i:j] for i, j in zip([0, *to[:-1]], to)]

    def digest(self, d: int) -> str:
        own = self.place[self.first[d]:self.first[d + 1]].tolist()
        return hashlib.sha256(b"".join([self.texts[i] for i in own])[:-1]).hexdigest() if own else ""

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text the sum of a number of each distinct window."""
        total = np.concatenate(([0], np.cumsum(values[self.place]))) if len(self.place) else np.zeros(1, np.int64)
        return total[self.first[1:]] - total[self.first[:-1]]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(distinct pairs; for each pair of each text, in the order of the texts: the text, the pair's place, how often)."""
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        # the distinct windows of each text, then their pairs
        width = max(1, len(self.n_pairs))
        both, times = np.unique(doc * width + self.place, return_counts=True)
        doc, window = both // width, both % width
        n, width = self.n_pairs[window], max(1, len(self.distinct))
        at = _runs((np.cumsum(self.n_pairs) - self.n_pairs)[window], n)
        key, place = np.unique(np.repeat(doc, n) * width + self.pair[at], return_inverse=True)
        count = np.bincount(place, weights=np.repeat(times, n) * self.often[at], minlength=len(key)).astype(np.int64)
        return self.distinct, key // width, key % width, count


_CHUNKS = ("_chunk long, ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, digests array<string>, "
           "pairs array<bigint>, docs array<bigint>, per_doc array<bigint>, places array<int>, times array<int>")


def _read(path_a: str, path_b: str):
    """Chunks of aligned documents; see ``Aligned.pairs`` for the last five columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, n = vocabularies(path_a, path_b), TaskContext.get().partitionId() << 32
        one = lambda x, kind: pa.array([x], pa.list_(kind))
        for batch in batches:
            for i, j, _, _ in chunks(batch["_text"], CHUNK):
                x = Aligned(batch["_text"].slice(i, j - i).to_pylist(), voc)
                pairs, doc, place, times = x.pairs()
                per_doc = np.bincount(doc, minlength=j - i)
                yield pa.RecordBatch.from_arrays([
                    pa.array([n], pa.int64()), one(batch["_id"].slice(i, j - i), pa.int64()), one(x.n_a, pa.int64()), one(x.n_b, pa.int64()),
                    one(x.sums(x.n_groups), pa.int64()), one(x.sums(x.n_links), pa.int64()),
                    one([x.digest(d) for d in range(j - i)], pa.string()), one(pairs, pa.int64()),
                    one(np.bincount(place, minlength=len(pairs)), pa.int64()), one(per_doc, pa.int64()),
                    one(place.astype(np.int32), pa.int32()), one(times.astype(np.int32), pa.int32())],
                    ["_chunk", "ids", "n_a", "n_b", "n_groups", "n_links", "digests", "pairs", "docs", "per_doc", "places", "times"])
                n += 1
    return run


_PAIRS = "_chunk long, _place int, _pair long, _docs long"


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            pairs, docs = numbers(batch["pairs"], i), numbers(batch["docs"], i)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), batch["_chunk"][i].as_py()), pa.int64()), pa.array(np.arange(len(pairs), dtype=np.int32)),
                                              pa.array(pairs), pa.array(docs)], ["_chunk", "_place", "_pair", "_docs"])


def _chunked(df: DataFrame, id_col: str, text_col: str, path_a: str | None, path_b: str | None) -> DataFrame:
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    return stored(rows.mapInArrow(tidy(_read(path_a or tokenizer_path(), path_b or model_path())), _CHUNKS), GROUP_CHUNKS)


def _counted(chunked: DataFrame) -> DataFrame:
    """(_pair, _count, _best) over all chunks."""
    pairs = chunked.select("_chunk", "pairs", "docs").mapInArrow(_pair_rows, _PAIRS)
    total = pairs.groupBy("_pair").agg(F.sum("_docs").alias("_count")).withColumn("_a", F.shiftright("_pair", 32))
    total = stored(total)
    highest = total.groupBy("_a").agg(F.max("_count").alias("_most"))  # at most a row for each id of A's vocabulary
    return total.join(F.broadcast(highest), "_a").select("_pair", "_count", (F.col("_count") == F.col("_most")).alias("_best"))


def id_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Every linked pair of ids: a_id, b_id, the number of documents that hold it linked, and whether no other
    B id is linked with the A id in more."""
    return _counted(_chunked(df, id_col, text_col, path_a, path_b)).select(
        F.shiftright("_pair", 32).cast("int").alias("a_id"), F.col("_pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"),
        F.col("_count").alias("n_docs"), F.col("_best").alias("best"))


_GROUP = "doc_id long, group long, start long, end long, a_ids array<int>, b_ids array<int>"


def _spans(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, kind = vocabularies(path_a, path_b), pa.list_(pa.int32())
        for batch in batches:
            for key, text in zip(batch["_id"], batch["_text"]):
                a, b = (np.array(x, np.int64) for x in voc.tokens(text.as_py()))
                g = Groups(a, b, voc)
                lists = [pa.ListArray.from_arrays(pa.array(np.append(0, to), pa.int32()), pa.array(x, pa.int32())) for x, to in ((a, g.a_to), (b, g.b_to))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()] * len(g.ends), pa.int64()), pa.array(np.arange(len(g.ends))), pa.array(_before(g.ends)), pa.array(g.ends), *lists],
                    ["doc_id", "group", "start", "end", "a_ids", "b_ids"])
    return run


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Every group of every text: its byte range (in the space and the text), its A ids and its B ids."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    return rows.mapInArrow(tidy(_spans(path_a or tokenizer_path(), path_b or model_path())), _GROUP)


_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finish(chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """A chunk's documents with the corpus-wide counts of its pairs."""
    place = counts["_place"].to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = counts["_count"].to_numpy(), counts["_best"].to_numpy()
    places, times, per_doc = (flat_lists(chunk[c]).astype(np.int64) for c in ("places", "times", "per_doc"))
    ends = np.cumsum(per_doc)

    def sums(x: np.ndarray) -> pa.Array:
        total = np.concatenate(([0], np.cumsum(times * x[places]))) if len(places) else np.zeros(1, np.int64)
        return pa.array(total[ends] - total[ends - per_doc])
    flat = {c: chunk[c].combine_chunks().flatten() for c in ("ids", "n_a", "n_b", "n_groups", "n_links", "digests")}
    out = pa.table({"doc_id": flat["ids"], "n_a": flat["n_a"], "n_b": flat["n_b"], "n_groups": flat["n_groups"], "n_links": flat["n_links"],
                    "n_best": sums(best), "count_sum": sums(count), "groups_sha256": flat["digests"]})
    release()
    return out


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per row: numbers of tokens, groups and links, links that are the best of their A id, the sum of the
    links' counts, and the sha256 of the groups."""
    chunked = _chunked(df, id_col, text_col, path_a, path_b)
    pairs = chunked.select("_chunk", "pairs", "docs").mapInArrow(_pair_rows, _PAIRS).select("_chunk", "_place", "_pair")
    counts = pairs.join(_counted(chunked), "_pair").select("_chunk", "_place", "_count", "_best")
    return chunked.drop("pairs", "docs").groupBy("_chunk").cogroup(counts.groupBy("_chunk")).applyInArrow(_finish, _OUT)
