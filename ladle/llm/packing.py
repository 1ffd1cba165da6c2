"""Packing by lexical retrieval: documents into windows of a fixed token length.

Texts are tokenized and cut at multiples of the window; whole windows stand
alone. What is left of a document (its tail) is packed with tails that read
like it. Each shard has a BM25 inverted index over the token ids of its tails,
and each seed tail asks it for its best neighbours that are not used yet. A
neighbour that fits is taken whole; if none of the best fits, the best is cut to
fill the window and the rest of it is the next seed. So every window of a shard
but the last is full.

Shards have about ``SHARD_ROWS`` tails at any size of the table, and tails that read
alike share one: document frequencies and the mean length are those of all tails,
a tail's heaviest terms (``HEAVY``, of those that another tail has too) vote for its
topic and its topic for theirs, twice (a topic is named by a term, so there are at most as many
as token ids); tails are then dealt by ranges of topic, of two of their heavy terms (those with
the smallest hashes) and of their place in the table. A topic of a third of all
tails so becomes many shards, cut between its terms.

Terms that more than half of all tails hold have no weight (Robertson's
idf, not below 0). Token ids are those of the ``tokenizers`` file; texts without
its special token go through the same vocabulary's ranks in ``tiktoken``, which
gives the same ids (tests compare them) in less than half the time.

Defined results: a null text is empty and is its closing id alone; repeated rows
are packed one by one, also with a null id; other columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import MULTIPLIER, bounded_batches, mix, release, stored, tidy
from ladle.llm.exchange import flat_lists
from ladle.plans.scale import discard

WINDOW = 1024
SHARD_ROWS = 1000
END_ID = 0
TOP = 16
HEAVY = 16
ROUNDS = 2
K1, B = 1.2, 0.75
SPECIAL = "<|endoftext|>"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str):
    """text -> token ids, for the tokenizer file at ``path``."""
    import tiktoken
    from tokenizers import Tokenizer

    import public_tokenizers

    plain = lru_cache(maxsize=1)(lambda: Tokenizer.from_file(path))  # for the rare texts that need it
    with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(text: str) -> list[int]:
        return plain().encode(text, add_special_tokens=False).ids if SPECIAL in text else fast(text)
    return encode


def _tokenize(path: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            sizes, crcs, tails = [], [], []
            for text in batch["_text"]:
                ids = encode(text.as_py() or "")
                ids.append(END_ID)
                ids = np.array(ids, "<u4")
                full = len(ids) // window
                raw = ids[:full * window].tobytes()
                crcs.append([zlib.crc32(raw[i * 4 * window:(i + 1) * 4 * window]) for i in range(full)])
                tails.append(ids[full * window:].astype("<u2" if len(ids) and ids.max() < 65536 else "<u4").tobytes())
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], pa.array(sizes, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(tails, pa.binary())],
                ["_id", "_size", "_crcs", "_tail"])
    return run


def read_tail(raw: bytes, size: int, window: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * (size % window) else "<u4")


def term_counts(tails: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tail, term, how often) by tail, then term."""
    term = np.concatenate([np.zeros(0, np.uint16), *tails])
    kind, shift = (np.uint32, 16) if len(tails) <= 1 << 16 and term.max(initial=0) < 1 << 16 else (np.uint64, 32)  # half as long keys sort faster
    key = np.repeat(np.arange(len(tails), dtype=kind), [len(t) for t in tails]) << kind(shift) | term.astype(kind)
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    tf = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> kind(shift)).astype(np.int64), (key & kind((1 << shift) - 1)).astype(np.int64), tf


def by_value(x: np.ndarray) -> np.ndarray:
    """The stable order of whole numbers from 0; short ones are sorted by their digits."""
    return np.argsort(x.astype(np.uint16) if x.max(initial=0) < 1 << 16 else x, kind="stable")


def bm25(idf: np.ndarray, tf: np.ndarray, length: np.ndarray, mean: float) -> np.ndarray:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def idf_of(df: np.ndarray, n: int) -> np.ndarray:
    return np.maximum(0.0, np.log((n - df + 0.5) / (df + 0.5)))


def _batch_tails(batch: pa.RecordBatch, window: int) -> list[np.ndarray]:
    return [read_tail(raw, size, window) for raw, size in zip(batch["_tail"].to_pylist(), batch["_size"].to_pylist())]


def _frequencies(window: int):
    """How many of a task's tails hold each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(0, np.int64)
        for batch in batches:
            n = np.bincount(term_counts(_batch_tails(batch, window))[1], minlength=len(df))
            n[:len(df)] += df
            df = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], ["term", "n"])
    return run


def _mark(window: int, stats):
    """Each tail with its heaviest terms among those that another tail has too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, idf, mean = stats.value
        for batch in batches:
            tails = _batch_tails(batch, window)
            doc, term, tf = term_counts(tails)
            weight = np.round(1000 * bm25(idf[term], tf, np.array([len(t) for t in tails])[doc], mean)).astype(np.int64)
            use = np.flatnonzero((weight > 0) & (df[term] > 1))
            # one sort by tail, weight (heaviest first) and term: 20 bits for the rows of a batch, 24 for weights, 20 for token ids
            most = np.int64((1 << 24) - 1)
            order = np.sort((doc[use] << 44 | (most - weight[use]) << 20 | term[use]).view(np.uint64)).view(np.int64)
            doc, weight, term = order >> 44, most - (order >> 20 & most), order & ((1 << 20) - 1)
            top = np.arange(len(doc)) - np.searchsorted(doc, np.arange(batch.num_rows))[doc] < HEAVY
            doc, weight, term = doc[top], weight[top], term[top]
            at = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (term, weight)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, "_terms", "_weights"])
    return run


def _topics(batch: pa.RecordBatch, topic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tail of each heavy term, term, weight, each tail's topic: the one most of its terms' weight is for, -1 without terms)."""
    sizes = np.diff(batch["_terms"].offsets.to_numpy())
    doc, term, weight = np.repeat(np.arange(len(sizes)), sizes), flat_lists(batch["_terms"]).astype(np.int64), flat_lists(batch["_weights"]).astype(np.int64)
    key, place = np.unique(doc << 32 | topic[term], return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, place, weight)
    best = np.lexsort((key & 0xFFFFFFFF, -total, key >> 32))
    of, first = np.unique((key >> 32)[best], return_index=True)
    out = np.full(len(sizes), -1, np.int64)
    out[of] = (key & 0xFFFFFFFF)[best][first]
    return doc, term, weight, out


def _votes(topic):
    """The weight with which a task's tails call each of their heavy terms one of their topic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, term, weight, of = _topics(batch, topic.value)
            key, place = np.unique(term << 32 | of[doc], return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, place, weight)
            yield pa.RecordBatch.from_arrays([pa.array(key >> 32, pa.int32()), pa.array(key & 0xFFFFFFFF, pa.int32()), pa.array(total)],
                                             ["term", "topic", "weight"])
    return run


def _place(topic):
    """Tails with the key they are dealt by: topic and the two heavy terms with the smallest hashes (-1: none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, term, _, of = _topics(batch, topic.value)
            order = np.lexsort((mix(term.astype(np.uint64) * MULTIPLIER), doc))
            first = np.searchsorted(doc, np.arange(batch.num_rows))
            size = np.searchsorted(doc, np.arange(batch.num_rows), "right") - first
            keys = []
            for k in (0, 1):
                has = np.flatnonzero(size > k)
                x = np.full(batch.num_rows, -1, np.int64)
                x[has] = term[order[first[has] + k]]
                keys.append(pa.array(x))
            kept = [batch[c] for c in _ROW]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(of), *keys], [*_ROW, "_topic", "_first", "_second"])
    return run


class Index:
    """BM25 inverted index of the tails of one shard; idf of each term and the mean length are those of all tails
    (without them, those of the shard)."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray | None = None, mean: float | None = None):
        n = len(tails)
        sizes = np.array([len(t) for t in tails])
        doc, term, tf = term_counts(tails)
        order = by_value(term)
        first = np.flatnonzero(np.diff(term[order], prepend=-1))
        self.terms, df = term[order[first]], np.diff(np.append(first, len(order)))
        inverse = np.empty(len(term), np.int64)
        inverse[order] = np.repeat(np.arange(len(first)), df)
        idf = idf_of(df, n) if idf is None else idf[self.terms]
        weight = bm25(idf[inverse], tf, sizes[doc], sizes.mean() if mean is None else mean)
        keep = weight > 0
        doc, inverse, weight = doc[keep], inverse[keep], weight[keep]
        self.of_doc = np.searchsorted(doc, np.arange(n + 1))  # doc's terms are term[of_doc[i]:of_doc[i + 1]]
        self.doc_terms = inverse
        order = by_value(inverse)
        self.first = np.searchsorted(inverse[order], np.arange(len(self.terms) + 1))
        self.post_doc, self.post_weight, self.n = doc[order], weight[order], n

    def scores(self, i: int) -> np.ndarray:
        """The score of every tail for tail ``i`` as the query."""
        t = self.doc_terms[self.of_doc[i]:self.of_doc[i + 1]]
        sizes = self.first[t + 1] - self.first[t]
        at = np.repeat(self.first[t] - np.concatenate(([0], np.cumsum(sizes[:-1]))), sizes) + np.arange(sizes.sum()) if len(t) else t
        return np.bincount(self.post_doc[at], weights=self.post_weight[at], minlength=self.n)


def pack_tails(tails: list[np.ndarray], window: int, idf: np.ndarray | None = None, mean: float | None = None) -> list[tuple[int, int, int, int, int]]:
    """(tail, start, length, sequence, offset) of every piece; all tails shorter than the window and not empty."""
    if not tails:
        return []
    index, out = Index(tails, idf, mean), []
    size, start = np.array([len(t) for t in tails]), np.zeros(len(tails), np.int64)
    unused = np.ones(len(tails), bool)
    by_size, seq, rest = iter(np.argsort(-size, kind="stable").tolist()), 0, -1
    while True:
        seed = rest if rest >= 0 else next((i for i in by_size if unused[i]), -1)
        if seed < 0:
            return out
        rest, space = -1, window
        unused[seed] = False
        out.append((seed, int(start[seed]), int(size[seed]), seq, 0))
        space -= int(size[seed])
        if space:
            score = np.where(unused, index.scores(seed), -1.0)
        while space and unused.any():
            best = np.argpartition(-score, min(TOP, len(score) - 1))[:TOP]
            best = best[np.argsort(-score[best], kind="stable")]
            best = best[unused[best]]
            fits = best[size[best] <= space]
            i = int(fits[0] if len(fits) else best[0])
            take = min(space, int(size[i]))
            out.append((i, int(start[i]), take, seq, window - space))
            unused[i], score[i], space = False, -1.0, space - take
            if take < size[i]:
                start[i], size[i], rest = start[i] + take, size[i] - take, i
        seq += 1


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Columns of a tail on its way to its shard.
_ROW = ["_row", "_id", "_size", "_crcs", "_tail"]


def _pack(window: int, stats):
    """The tails of a partition are a shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seq, rows = TaskContext.get().partitionId() << 32, 0, []
        _, idf, mean = stats.value
        docs = sorted((r for batch in batches for r in zip(*(batch[c].to_pylist() for c in _ROW))), key=lambda r: r[0])
        tails, of = [], []
        for i, (_, doc, size, crcs, raw) in enumerate(docs):
            for j, crc in enumerate(crcs):
                rows.append((doc, j * window, window, crc, size, shard + seq, 0))
                seq += 1
            if size % window:
                tails.append(read_tail(raw, size, window))
                of.append((i, len(crcs) * window))
        for t, start, length, s, offset in pack_tails(tails, window, idf, mean):
            i, base = of[t]
            crc = zlib.crc32(tails[t][start:start + length].astype("<u4").tobytes())
            rows.append((docs[i][1], base + start, length, crc, docs[i][2], shard + seq + s, offset))
        columns = zip(*rows) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in _PIECES.split(", ")])
    return run


def pack(df: DataFrame, window: int = WINDOW, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: where it begins in its document and where it lies in its sequence."""
    spark = bounded_batches(df.sparkSession)
    send = spark.sparkContext.broadcast
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    tokens = stored(rows.mapInArrow(tidy(_tokenize(path or tokenizer_path(), window)), "_id long, _size long, _crcs array<bigint>, _tail binary"))
    left = F.col("_size") % window
    n, total, count = tokens.select(F.count(F.nullif(left, F.lit(0))), F.coalesce(F.sum(left), F.lit(0)), F.count(F.lit(1))).first()
    # two columns of at most as many rows as the vocabulary has ids
    got = tokens.select("_tail", "_size").mapInArrow(tidy(_frequencies(window)), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    terms = got["term"].to_numpy()
    freq = np.zeros(int(terms.max(initial=0)) + 1, np.int64)
    freq[terms] = got["n"].to_numpy()
    stats = send((freq, idf_of(freq, n), total / max(n, 1)))
    numbered = tokens.withColumn("_row", F.monotonically_increasing_id()).select(*_ROW)
    shape = "_row long, _id long, _size long, _crcs array<bigint>, _tail binary"
    marked = stored(numbered.mapInArrow(tidy(_mark(window, stats)), f"{shape}, _terms array<int>, _weights array<int>"))
    discard(tokens)
    topic = np.arange(len(freq))
    for _ in range(ROUNDS):
        votes = marked.select("_terms", "_weights").mapInArrow(tidy(_votes(send(topic))), "term int, topic int, weight long")
        best = votes.groupBy("term", "topic").agg(F.sum("weight").alias("w")).groupBy("term").agg(
            F.max_by("topic", F.struct("w", -F.col("topic"))).alias("topic")).toArrow()  # at most the vocabulary
        topic = topic.copy()
        topic[best["term"].to_numpy()] = best["topic"].to_numpy()
    placed = marked.mapInArrow(tidy(_place(send(topic))), f"{shape}, _topic long, _first long, _second long")
    dealt = placed.repartitionByRange(max(1, -(-count // shard_rows)), "_topic", "_first", "_second", "_row")
    return dealt.mapInArrow(tidy(_pack(window, stats)), _PIECES)
