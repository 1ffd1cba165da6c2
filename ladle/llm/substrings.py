"""Substring dedup with suffix automata of reference shards.

A window is ``window`` consecutive words of one document; a word is removed if a
window over it also starts in a document with a smaller id. All windows of all
documents against each other would be the square of the corpus, so texts meet in
three steps, each exact:

1. Anchors. Of the runs of ``anchor`` words inside a window the one with the
   smallest hash is the window's anchor; equal windows have equal anchors. Chunks
   of documents ask (``exchange``) which of their anchors other documents have.
   A window whose anchor is nowhere else is nowhere else.
2. Sources. The windows left ask for the smallest id that holds them.
   Consecutive windows with the same source make a passage; the windows of which
   a document is itself the first holder make that document's reference shard.
3. Automata. The suffix automaton of each reference shard (over words) goes to
   the passages that name it as their source; passages stream through it for
   matching statistics: at each word, the longest match that ends there. The
   maximal spans where it reaches ``window`` words are what is removed. Equal
   passages of many documents stream once. A shard with many passages is sent to
   several tasks, each with a bounded number of them.

Steps 1 and 2 go by 64-bit hashes and may name a wrong source only if two
hashes collide; the automaton compares words themselves, so nothing is removed
that isn't repeated.

Defined results: a null or empty text has no words and keeps the empty text; a
document shorter than a window keeps all; rows with a null id are returned
unchanged and are no source; rows that repeat an id aren't each other's source;
an empty table gives no rows. Words are judged on the input, not on what is left
of it. Extra columns are kept by ``remove_repeats`` and not read by ``digests``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import Words, bounded_batches, chunks, gram_hashes, partitions, release, stored, tidy
from ladle.llm.exchange import ANSWER, QUESTION, aligned, answers, ask, flat_lists, numbers, part_of, question
from ladle.plans.scale import discard

WINDOW = 13
ANCHOR = 6
CHUNK = 2 << 20
#: Passages streamed through one copy of a reference shard.
PASSAGES_PER_TASK = 2000

_TEXTS = "_chunk long, _ids array<bigint>, _marks array<bigint>, _packed binary, _sizes array<bigint>, _anchors array<int>, _more array<byte>, _cuts array<int>"


class SuffixAutomaton:
    """Suffix automaton of a few sequences of words; no match spans two of them."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for s in sequences:
            last = 0
            for word in s:
                last = self._extend(last, word)

    def _state(self, length: int, link: int, arcs: dict[bytes, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(arcs)
        return len(self.length) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """A copy of q that ends after p's strings only; p and its suffixes lead to it."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        q = self.next[last].get(word)
        if q is not None:  # an earlier sequence has this string already
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def matching(self, words: list[bytes]) -> list[int]:
        """For each word, the length of the longest match that ends there."""
        state = length = 0
        out = []
        for word in words:
            while word not in self.next[state] and state:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                state = length = 0
            out.append(length)
        return out

    def spans(self, words: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal (start, end) of words covered by matches of ``least`` words or more."""
        out: list[tuple[int, int]] = []
        for i, n in enumerate(self.matching(words)):
            if n >= least:  # matches begin no earlier than those before them
                start = out.pop()[0] if out and i + 1 - n <= out[-1][1] else i + 1 - n
                out.append((start, i + 1))
        return out


def anchors(h: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, anchor hash) of every window, and the text it is in."""
    grams, _ = gram_hashes(h, np.array([0, len(h)]), anchor)
    width = window - anchor + 1
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low, reach = grams, 1
    while reach * 2 <= width:
        low, reach = np.minimum(low[:-reach], low[reach:]), reach * 2
    low = np.minimum(low[:n], low[width - reach:width - reach + n])
    size = np.diff(first)
    last = np.repeat(first[1:], size)[:n]
    start = np.flatnonzero(np.arange(n) + window <= last)
    return start, low[start], np.repeat(np.arange(len(size)), size)[start]


def shared_in(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their smallest owner, and whether they have another one."""
    order = np.lexsort((owner, keys))
    k, o = keys[order], owner[order]
    if not len(k):
        return k, o, np.zeros(0, bool)
    start = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    end = np.append(start[1:], len(k)) - 1
    return k[start], o[start], o[start] != o[end]


def _by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys by part, and where each part begins in it."""
    part = part_of(keys, parts)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _read(window: int, anchor: int, parts: int):
    """Chunks of documents: their texts, packed, and their distinct anchors by part, 32 bits of each (two that
    are taken for one only send windows on to the next step), with whether two of its documents have it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 32
        pack = zstandard.ZstdCompressor(level=1)
        one = lambda a, kind=pa.int64(): pa.array([a], pa.list_(kind))
        for batch in batches:
            for i, j, flat, at in chunks(batch["_text"], CHUNK):
                w = Words(flat, at)
                start, low, doc = anchors(w.hashes(), w.first, window, anchor)
                ids = batch["_id"].slice(i, j - i).to_numpy(zero_copy_only=False)
                keys, _, more = shared_in(low, ids[doc])
                order, cuts = _by_part(keys, parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int64()), one(ids), one(batch["_mark"].slice(i, j - i)), pa.array([pack.compress(flat.tobytes())], pa.binary()),
                     one(np.diff(at)), one(keys[order].astype(np.uint32).view(np.int32), pa.int32()), one(more[order].astype(np.int8), pa.int8()),
                     one(cuts.astype(np.int32), pa.int32())],
                    ["_chunk", "_ids", "_marks", "_packed", "_sizes", "_anchors", "_more", "_cuts"])
                n += 1
    return run


def _ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of question for each chunk and part."""
    for batch in batches:
        for i in range(batch.num_rows):
            cuts = numbers(batch["_cuts"], i)
            used = np.flatnonzero(np.diff(cuts))
            if len(used):
                offsets = pa.array(np.append(cuts[used], cuts[-1]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, batch[c][i].values) for c in ("_anchors", "_more")]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), batch["_chunk"][i].as_py()), pa.int64()), pa.array(used, pa.int32()), *lists],
                                                 ["_chunk", "_part", "_keys", "_values"])


def _is_shared(table: pa.Table) -> pa.Table:
    """1 for keys that two chunks hold, or two documents of one."""
    keys, place, n = np.unique(flat_lists(table["_keys"]), return_inverse=True, return_counts=True)
    more = np.zeros(len(keys), np.int64)
    np.maximum.at(more, place, flat_lists(table["_values"]))
    return answers(table, ((n > 1) | (more > 0)).astype(np.int64)[place])


#: The answer for a key that one document alone holds.
_ALONE = np.iinfo(np.int64).max


def _first_holder(table: pa.Table) -> pa.Table:
    """For every key its smallest owner's id, or ``_ALONE`` if it has no other one."""
    keys, place = np.unique(flat_lists(table["_keys"]), return_inverse=True)
    owner = flat_lists(table["_values"])
    low, high = np.full(len(keys), _ALONE), np.full(len(keys), np.iinfo(np.int64).min)
    np.minimum.at(low, place, owner)
    np.maximum.at(high, place, owner)
    return answers(table, np.where(high > low, low, _ALONE)[place])


_RUNS = "_chunk long, _ids array<bigint>, _marks array<bigint>, _starts array<bigint>, _packed binary, _sizes array<bigint>"


def _runs(parts: int, window: int, anchor: int):
    """Of each chunk the runs of windows whose anchors are shared: their documents, first words and texts."""
    def run(chunk: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        pack = zstandard.ZstdCompressor(level=1)
        for i in range(chunk.num_rows):
            flat, at = _unpack(chunk, i)
            w = Words(flat, at)
            start, low, doc = anchors(w.hashes(), w.first, window, anchor)
            keys = np.unique(low)
            shared = keys[aligned(keys, parts, replies) > 0]
            keep = np.isin(low, shared)
            start, doc = start[keep], doc[keep]
            # consecutive windows of one document make a run of words
            cut = np.flatnonzero(np.append(True, (start[1:] != start[:-1] + 1) | (doc[1:] != doc[:-1]))) if len(start) else np.zeros(0, np.int64)
            first, last = start[cut], start[np.append(cut[1:], len(start)) - 1] + window if len(start) else start[cut]
            texts = [b" ".join(flat[w.starts[s]:w.ends[e - 1]].tobytes().split()) for s, e in zip(first, last)]
            lists = [numbers(chunk["_ids"], i)[doc[cut]], numbers(chunk["_marks"], i)[doc[cut]], first - w.first[doc[cut]]]
            out.append(pa.table([chunk["_chunk"].slice(i, 1), *[pa.array([x], pa.list_(pa.int64())) for x in lists],
                                 pa.array([pack.compress(b"".join(texts))], pa.binary()), pa.array([[len(t) for t in texts]], pa.list_(pa.int64()))],
                                names=["_chunk", "_ids", "_marks", "_starts", "_packed", "_sizes"]))
        release()
        return pa.concat_tables(out)
    return run


def _windows(runs: pa.Table | pa.RecordBatch, i: int, window: int) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray, np.ndarray]:
    """The runs of row ``i``: bytes, offsets, words, and of each window its hash and its run."""
    flat, at = _unpack(runs, i)
    w = Words(flat, at)
    grams, where = gram_hashes(w.hashes(), w.first, window)
    return flat, at, w, grams, w.doc[where]


def _asked(runs: pa.Table | pa.RecordBatch, i: int, grams: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys to ask about and an owner for each: all distinct windows with their smallest id, then (from the returned
    place on) once more those that another document of the chunk has too, with their largest."""
    owner = numbers(runs["_ids"], i)[of]
    keys, low, more = shared_in(grams, owner)
    high = -shared_in(grams, -owner - 1)[1] - 1
    return np.concatenate((keys, keys[more])), np.concatenate((low, high[more])), len(keys)


def _ask_windows(parts: int, window: int):
    """Questions about the windows of each chunk's runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                *_, grams, of = _windows(batch, i, window)
                keys, owner, _ = _asked(batch, i, grams, of)
                q = question(batch["_chunk"][i].as_py(), keys, owner, parts)
                if q is not None:
                    yield q
    return run


def _unpack(chunk: pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
    size = numbers(chunk["_sizes"], i)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(chunk["_packed"][i].as_py()), np.uint8) if size.sum() else np.zeros(0, np.uint8)
    return flat, np.concatenate(([0], np.cumsum(size)))


_PASSAGES = "_source long, _id long, _mark long, _start long, _text binary"


def _passages(parts: int, window: int):
    """Passages with their source (``_id`` null: part of that source's reference shard)."""
    def run(runs: pa.Table, replies: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for i in range(runs.num_rows):
            flat, at, w, grams, of = _windows(runs, i, window)
            keys, _, n_keys = _asked(runs, i, grams, of)
            source = aligned(keys, parts, replies)[np.searchsorted(keys[:n_keys], grams)]
            own = numbers(runs["_ids"], i)[of]
            marks, begins = numbers(runs["_marks"], i), numbers(runs["_starts"], i)
            edge = np.flatnonzero(np.append(True, (source[1:] != source[:-1]) | (of[1:] != of[:-1]))) if len(of) else of
            first = np.searchsorted(of, np.arange(len(at)))  # each run's first window
            for s, e in zip(edge.tolist(), np.append(edge[1:], len(of)).tolist()):
                r = int(of[s])
                if source[s] <= own[s] and source[s] != _ALONE:
                    n = s - int(first[r])
                    part = flat[w.starts[w.first[r] + n]:w.ends[w.first[r] + n + e - s + window - 2]].tobytes()
                    rows.append((int(source[s]), None if source[s] == own[s] else int(own[s]), int(marks[r]), int(begins[r]) + n, part))
        return pa.table([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                        names=["_source", "_id", "_mark", "_start", "_text"])
    return run


def _match(window: int):
    """Stream the passages of each shard through its automaton; a table holds some whole shards."""
    def run(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        shards: dict[tuple, tuple[list, list]] = {}
        for source, salt, key, text, r in zip(*[table[c].to_pylist() for c in ("_source", "_salt", "_key", "_text", "_reference")]):
            shards.setdefault((source, salt), ([], []))[0 if r else 1].append((key, text.split(b" ")))
        for (source, _), (reference, passages) in shards.items():
            automaton = SuffixAutomaton([words for _, words in reference])
            out += [(source, key, s, e) for key, words in passages for s, e in automaton.spans(words, window)]
        return pa.table([pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.binary(), pa.int64(), pa.int64()))],
                        names=["_source", "_key", "_from", "_to"])
    return run


def repeated_spans(df: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _mark, _spans): of each document that windows of documents with smaller ids cover, the
    spans (first word, last + 1) they cover; ``_mark`` is the xxhash64 of its text."""
    parts = partitions(bounded_batches(df.sparkSession))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.xxhash64(text).alias("_mark"), text.alias("_text")).where("_id IS NOT NULL")
    read = stored(rows.mapInArrow(tidy(_read(window, anchor, parts)), _TEXTS))
    asked = read.select("_chunk", "_anchors", "_more", "_cuts").mapInArrow(tidy(_ask_anchors), "_chunk long, _part int, _keys array<int>, _values array<byte>")
    shared = ask(asked, parts, _is_shared, ANSWER)
    runs = stored(read.select("_chunk", "_ids", "_marks", "_packed", "_sizes").groupBy("_chunk").cogroup(shared.groupBy("_chunk")).applyInArrow(_runs(parts, window, anchor), _RUNS))
    discard(read)
    holders = ask(runs.select("_chunk", "_ids", "_packed", "_sizes").mapInArrow(tidy(_ask_windows(parts, window)), QUESTION), parts, _first_holder, ANSWER)
    found = stored(runs.groupBy("_chunk").cogroup(holders.groupBy("_chunk")).applyInArrow(_passages(parts, window), _PASSAGES)
                   .withColumn("_key", F.unhex(F.sha2("_text", 256))))
    discard(runs)
    # equal passages stream once; a shard goes to one task for every PASSAGES_PER_TASK of them
    passages = found.where("_id IS NOT NULL").groupBy("_source", "_key").agg(F.first("_text").alias("_text"))
    tasks = passages.groupBy("_source").agg(F.ceil(F.count(F.lit(1)) / PASSAGES_PER_TASK).cast("int").alias("_tasks"))
    salted = passages.join(tasks, "_source").withColumn("_salt", F.pmod(F.xxhash64("_key"), F.col("_tasks")).cast("int"))
    shards = found.where("_id IS NULL").join(tasks, "_source").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1)))
    cols = ["_source", "_salt", "_key", "_text"]
    both = salted.select(*cols, F.lit(False).alias("_reference")).unionByName(shards.select(*cols, F.lit(True).alias("_reference")))
    table = F.pmod(F.xxhash64("_source", "_salt"), F.lit(4 * parts))
    matched = both.groupBy(table).applyInArrow(_match(window), "_source long, _key binary, _from long, _to long")
    at = F.struct((F.col("_start") + F.col("_from")).alias("_from"), (F.col("_start") + F.col("_to")).alias("_to"))
    return found.where("_id IS NOT NULL").select("_source", "_key", "_id", "_mark", "_start").join(matched, ["_source", "_key"]).groupBy(
        "_id", "_mark").agg(F.collect_set(at).alias("_spans"))


def _kept(w: Words, i: int, spans: list[dict]) -> tuple[list[bytes], int]:
    """Words left of text ``i`` and how many it had."""
    lo, n = w.first[i], w.per_doc[i]
    keep = np.ones(n, bool)
    for s in spans:
        keep[s["_from"]:s["_to"]] = False
    return [w.word(lo + j) for j in np.flatnonzero(keep)], int(n)


_LEFT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        spans = batch["_spans"]
        for i, j, flat, at in chunks(batch["_text"]):
            w = Words(flat, at)
            for r in range(i, j):
                own = spans[r].as_py() or []
                if own:
                    kept, n = _kept(w, r - i, own)
                else:
                    n = int(w.per_doc[r - i])
                    kept = flat[at[r - i]:at[r - i + 1]].tobytes().split()
                out.append((batch["_id"][r].as_py(), n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["_text"].to_pylist()
        for r, spans in enumerate(batch["_spans"].to_pylist()):
            if spans:
                flat = np.frombuffer(texts[r].encode(), np.uint8)
                texts[r] = b" ".join(_kept(Words(flat, np.array([0, len(flat)])), 0, spans)[0]).decode()
        names = batch.schema.names[:-2]
        yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], pa.array(texts, pa.string())], [*names, "_text"])


def _with_spans(df: DataFrame, id_col: str, text_col: str, window: int, anchor: int) -> DataFrame:
    spans = repeated_spans(df, window, anchor, id_col, text_col)
    mark = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return df.withColumns({"_id": F.col(f"`{id_col}`").cast("long"), "_mark": mark}).join(spans, ["_id", "_mark"], "left")


def digests(df: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document how many words it has, how many go, and the hash of what is kept."""
    rows = df.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{text_col}`").alias("_text"))
    return _with_spans(rows, "_doc", "_text", window, anchor).select("_id", "_text", "_spans").mapInArrow(tidy(_digest), _LEFT)


def remove_repeats(df: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the repeated words, same rows and columns. A text that loses words has the others
    joined by one space; a text that loses none is as it was, null too."""
    cols = [f"`{c}`" for c in df.columns]
    inner = [f"_c{i}" for i in range(len(cols))]  # names of their own: the input's may be anything
    named = df.select(*[F.col(c).alias(n) for c, n in zip(cols, inner)])
    text = inner[df.columns.index(text_col)]
    rows = _with_spans(named, inner[df.columns.index(id_col)], text, window, anchor)
    others = [n for n in inner if n != text]
    schema = ", ".join(f"{n} {named.schema[n].dataType.simpleString()}" for n in others)
    out = rows.select(*others, F.col(text).alias("_text"), "_spans").mapInArrow(tidy(_rewrite), f"{schema}, _text string")
    return out.select(*[F.col("_text" if n == text else n).alias(c) for n, c in zip(inner, df.columns)])
