"""SentencePiece encoding and decoding by suffix-array matching.

The vocabulary is a byte-fallback BPE model (identity normalizer, a space put
before each text). No piece holds a space after another character, so a text is
the sequence of its words (spaces first) and each distinct word is encoded once
per task. The new words of a batch are one concatenated text:

1. its suffix array is built by prefix doubling up to the longest piece;
2. every piece of the vocabulary is binary-searched in it, all pieces at once;
   its range gives all its occurrences, the edges of the words' lattices;
3. the edges are sorted by the position they end at;
4. they are relaxed in that order. BPE's encoding of a prefix ends in one token;
   an edge extends the encoding of the prefix before it exactly if BPE would keep
   its token and that prefix's last token apart, which is looked up by undoing
   the merges of both, latest first. So each position keeps its one right edge,
   and following them back from a word's end gives the ids of the model's own
   encoder (tests compare them), not only a best-scored path.

Words with runs of spaces go through the merges directly: the model scores all
its pieces of spaces alike.

Decoding joins the pieces, byte pieces as bytes, turns the space mark into
spaces and takes off the first. It restores every text without the mark.

Defined results: null and empty texts have no ids; a null list of ids decodes to
null; the space mark in a text counts as a space, as in the model; ids and other
columns are kept as they are; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import bounded_batches, tidy

MARK = "\u2581"
#: Characters of new words that are indexed at once, and words that a task remembers.
INDEX_CHARS = 400_000
MEMORY_WORDS = 250_000
SLICE_ROWS = 1000
_WORD = re.compile(f"{MARK}*[^{MARK}]*")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces, how merges form them, and which neighbours merges keep apart.

    A token is a piece's id, or a number from ``len(pieces)`` on for a single
    character that pieces hold but that is none; ``unknown`` is any other character."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.own = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.silent = [i for i in range(n) if model.is_control(i) or model.is_unknown(i)]
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.of = {self.pieces[i]: i for i in plain}
        for c in sorted({c for p in self.of for c in p} - set(self.of)):
            self.of[c] = len(self.pieces)
            self.pieces.append(c)
        self.unknown = len(self.pieces)
        self.score = {t: model.get_score(t) if t < n else 0.0 for t in self.of.values()}
        order = sorted((t for t in plain if len(self.pieces[t]) > 1), key=lambda t: -self.score[t])
        self.rank = np.full(self.unknown + 1, -1, np.int64)  # -1: a single character, never merged into being
        for r, t in enumerate(order):
            self.rank[t] = r
        self.left, self.right = np.zeros(self.unknown + 1, np.int64), np.zeros(self.unknown + 1, np.int64)
        usable = [t for t in self.of.values() if len(self.pieces[t]) == 1]
        for t in order:
            parts, last = self.merge(self.pieces[t])
            if len(parts) == 1:
                self.left[t], self.right[t] = last
                usable.append(t)
        pairs = {}
        for t in order:
            p = self.pieces[t]
            for i in range(1, len(p)):
                a, b = self.of.get(p[:i]), self.of.get(p[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = int(self.rank[t])
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        # the pieces as rows of characters, for the search
        self.tokens = np.array(sorted(usable), np.int64)
        self.sizes = np.array([len(self.pieces[t]) for t in self.tokens], np.int64)
        self.longest = int(self.sizes.max())
        self.matrix = np.zeros((len(self.tokens), self.longest), np.int32)
        for i, t in enumerate(self.tokens):
            self.matrix[i, :self.sizes[i]] = codes(self.pieces[t])
        self.size = np.ones(self.unknown + 1, np.int64)
        self.size[self.tokens] = self.sizes
        self.known_keys, self.known = np.zeros(0, np.int64), np.zeros(0, bool)
        self._late: list[tuple[np.ndarray, np.ndarray]] = []
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        table = [p.encode("utf-8", "surrogatepass") for p in self.pieces[:self.own]]
        for b, t in self.bytes.items():
            table[t] = bytes([b])
        for t in self.silent:
            table[t] = b""
        self.table = table

    def merge(self, word: str) -> tuple[list[int], tuple[int, int]]:
        """BPE step by step: tokens of ``word`` and the two that the last merge joined."""
        parts, last = [self.of.get(c, -1) for c in word], (0, 0)
        text = list(word)
        while True:
            best = None
            for i in range(len(parts) - 1):
                t = self.of.get(text[i] + text[i + 1])
                if t is not None and (best is None or self.score[t] > best[0]):
                    best = (self.score[t], i, t)
            if best is None:
                return parts, last
            _, i, t = best
            last = (parts[i], parts[i + 1])
            parts[i:i + 2] = [t]
            text[i:i + 2] = [text[i] + text[i + 1]]

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves token ``a`` and the ``b`` after it as they are."""
        key = a << 32 | b
        if len(self.known_keys):
            at = np.minimum(np.searchsorted(self.known_keys, key), len(self.known_keys) - 1)
            hit = self.known_keys[at] == key
            out = self.known[at] & hit
        else:
            hit, out = np.zeros(len(key), bool), np.zeros(len(key), bool)
        new = np.flatnonzero(~hit)
        if len(new):
            fresh, back = np.unique(key[new], return_inverse=True)
            result = self._undo(fresh >> 32, fresh & 0xFFFFFFFF)
            out[new] = result[back]
            self._late.append((fresh, result))
        return out

    def _undo(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Take back the merges on both sides of the border, latest first; the pair falls if, at any
        time, the two symbols at the border would have merged before either went into what it became."""
        x, y = x.copy(), y.copy()
        gone_x = np.full(len(x), np.iinfo(np.int64).max)
        gone_y = gone_x.copy()
        ok = np.ones(len(x), bool)
        active = np.flatnonzero((x != self.unknown) & (y != self.unknown))
        while len(active):
            a, b = x[active], y[active]
            key = a << 32 | b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            merged = self.pair_keys[at] == key
            r = self.pair_rank[at]
            # of two equal merges the one further left comes first
            ok[active[merged & (r < gone_x[active]) & (r <= gone_y[active])]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ok[active] & ((ra >= 0) | (rb >= 0))
            active, a, b, ra, rb = active[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb
            i, j = active[first], active[~first]
            gone_x[i], x[i] = ra[first], self.right[a[first]]
            gone_y[j], y[j] = rb[~first], self.left[b[~first]]
        return ok

    def remember(self) -> None:
        """Keep the pairs looked up since the last call."""
        if self._late:
            keys = np.concatenate([self.known_keys, *[k for k, _ in self._late]])
            values = np.concatenate([self.known, *[v for _, v in self._late]])
            self.known_keys, first = np.unique(keys, return_index=True)
            self.known = values[first]
            self._late.clear()
        if len(self.known_keys) > 4_000_000:
            self.known_keys, self.known = np.zeros(0, np.int64), np.zeros(0, bool)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def codes(text: str) -> np.ndarray:
    """Code points, from 1 on; 0 is left for the space between words."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32) + 1


def suffix_array(text: np.ndarray, reach: int) -> np.ndarray:
    """Positions in the order of (at least) the ``reach`` characters that follow, by prefix doubling from three."""
    wide = np.append(text, [0, 0]).astype(np.int64)
    key, h = wide[:-2] << 42 | wide[1:-1] << 21 | wide[2:], 3
    while h < reach:
        rank = np.unique(key, return_inverse=True)[1]
        after = np.zeros(len(rank), np.int64)
        after[:-h] = rank[h:] + 1
        key, h = rank * (len(rank) + 1) + after, 2 * h
    return np.argsort(key, kind="stable").astype(np.int32)


def ranges(text: np.ndarray, order: np.ndarray, matrix: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every piece the range of suffixes that begin with it, by binary search of all pieces at once."""
    padded = np.append(text, np.zeros(matrix.shape[1], text.dtype))

    def search(after: bool) -> np.ndarray:
        lo, hi = np.zeros(len(sizes), np.int64), np.full(len(sizes), len(order), np.int64)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            at = order[mid]
            less, same = np.zeros(len(open_), bool), np.arange(len(open_))
            for c in range(matrix.shape[1] + 1):
                ends = sizes[open_[same]] == c
                less[same[ends]] = after  # the suffix begins with the piece
                same = same[~ends]
                if not len(same):
                    break
                x, y = padded[at[same] + c], matrix[open_[same], c]
                less[same[x < y]] = True
                same = same[x == y]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo
    return search(False), search(True)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * 31 + b) & 0xFFFF


def encode_words(v: Vocabulary, words: list[str]) -> list[bytes]:
    """Ids (little-endian, four bytes each) of distinct words."""
    text = codes("".join(w + "\0" for w in words))
    size = np.array([len(w) for w in words], np.int64)
    begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    text[begin + size] = 0
    word = np.repeat(np.arange(len(words), dtype=np.int32), size + 1)
    order = suffix_array(text, v.longest)
    seen = np.zeros(1 << 16, bool)  # pairs of characters that come up, hashed: other pieces needn't be looked for
    seen[_pair(text[:-1], text[1:])] = True
    there = np.flatnonzero((v.sizes == 1) | seen[_pair(v.matrix[:, 0], v.matrix[:, 1])])
    lo, hi = ranges(text, order, v.matrix[there], v.sizes[there])
    n = hi - lo
    start = order[np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
    token = np.repeat(v.tokens[there].astype(np.int32), n)
    covered = np.zeros(len(text), bool)
    covered[start[v.size[token] == 1]] = True
    alone = np.flatnonzero(~covered & (text > 0))  # characters that no piece holds
    start = np.concatenate((start, alone.astype(np.int32)))
    token = np.concatenate((token, np.full(len(alone), v.unknown, np.int32)))
    end = start + v.size[token].astype(np.int32)
    place = end - begin[word[start]].astype(np.int32)
    by_end = np.argsort(place.astype(np.uint16) if size.max(initial=0) < 1 << 16 else place, kind="stable")  # 16 bits: a radix sort
    start, token, end = start[by_end], token[by_end], end[by_end]
    cuts = np.concatenate(([0], np.cumsum(np.bincount(place, minlength=size.max(initial=0) + 1)[1:])))
    last = np.full(len(text) + 1, -1, np.int64)  # the token that ends at each position
    first = np.zeros(len(text) + 1, bool)
    first[begin] = True
    for i, j in zip(cuts[:-1], cuts[1:]):
        s, t = start[i:j], token[i:j]
        before = last[s]
        at_first = first[s]
        ok = at_first | (before >= 0)
        check = np.flatnonzero(ok & ~at_first)
        if len(check):
            ok[check] = v.apart(before[check], t[check].astype(np.int64))
        last[end[i:j][ok]] = t[ok]
    v.remember()
    # back from each word's end
    at, live = begin + size, np.flatnonzero(size > 0)
    found_word, found_token, found_at = [], [], []
    while len(live):
        t = last[at[live]]
        at[live] -= v.size[t]
        found_word.append(live)
        found_token.append(t)
        found_at.append(at[live])
        live = live[at[live] > begin[live]]
    if not found_word:
        return [b""] * len(words)
    w, t, p = (np.concatenate(x) for x in (found_word, found_token, found_at))
    order = np.lexsort((p, w))
    w, t, p = w[order], t[order], p[order]
    cut = np.searchsorted(w, np.arange(len(words) + 1)) * 4
    raw = t.astype("<u4").tobytes()
    out = [raw[cut[i]:cut[i + 1]] for i in range(len(words))]
    for i in np.unique(w[t >= v.own]).tolist():  # characters without a piece
        ids: list[int] = []
        for k in range(cut[i] // 4, cut[i + 1] // 4):
            ids += [int(t[k])] if t[k] < v.own else [v.bytes[b] for b in words[i][p[k] - begin[i]].encode("utf-8", "surrogatepass")]
        out[i] = np.array(ids, "<u4").tobytes()
    return out


def split_words(text: str) -> list[str]:
    """Words of a text, each with the space marks before it."""
    text = MARK + text.replace(" ", MARK)
    if MARK + MARK in text or text[-1] == MARK:
        return [w for w in _WORD.findall(text) if w]
    return [MARK + w for w in text[1:].split(MARK)]


def _encode_batch(v: Vocabulary, texts: list[str | None]) -> list[bytes]:
    """Ids of texts (little-endian, four bytes each). Words are remembered in two generations:
    those of the last batches, and of the generation before, from which used ones move up."""
    split = [split_words(t) if t else [] for t in texts]
    if len(v.young) > MEMORY_WORDS:
        v.young, v.old = {}, v.young
    young, old, new = v.young, v.old, []
    for w in set().union(*split):
        if w not in young:
            ids = old.get(w)
            if ids is None:
                new.append(w)
            else:
                young[w] = ids
    for w in new:
        if MARK + MARK in w:
            ids: list[int] = []
            for t, c in _with_characters(v, w):
                ids += [t] if t is not None else [v.bytes[b] for b in c.encode("utf-8", "surrogatepass")]
            young[w] = np.array(ids, "<u4").tobytes()
    new = [w for w in new if MARK + MARK not in w]
    i = 0
    while i < len(new):
        j, n = i, 0
        while j < len(new) and (j == i or n + len(new[j]) < INDEX_CHARS):
            n += len(new[j])
            j += 1
        young.update(zip(new[i:j], encode_words(v, new[i:j])))
        i = j
    return [b"".join([young[w] for w in words]) for words in split]


def _with_characters(v: Vocabulary, word: str) -> Iterator[tuple[int | None, str]]:
    """Tokens by direct merges; None for a character without a piece."""
    parts, _ = v.merge(word)
    at = 0
    for t in parts:
        n = len(v.pieces[t]) if t >= 0 else 1
        yield (t if 0 <= t < v.own else None), word[at:at + n]
        at += n


def _encode(path: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                raw = _encode_batch(v, part["_text"].to_pylist())
                cuts = np.concatenate(([0], np.cumsum([len(r) // 4 for r in raw])))
                flat = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*[part[c] for c in keep], ids], [*keep, "_ids"])
    return run


def _text_of(v: Vocabulary, ids: list[int]) -> str:
    table = v.table
    text = b"".join([table[t] for t in ids]).decode("utf-8", "replace").replace(MARK, " ")
    return text[1:] if text[:1] == " " else text


def _decode(path: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            out = [_text_of(v, ids.values.to_pylist()) if ids.is_valid else None for ids in batch["_ids"]]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], pa.array(out, pa.string())], [*keep, "_text"])
    return run


def _mapped(df: DataFrame, column: str, run, path: str, out_type: str, inner: str, outer: str, out: str) -> DataFrame:
    bounded_batches(df.sparkSession)
    names = [f"_c{i}" for i in range(len(df.columns))]
    named = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)], F.col(f"`{column}`").alias(inner))
    schema = ", ".join(f"{n} {named.schema[n].dataType.simpleString()}" for n in names)
    mapped = named.mapInArrow(run(path, names), f"{schema}, {outer} {out_type}")
    return mapped.select(*[F.col(n).alias(c) for n, c in zip(names, df.columns)], F.col(outer).alias(out))


def encode(df: DataFrame, text_col: str = "text", path: str | None = None, out: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text_col`` in ``out``."""
    return _mapped(df, text_col, _encode, path or model_path(), "array<int>", "_text", "_ids", out)


def decode(df: DataFrame, ids_col: str = "ids", path: str | None = None, out: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids_col`` in ``out``."""
    return _mapped(df, ids_col, _decode, path or model_path(), "string", "_ids", "_text", out)


def _digest(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                texts = part["_text"].to_pylist()
                raw = _encode_batch(v, texts)
                same = [_text_of(v, np.frombuffer(r, "<u4").tolist()) == t for r, t in zip(raw, texts)]
                yield pa.RecordBatch.from_arrays(
                    [part["_id"], pa.array([len(r) // 4 for r in raw], pa.int64()), pa.array([zlib.crc32(r) for r in raw], pa.int64()), pa.array(same)],
                    ["doc_id", "n_ids", "ids_crc32", "round_trip"])
    return run


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per document: how many ids, their crc32, and whether decoding restores the text. Encodes and
    decodes in one pass, so the ids never leave the task."""
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    return rows.mapInArrow(tidy(_digest(path or model_path())), "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")
