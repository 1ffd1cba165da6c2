"""Language-model scoring with a weighted backoff automaton.

Learning. Words (A-Z in lower case), one end per text, and all word pairs and
triples are counted over all training texts, down to those that occur once: chunks
of documents ask about their distinct words and n-grams (``exchange``), so each
chunk gets the corpus count of all it holds, whatever the size of the vocabulary.
Below the words lies a class model: words that are at least 1/250 of all training
tokens are classes of their own (at most 250 words, by their share), all others
are one class, and class n-grams of at least 1/500 000 of all tokens are kept. It
only says what is likely where the words' own n-grams say nothing.

Automaton. A state is the longest known context of up to two words. An arc to
the next word has (count + M * below) / (context's count + M), where ``below`` is
the word's probability in the shorter context. Where a state has no arc, its
failure arc multiplies by M / (context's count + M) and goes on from the shorter
context; the last failure arc leads to the class model (absolute discounting,
interpolated), in which a word of the common class has its own discounted
probability within the class and all unseen words together the mass that
discounting leaves. A chunk has the arcs and failure weights of its own n-grams,
so nothing of the words' automaton is gathered in one place. A text runs through it
once, left to right, and adds up arc and failure weights.

Defined results: a null text is empty and has its end alone; a null id is a
training row; repeated rows count and are scored each; without training rows
all counts are 0; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import MULTIPLIER, Words, bounded_batches, chunks, doc_crc, mix, partitions, release, stored, tidy
from ladle.llm.exchange import (PACKED_ANSWER, PACKED_QUESTION, aligned, answers, ask, expand, flat_lists, numbers, pack_lists, question,
                                range_of, squeeze, unpack_lists)

CLASS_SHARE = 1 / 250
ARC_SHARE = 1 / 500_000
CHUNK = 2 << 20
#: Words, pairs and triples are told apart by the last two bits of their keys: 1, 2 and 3.
END, START = np.uint64(1), np.uint64(2)
#: How many occurrences of a context the shorter one weighs as much as, after one word and after two (the best of
#: four pairs on another fold of sf0.01 than the held-out one).
WEIGHTS = (30.0, 3.0)
#: Questions a part answers, at most about: the number of parts follows the corpus.
PART_KEYS = 4_000_000
#: A pair or triple shares its key with another one in at most one of 2**CLASH_BITS cases, whatever the corpus' size.
CLASH_BITS = 16
#: words, counts and tokens as ``squeeze`` writes them; n_all and n_train: how many tokens there are.
_CHUNKS = ("_chunk long, ids array<bigint>, held array<boolean>, n_tokens array<bigint>, words binary, counts binary, tokens binary, "
           "n_all long, n_train long")


def tagged(h: np.ndarray, order: int) -> np.ndarray:
    return h & ~np.uint64(3) | np.uint64(order)


def gram_bits(tokens: int) -> int:
    """First bits that keys of pairs and triples keep: there are at most 2 * ``tokens`` of them."""
    return min(62, CLASH_BITS + (2 * tokens).bit_length())


def grams(words: np.ndarray, tokens: np.ndarray, size: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each token the keys of the pair and the triple that end there, their first ``bits`` and the tag; a
    text's first token has the triple key 0, as its pair begins at the text's start."""
    first = np.cumsum(size) - size
    h = words[tokens]
    before = np.empty_like(h)
    before[1:], before[first] = h[:-1], START
    two = tagged(mix(mix(before * MULTIPLIER) + h), 2)
    three = np.zeros_like(two)
    three[1:] = tagged(mix(mix(two[:-1] * MULTIPLIER) + h[1:]), 3)
    three[first] = 0
    kept = ~np.uint64((1 << 64 - bits) - 1) | np.uint64(3)
    return two & kept, three & kept


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of documents: tokens as places in the chunk's sorted distinct words, and the training count of each word."""
    n = TaskContext.get().partitionId() << 32
    one = lambda a, kind: pa.array([a], pa.list_(kind))
    for batch in batches:
        for i, j, flat, at in chunks(batch["_text"], CHUNK):
            w = Words(flat, at, lower=True)
            size = w.per_doc + 1
            ends = np.cumsum(size) - 1
            hashes = np.full(size.sum(), END, np.uint64)
            own = np.ones(len(hashes), bool)
            own[ends] = False
            hashes[own] = tagged(w.hashes(), 1)
            words, tokens = np.unique(hashes, return_inverse=True)
            held = batch["_held"].slice(i, j - i)
            train = np.repeat(~held.to_numpy(zero_copy_only=False).astype(bool), size)
            counts = np.bincount(tokens[train], minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), one(batch["_id"].slice(i, j - i), pa.int64()), one(held, pa.bool_()),
                 one(size, pa.int64()), *(pa.array([x], pa.binary()) for x in (squeeze(words, True), squeeze(counts), squeeze(tokens))),
                 pa.array([len(tokens)], pa.int64()), pa.array([train.sum()], pa.int64())],
                ["_chunk", "ids", "held", "n_tokens", "words", "counts", "tokens", "n_all", "n_train"])
            n += 1


def opened(chunk: pa.RecordBatch | pa.Table, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, tokens, token counts of the documents, and which tokens are for training."""
    words, tokens, size = expand(chunk["words"][i].as_py(), True).view(np.uint64), expand(chunk["tokens"][i].as_py()), numbers(chunk["n_tokens"], i)
    return words, tokens, size, np.repeat(~np.array(chunk["held"][i].as_py(), bool), size)


def _questions(parts: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, tokens, size, train = opened(batch, i)
                keys, counts = [words], [expand(batch["counts"][i].as_py())]
                for g in grams(words, tokens, size, bits):
                    k, place = np.unique(g, return_inverse=True)
                    keys.append(k)
                    counts.append(np.bincount(place[train], minlength=len(k)))
                q = question(batch["_chunk"][i].as_py(), np.concatenate(keys), np.concatenate(counts), parts, range_of)
                if q is not None:
                    yield pack_lists(pack_lists(q, "_keys", ascending=True), "_values")
    return run


def _totals(least: int):
    """For every question of a part what the other chunks add to its counts (mostly nothing, as most triples are in one
    chunk only); chunk -1 gets the part's vocabulary figures and its class words."""
    def run(table: pa.Table) -> pa.Table:
        table = unpack_lists(unpack_lists(table, "_keys", ascending=True), "_values")
        keys, place = np.unique(flat_lists(table["_keys"]), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        own = flat_lists(table["_values"])
        np.add.at(total, place, own)
        word = keys & 3 == 1
        common = word & (total >= least)
        rest = total[word & ~common & (keys != int(END))]
        figures = [(word & (total > 0)).sum(), (rest > 0).sum(), rest.sum(), (rest == 1).sum(), (rest == 2).sum()]
        top = np.flatnonzero(common | (keys == int(END)))
        extra = pa.table({"_chunk": pa.array([-1], pa.int64()), "_part": table["_part"].slice(0, 1),
                          "_answers": pa.array([[*figures, *keys[top], *total[top]]], pa.list_(pa.int64()))})
        return pack_lists(pa.concat_tables([answers(table, total[place] - own), extra]), "_answers")
    return run


@dataclass
class Automaton:
    """Class n-grams with interpolated arcs and failure weights; see the module.

    words: sorted hashes of the class words; class 0 is every other word, class
    i the i-th of them, and the last class stands before a text's first token.
    arcs: sorted keys (a * size + b) * size + c of the kept trigrams.
    """

    words: np.ndarray
    arcs: np.ndarray
    arc_logp: np.ndarray
    fail: np.ndarray  # log10 of the mass left by each context of two
    pair_logp: np.ndarray  # log10 p(c | b), complete: every pair has an arc or its failure path folded in

    @property
    def size(self) -> int:
        return len(self.words) + 2

    def classes(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, words), max(0, len(self.words) - 1))
        return np.where(self.words[at] == words, at + 1, 0) if len(self.words) else np.zeros(len(words), np.int64)

    def run(self, cls: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-probability of each token's class; texts begin at ``first``. The state before
        a token is the two classes before it, shortened by failure arcs where they aren't kept."""
        a, b = contexts(cls, first, self.size - 1)
        pair = a * self.size + b
        key = pair * self.size + cls
        at = np.minimum(np.searchsorted(self.arcs, key), max(0, len(self.arcs) - 1))
        hit = self.arcs[at] == key if len(self.arcs) else np.zeros(len(key), bool)
        down = self.fail[pair] + self.pair_logp[b, cls]
        return np.where(hit, self.arc_logp[at], down) if len(self.arcs) else down


def contexts(cls: np.ndarray, first: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The two classes before each token; ``start`` where the text has none."""
    b = np.empty_like(cls)
    b[1:], b[first] = cls[:-1], start
    a = np.empty_like(cls)
    a[1:], a[first] = b[:-1], start
    return a, b


def build(words: np.ndarray, pairs: np.ndarray, keys: np.ndarray, counts: np.ndarray, discount: float = 0.5) -> Automaton:
    """Smooth class counts: ``pairs`` (all bigrams, dense) and the kept trigrams."""
    k = len(words) + 2
    once = pairs.sum(axis=0) + 1.0
    once[k - 1] = 0  # nothing leads to a text's start
    single = once / once.sum()
    seen = pairs.sum(axis=1)
    arc = np.maximum(pairs - discount, 0)
    left = np.where(seen > 0, 1 - arc.sum(axis=1) / np.maximum(seen, 1), 1.0)
    pair = arc / np.maximum(seen, 1)[:, None] + left[:, None] * single[None, :]
    a, bc = keys // (k * k), keys % (k * k)
    context = keys // k
    before = pairs.copy()  # how often each context of two comes up
    before[k - 1, k - 1] = pairs[k - 1].sum()
    total = before[context // k, context % k] if len(keys) else np.zeros(0)
    own = np.maximum(counts - discount, 0) / np.maximum(total, 1)
    fail = np.ones(k * k)
    np.subtract.at(fail, context, own)
    fail = np.clip(fail, 1e-9, 1)
    prob = own + fail[context] * pair[bc // k, bc % k]
    with np.errstate(divide="ignore"):
        return Automaton(words, keys, np.log10(prob), np.log10(fail), np.log10(pair))


def _class_counts(words: np.ndarray):
    """Counts of class bigrams and trigrams over a task's training texts, as (key, count) rows."""
    model = Automaton(words, *[np.zeros(0)] * 3, np.zeros((1, 1)))
    k = len(words) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two, three = np.zeros(k * k, np.int64), np.zeros(0, np.int64)
        found, number = [], []
        for batch in batches:
            for i in range(batch.num_rows):
                words, tokens, size, train = opened(batch, i)
                cls = model.classes(words).astype(np.int64)[tokens]
                first = np.cumsum(size) - size
                a, b = contexts(cls, first, k - 1)
                pair = (b * k + cls)[train]
                two += np.bincount(pair, minlength=k * k)
                three, n = np.unique((a * k * k)[train] + pair, return_counts=True)
                found.append(three)
                number.append(n)
                if len(found) > 8:
                    found, number = _merge(found, number)
        found, number = _merge(found, number) if found else ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)])
        at = np.flatnonzero(two)
        # bigrams below, trigrams above 2**40: three classes of at most 252 fit in 24 bits
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((at, found[0] + (1 << 40)))), pa.array(np.concatenate((two[at], number[0])))], ["key", "n"])
    return run


def _merge(found: list, number: list) -> tuple[list, list]:
    keys, place = np.unique(np.concatenate(found), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, place, np.concatenate(number))
    return [keys], [total]


def arcs(p: np.ndarray, first: np.ndarray, one: np.ndarray, two: np.ndarray, three: np.ndarray, texts: int) -> np.ndarray:
    """The probability of each token in its longest context, from that in the class model and the counts
    of the word, pair and triple that end at it; ``texts``: how many texts there are to begin one.

    A word that isn't a text's end is always followed by a word, so a context's count is its own."""
    context = np.empty_like(one)
    context[1:], context[first] = one[:-1], texts
    p = (two + WEIGHTS[0] * p) / (context + WEIGHTS[0])
    longer = (three[1:] + WEIGHTS[1] * p[1:]) / (two[:-1] + WEIGHTS[1])
    begins = np.zeros(len(p), bool)
    begins[first] = True
    p[1:] = np.where(begins[1:], p[1:], longer)
    return p


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(parts: int, bits: int, n: int, figures: np.ndarray, model):
    v, rest_v, rest_n, ones, twos = (int(x) for x in figures)
    discount = ones / (ones + 2 * twos) if ones + twos else 0.5
    discount = min(max(discount, 0.1), 0.9)

    def run(chunk: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        replies = unpack_lists(replies, "_answers")
        for i in range(chunk.num_rows):
            words, tokens, size, train = opened(chunk, i)
            (two, at_two), (three, at_three) = (np.unique(g, return_inverse=True) for g in grams(words, tokens, size, bits))
            own = [expand(chunk["counts"][i].as_py()), *(np.bincount(at[train], minlength=len(k)) for k, at in ((two, at_two), (three, at_three)))]
            total = np.concatenate(own) + aligned(np.concatenate((words, two, three)), parts, replies, range_of)
            c, c_two, c_three = np.split(total, np.cumsum((len(words), len(two))))
            first = np.cumsum(size) - size
            base = np.log10((c + 1) / (n + v + 1))
            cls = model.value.classes(words).astype(np.int64)
            within = np.where(cls > 0, 0.0, np.log10(np.where(c > 0, c - discount, discount * rest_v + 1) / (rest_n + 1)))
            steps = np.log10(arcs(10 ** (model.value.run(cls[tokens], first) + within[tokens]), first, c[tokens], c_two[at_two], c_three[at_three],
                                  c[words == END][0]))
            add = lambda x: np.add.reduceat(x, first)  # noqa: E731, B023
            out.append(pa.table({
                "doc_id": pa.array(chunk["ids"][i].as_py(), pa.int64()), "held_out": pa.array(chunk["held"][i].as_py(), pa.bool_()),
                "n_tokens": pa.array(size, pa.int64()), "n_known": pa.array(add((c > 0)[tokens].astype(np.int64)), pa.int64()),
                "base_score": pa.array(add(base[tokens])), "score": pa.array(add(steps))}))
        release()
        return pa.concat_tables(out) if out else pa.table({c: pa.array([], t) for c, t in (
            ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()))})
    return run


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_fold: int = 2) -> DataFrame:
    """One row per document: token counts, the unigram base score and the automaton's score."""
    spark = bounded_batches(df.sparkSession)
    key = F.col(f"`{id_col}`")
    held = F.coalesce(doc_crc(key) % folds == held_fold, F.lit(False))
    rows = df.select(key.cast("long").alias("_id"), held.alias("_held"), F.col(f"`{text_col}`").alias("_text"))
    read = stored(rows.mapInArrow(tidy(_read), _CHUNKS))
    n, tokens = read.select(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_train", "n_all")]).first()
    parts = max(partitions(spark), -(-3 * tokens // PART_KEYS))
    bits = gram_bits(tokens)
    least = max(1, int(np.ceil(n * CLASS_SHARE)))
    questions = read.select("_chunk", "held", "n_tokens", "words", "counts", "tokens").mapInArrow(tidy(_questions(parts, bits)), PACKED_QUESTION)
    replies = stored(ask(questions, parts, _totals(least), PACKED_ANSWER))
    figures, words = np.zeros(5, np.int64), []
    for r in replies.where("_chunk = -1").select("_answers").collect():  # a row for each part, at most 251 words in all
        a = expand(bytes(r["_answers"]))
        figures += a[:5]
        words.append(a[5:5 + (len(a) - 5) // 2])
    words = np.sort(np.concatenate(words).view(np.uint64)) if words else np.zeros(0, np.uint64)
    k = len(words) + 2
    grams = read.select("words", "n_tokens", "held", "tokens").mapInArrow(tidy(_class_counts(words)), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # bounded: at most k * k pairs and 1 / ARC_SHARE arcs
    got = grams.where((F.col("key") < 1 << 40) | (F.col("n") >= max(1, n * ARC_SHARE))).orderBy("key").toArrow()
    keys, counts = got["key"].to_numpy(), got["n"].to_numpy()
    two = keys < 1 << 40
    pairs = np.zeros(k * k)
    pairs[keys[two]] = counts[two]
    model = spark.sparkContext.broadcast(build(words, pairs.reshape(k, k), keys[~two] - (1 << 40), counts[~two].astype(np.float64)))
    scored = read.groupBy("_chunk").cogroup(replies.where("_chunk >= 0").groupBy("_chunk")).applyInArrow(
        _score(parts, bits, n, figures, model), _SCORES)
    return scored.withColumn("train_tokens", F.lit(n).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
