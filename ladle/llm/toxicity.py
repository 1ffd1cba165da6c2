"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Lexicons. Over all labelled training rows, every word and every word beginning of 4 to 8 bytes is a feature (hashed into
   2**20 buckets). Those that toxic rows hold far more often than others, and
   the reverse, make the lexicons: all that pass the thresholds, so what they hold
   is bounded by the buckets alone.
2. Voters. Sixteen voters look at every document: hits of lexicons by kind and
   strength, absolute and per 100 words, and patterns (shouting, exclamation
   marks, repeated words). The votes of all documents are counted by pattern of
   votes (at most 2**16 of them, whatever the size of the corpus).
3. Label model. A latent class (toxic or not) generates the votes: EM over the
   pattern counts estimates how often each voter fires in each class. Voters
   that stay correlated within a class are joined into groups that vote
   together (their joint patterns get one table), and EM runs again. The label
   of every training row is one more noisy voter; other rows have none.
4. Classifier. A logistic regression over the lexicon features of a bounded sample
   of training rows (``SAMPLE_ROWS``) learns the posterior labels. It scores every document from its
   whole text.

The label model sees all documents; labels come only from rows whose
crc32(id as text) mod 5 isn't 0; language, source and ids are no input.

Defined results: a null text is empty; texts without features get the score of
the bias; rows with a null id or without a label aren't learned from but scored;
a null label counts as none; repeated rows are scored each; without labels of
both classes every score is 0; an empty table gives no rows. Other columns are
not read by ``scores`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import Words, bounded_batches, chunks, doc_crc, tidy

FOLDS = 5
#: Labelled training rows that the classifier's weights are fitted on, at most (about).
SAMPLE_ROWS = 20_000
#: Labels are joined to texts by broadcast up to this many (16 bytes each), else by a shuffle.
BROADCAST_LABELS = 500_000
BUCKETS = 1 << 20
PREFIXES = (4, 5, 6, 7, 8)
VOTERS = 16
GROUP_SIZE = 6

_APART = np.ones(256, bool)
_APART[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False
_KIND = np.arange(1 + len(PREFIXES), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def features(flat: np.ndarray, at: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a run of texts and, for each feature in them, its text, bucket and kind."""
    w = Words(flat, at, lower=True, apart=_APART)
    size = w.ends - w.starts
    doc, bucket, kind = [w.doc], [w.hashes() % np.uint64(BUCKETS)], [np.zeros(len(w), np.int8)]
    for k, n in enumerate(PREFIXES, 1):
        long = np.flatnonzero(size > n)
        h = w.range_hashes(w.starts[long], w.starts[long] + n) ^ _KIND[k]
        doc.append(w.doc[long])
        bucket.append((h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(BUCKETS))
        kind.append(np.full(len(long), k, np.int8))
    return w, np.concatenate(doc), np.concatenate(bucket).astype(np.int64), np.concatenate(kind)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, kind, toxic rows, other rows) over a task's rows."""
    total = np.zeros((2, BUCKETS), np.int64)
    kinds = np.zeros(BUCKETS, np.int8)
    for batch in batches:
        toxic = batch["_label"].to_numpy(zero_copy_only=False).astype(bool)
        for i, j, flat, at in chunks(batch["_text"]):
            _, doc, bucket, kind = features(flat, at)
            key, first = np.unique(doc * BUCKETS + bucket, return_index=True)
            bucket = key % BUCKETS
            kinds[bucket] = kind[first]
            y = toxic[i:j][key // BUCKETS]
            total[1] += np.bincount(bucket[y], minlength=BUCKETS)
            total[0] += np.bincount(bucket[~y], minlength=BUCKETS)
    used = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(kinds[used]), pa.array(total[1][used]), pa.array(total[0][used])],
                                     ["bucket", "kind", "toxic", "other"])


@dataclass
class Lexicon:
    """place: for each bucket its feature or -1; per feature its kind and weight of evidence."""

    place: np.ndarray
    kind: np.ndarray
    evidence: np.ndarray

    def hits(self, flat: np.ndarray, at: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
        """The words, and (text, feature, how often) of the features present."""
        w, doc, bucket, _ = features(flat, at)
        f = self.place[bucket]
        keep = f >= 0
        key, n = np.unique(doc[keep] * len(self.kind) + f[keep], return_counts=True)
        return w, key // max(1, len(self.kind)), key % max(1, len(self.kind)), n


def lexicon(labelled: DataFrame) -> tuple[Lexicon, int, int]:
    """Features that tell the classes apart, from (_text, _label) rows; and the rows of each class."""
    sizes = {bool(r["_label"]): r["count"] for r in labelled.groupBy("_label").count().collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    place = np.full(BUCKETS, -1, np.int32)
    if not n1 or not n0:
        return Lexicon(place, np.zeros(0, np.int8), np.zeros(0)), n1, n0
    p1, p0 = F.col("toxic") / n1, F.col("other") / n0
    p = (F.col("toxic") + F.col("other")) / (n1 + n0)
    z = (p1 - p0) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
    evidence = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("other") + 0.5) / (n0 + 1))
    counted = labelled.mapInArrow(tidy(_count_features), "bucket long, kind byte, toxic long, other long").groupBy("bucket").agg(
        F.max("kind").alias("kind"), F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    best = counted.withColumns({"z": z, "evidence": evidence}).where("abs(z) > 4 AND abs(evidence) > 0.7").orderBy(
        F.desc(F.abs("z")), "bucket").select("bucket", "kind", "evidence").toArrow()
    bucket = best["bucket"].to_numpy()
    place[bucket] = np.arange(len(bucket))
    return Lexicon(place, best["kind"].to_numpy().astype(np.int8), best["evidence"].to_numpy()), n1, n0


def votes(lex: Lexicon, w: Words, raw: np.ndarray, at: np.ndarray, doc: np.ndarray, f: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A row of votes for each text: which of the voters fire."""
    docs = len(at) - 1
    tokens = np.maximum(w.per_doc, 1)

    def count(mask: np.ndarray) -> np.ndarray:
        keep = mask[f]
        return np.bincount(doc[keep], weights=n[keep], minlength=docs)

    kind, e = lex.kind, lex.evidence
    strong, weak = e > 3, (e > 0.7) & (e <= 3)
    word, short, long = kind == 0, (kind == 1) | (kind == 2), kind > 2
    out = []
    for group in (word, short, long):
        c, d = count(group & strong), count(group & weak)
        out += [c >= 1, c >= 3, 100 * c >= 2 * tokens, 100 * d >= 3 * tokens]
    size = np.maximum(np.diff(at), 1)
    upper = np.add.reduceat(np.append((raw >= 65) & (raw <= 90), False).astype(np.int64), np.minimum(at[:-1], len(raw))) * (np.diff(at) > 0)
    shout = np.add.reduceat(np.append(raw == 33, False).astype(np.int64), np.minimum(at[:-1], len(raw))) * (np.diff(at) > 0)
    h = w.hashes()
    again = np.append(False, h[1:] == h[:-1]) if len(h) else np.zeros(0, bool)
    repeated = np.bincount(w.doc[again], minlength=docs)
    out += [3 * upper > size, 100 * shout > size, 3 * repeated > tokens, count(e < 0) >= 1]
    return np.stack(out, axis=1)


def _hits(lex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per row: its votes as a number, its features and counts, its words."""
        power = 1 << np.arange(VOTERS)
        for batch in batches:
            for i, j, flat, at in chunks(batch["_text"]):
                w, doc, f, n = lex.value.hits(flat, at)
                cuts = np.searchsorted(doc, np.arange(j - i + 1))
                v = votes(lex.value, w, flat, at, doc, f, n) @ power
                lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x, pa.int32())) for x in (f, n)]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), batch["_label"].slice(i, j - i).cast(pa.int64()), *lists,
                                                  pa.array(w.per_doc, pa.int64())], ["votes", "label", "features", "counts", "words"])
    return run


def label_model(patterns: np.ndarray, label: np.ndarray, n: np.ndarray, prior: float) -> np.ndarray:
    """P(toxic) for each row of votes with ``label`` (0, 1 or -1 for none) that ``n`` documents have."""
    bits = (patterns[:, None] >> np.arange(VOTERS)) & 1
    q = np.where(label >= 0, np.where(label == 1, 0.9, 0.05), np.where(bits[:, :12].sum(axis=1) >= 4, 0.9, prior / 2))
    groups = [[v] for v in range(VOTERS)]
    for joined in (False, True):
        if joined:
            groups = _dependent(bits, q, n)
        for _ in range(60):
            odds = np.full(len(n), np.log(prior / (1 - prior)))
            for g in groups:
                key = bits[:, g] @ (1 << np.arange(len(g)))
                on, off = (np.bincount(key, weights=n * x, minlength=1 << len(g)) + 0.5 for x in (q, 1 - q))
                odds += (np.log(on / on.sum()) - np.log(off / off.sum()))[key]
            known = label >= 0
            if known.any():  # the annotators' accuracy in each class, kept within bounds
                hit = np.clip(((n * q)[label == 1].sum() + 1) / ((n * q)[known].sum() + 2), 0.6, 0.99)
                false = np.clip(((n * (1 - q))[label == 1].sum() + 1) / ((n * (1 - q))[known].sum() + 2), 0.005, 0.2)
                odds += np.where(known, np.where(label == 1, np.log(hit / false), np.log((1 - hit) / (1 - false))), 0)
            q = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return q


def _dependent(bits: np.ndarray, q: np.ndarray, n: np.ndarray) -> list[list[int]]:
    """Groups of voters that are correlated within a class, strongest pairs first, of bounded size."""
    strength = np.zeros((VOTERS, VOTERS))
    for weight in (n * q, n * (1 - q)):
        if weight.sum() > 0:
            mean = weight @ bits / weight.sum()
            x = bits - mean
            cov = (x * weight[:, None]).T @ x / weight.sum()
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            strength = np.maximum(strength, np.abs(cov / sd[:, None] / sd[None, :]))
    group = {v: [v] for v in range(VOTERS)}
    pairs = [(strength[a, b], a, b) for a in range(VOTERS) for b in range(a)]
    for s, a, b in sorted(pairs, reverse=True):
        if s > 0.2 and group[a] is not group[b] and len(group[a]) + len(group[b]) <= GROUP_SIZE:
            both = group[a] + group[b]
            for v in both:
                group[v] = both
    return [list(g) for g in {id(g): g for g in group.values()}.values()]


def design(words: np.ndarray, doc: np.ndarray, f: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse inputs of the classifier: each feature's count and its rate per 100 words, on log scales."""
    rate = np.log1p(100 * n / np.maximum(words[doc], 30))
    return np.concatenate((doc, doc)), np.concatenate((f, f + k)), np.concatenate((np.log1p(n), rate))


def fit(rows: np.ndarray, cols: np.ndarray, x: np.ndarray, target: np.ndarray, width: int, penalty: float = 3.0, rounds: int = 400) -> np.ndarray:
    """Logistic regression on soft targets (weights, then the bias) by accelerated gradient steps."""
    n = len(target)
    scale = np.bincount(rows, weights=x * x, minlength=n).max(initial=0) + 1
    step = 4.0 / scale
    w, v, t = np.zeros(width + 1), np.zeros(width + 1), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, weights=x * v[cols], minlength=n) + v[-1], -30, 30)))
        d = p - target
        g = np.append(np.bincount(cols, weights=x * d[rows], minlength=width) + penalty * v[:-1], d.sum()) / n
        nw = v - step * g * 1.0
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = nw + (t - 1) / nt * (nw - w), nw, nt
    return w


def _score(lex, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(lex.value.kind)
        for batch in batches:
            for i, j, flat, at in chunks(batch["_text"]):
                w, doc, f, n = lex.value.hits(flat, at)
                r, c, x = design(w.per_doc, doc, f, n, k)
                z = np.bincount(r, weights=x * weights.value[c], minlength=j - i) + weights.value[-1]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays([*[batch[c].slice(i, j - i) for c in batch.schema.names if c != "_text"], pa.array(p)],
                                                 [*[c for c in batch.schema.names if c != "_text"], "_score"])
    return run


class Classifier:
    """Fitted on ``docs`` and the training rows of ``labels``; see the module."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
        spark = bounded_batches(docs.sparkSession)
        key = F.col(f"`{id_col}`").cast("long")
        known = labels.select(key.alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_label")).where(
            "_id IS NOT NULL AND _label IS NOT NULL").where(doc_crc(F.col("_id")) % FOLDS != 0).groupBy("_id").agg(F.max("_label").alias("_label"))
        rows = docs.select(key.alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
        n = known.count()
        labelled = F.broadcast(known) if n <= BROADCAST_LABELS else known
        share = min(1.0, SAMPLE_ROWS / max(1, n))
        picked = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30)))  # SAMPLE_ROWS short rows: bounded
        sample = rows.join(F.broadcast(picked), "_id").select("_text", (F.col("_label") > 0).alias("_label"))
        lex, n1, n0 = lexicon(rows.join(labelled, "_id").select("_text", (F.col("_label") > 0).alias("_label")))
        self.fitted = n1 > 0 and n0 > 0
        if not self.fitted:
            return
        self.lex = spark.sparkContext.broadcast(lex)
        schema = "votes long, label long, features array<int>, counts array<int>, words long"
        every = rows.join(labelled, "_id", "left").select("_text", (F.col("_label") > 0).cast("int").alias("_label"))
        # at most three rows for each of 2**VOTERS patterns
        seen = every.mapInArrow(tidy(_hits(self.lex)), schema).groupBy("votes", F.coalesce("label", F.lit(-1)).alias("label")).count().toArrow()
        pattern, label, n = (seen[c].to_numpy() for c in ("votes", "label", "count"))
        posterior = label_model(pattern, label, n.astype(float), n1 / (n1 + n0))
        soft = {(int(p), int(y)): x for p, y, x in zip(pattern, label, posterior)}
        got = sample.select("_text", F.col("_label").cast("int").alias("_label")).mapInArrow(tidy(_hits(self.lex)), schema).toArrow()
        size = np.array([len(x) for x in got["features"]], np.int64)
        doc = np.repeat(np.arange(len(size)), size)
        f, c = (got[x].combine_chunks().flatten().to_numpy().astype(np.int64) for x in ("features", "counts"))
        target = np.array([soft[x] for x in zip(got["votes"].to_pylist(), got["label"].to_pylist())])
        k = len(lex.kind)
        self.weights = spark.sparkContext.broadcast(fit(*design(got["words"].to_numpy(), doc, f, c, k), target, 2 * k))

    def score(self, rows: DataFrame, text_col: str = "_text") -> DataFrame:
        """``rows`` with ``_score`` in place of the text column."""
        if not self.fitted:
            return rows.drop(text_col).withColumn("_score", F.lit(0.0))
        others = [f for f in rows.schema.fields if f.name != text_col]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
        return rows.withColumnRenamed(text_col, "_text").mapInArrow(tidy(_score(self.lex, self.weights)), f"{schema}, _score double" if others else "_score double")


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = Classifier(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    return model.score(rows).select("doc_id", F.coalesce(doc_crc(F.col("doc_id")) % FOLDS == 0, F.lit(False)).alias("held_out"),
                                    F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    model = Classifier(docs, labels, id_col, text_col, label_col)
    inner = [f"_c{i}" for i in range(len(docs.columns))]
    named = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, inner)])
    text = inner[docs.columns.index(text_col)]
    scored = model.score(named.withColumn("_text", F.coalesce(F.col(text), F.lit(""))))
    return scored.where(F.col("_score") < threshold).select(*[F.col(n).alias(c) for n, c in zip(inner, docs.columns)])
