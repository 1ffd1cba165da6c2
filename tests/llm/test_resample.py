"""Importance resampling against brute force, and the cutoff by medians."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ladle.llm import resample
from ladle.llm.common import Words, chunks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return w, [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(rows, target, percent=5, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for x in texts for f in runs(x)[1]) for texts in ([x for _, x in rows], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (total_s + 10000) / ((s[b] + 1.0) * (total_t + 10000)))) for b in s}
    out = []
    for i, x in rows:
        words, f = runs(x)
        weight = sum(gain[bucket(g)] for g in f)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, len(words)])
    may = sorted((r for r in out if r[0] is not None and r[5] >= least), key=lambda r: (-r[3], r[0], r[1]))
    for rank, r in enumerate(may[:percent * len(may) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=lambda r: tuple((x is not None, x) for x in r))


def sample():
    r = random.Random(2)
    vocab = [f"w{i}" for i in range(300)] + ["Été", "中文", "ab_c", "x,y", "42"]
    rows = [(i * 7 - 30, r.choice([" ", "\n", ", "]).join(r.choice(vocab) for _ in range(r.choice([0, 1, 2, 19, 20, 25, 80])))) for i in range(300)]
    rows += [(9001, None), (9002, ""), (None, " ".join(vocab)), (9003, "q" * 5000 + " z" * 30), (9004, " ".join(vocab * 300))]
    return rows + rows[:40] + [(rows[3][0], "another text of the same id " * 8)]


def by_key(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("few", [1, 10, 5000])
def test_equals_brute_force(spark, few):
    rows, target = sample(), [" ".join(f"w{i}" for i in range(40)), None, "", "Été x,y"]
    df = spark.createDataFrame([(i, t, 3, "x") for i, t in rows], "doc_id long, text string, _score int, rank string").repartition(7)
    got = resample.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=30, few=few)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert by_key(got.collect()) == brute(rows, target, 30)


def test_cutoff_of_ties_and_many_parts(spark):
    r = random.Random(4)
    keys = [(r.choice([5, 5, 5, 9, -3]), r.randrange(40), r.randrange(3)) for _ in range(3000)]
    df = spark.createDataFrame(keys, "_score long, _id long, _n long").repartition(13)
    order = sorted((-s, i, n) for s, i, n in keys)
    for k in (1, 7, 1500, 2999, 3000):
        assert resample.cutoff(df, k, few=1) == order[k - 1]


def test_ranks_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(resample, "SORTED_ROWS", 10)
    df = spark.createDataFrame([(i % 4, i, 1) for i in range(95)], "_score long, _id long, _n long")
    got = sorted((r["_rank"], -r["_score"], r["_id"]) for r in resample.ranked(df, 95).collect())
    assert got == [(k, *x) for k, x in enumerate(sorted((-(i % 4), i) for i in range(95)), 1)]


def test_empty_tables(spark):
    docs, target = (spark.createDataFrame([], s) for s in ("doc_id long, text string", "text string"))
    assert resample.resample(docs, target).collect() == []
    one = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    assert by_key(resample.resample(one, target).collect()) == brute([(1, "a b"), (None, None)], [])


def test_checksums_of_long_words():
    texts = ["Hello, World 12 é中 x", "", None, "a", "q" * 100 + " z " + "é" * 30_000, "tail_x A-B"]
    for _, _, flat, at in chunks(pa.array(texts)):
        found = resample.features(Words(flat, at, lower=True, apart=resample._APART))
        for d, text in enumerate(texts):
            got = np.concatenate([crc[doc == d] for crc, doc in found]).tolist()
            assert got == [zlib.crc32(f.encode()) for f in runs(text)[1]]
