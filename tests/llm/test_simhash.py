"""SimHash components against brute force."""
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from ladle.llm import simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text, k=3):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode())
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(values, ids):
    """The smallest id reachable for every value."""
    label = list(range(len(values)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    v = np.array(values, np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= 3) + i + 1:
            a, b = find(i), find(j)
            label[max(a, b)] = min(a, b)
    roots = [find(i) for i in range(len(v))]
    low = {}
    for r, i in zip(roots, ids):
        low[r] = min(low.get(r, i), i)
    return [low[r] for r in roots]


def balls(seed=3):
    """Values far apart, and balls of values around some of them."""
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(30)]
    values = set(base)
    for b in base[:6]:
        for _ in range(120):
            x = b
            for k in r.sample(range(64), r.randrange(1, 8)):
                x ^= 1 << k
            values.add(x)
    return sorted(values)


@pytest.mark.parametrize("group", [4096, 60, 3])
def test_links_join_the_same_components(spark, group):
    values = balls() if group > 3 else balls()[:150]
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in values], "_print long").repartition(5)
    label = {x: x for x in values}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for r in simhash.links(df, group).collect():
        a, b = (find(x & (1 << 64) - 1) for x in r)
        label[max(a, b)] = min(a, b)
    want = components(values, values)
    assert [find(x) for x in values] == want


def test_every_link_passes_some_chain():
    """The budgets lose no pair of up to three differing bits, wherever they are."""
    r = random.Random(8)
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for k in r.sample(range(64), r.randrange(1, 4)):
            b ^= 1 << k
        x = np.array([a, b], np.uint64)
        found = 0
        for s in range(4):
            c = simhash.chain(x, s)
            if c[0] >> np.uint64(48) == c[1] >> np.uint64(48):
                found += len(simhash.within(c, np.zeros(2, np.uint64))[0])
        assert found


def test_cube():
    r = random.Random(6)
    places = np.array(r.sample(range(1 << 9), 12))
    tied = simhash.on_cube(places, 9)
    want = components(places.tolist(), places.tolist())
    assert [[a == b for b in tied] for a in tied] == [[a == b for b in want] for a in want]


def test_largest_groups_by_the_cube(spark):
    """Values that share 46 bits: the last groups, linked over the cube of the other 18."""
    r = random.Random(9)
    values = sorted({0x1234_5678_9ABC_0000 | r.getrandbits(16) for _ in range(25)} | {0x1234_5678_9ABC_0000 ^ 1 << 60})
    df = spark.createDataFrame([(x,) for x in values], "_print long")
    x = df.mapInArrow(simhash._first_groups, simhash._GROUPS).where("_start = 0").select("_chain", "_start")
    rows = x.mapInArrow(simhash._deeper_groups(3), simhash._GROUPS + ", _mask short").where("_mask = 0").toArrow()
    key = rows["_key"].to_numpy()
    groups = [rows.filter(pa.array(key == k)) for k in np.unique(key)]
    label = {v: v for v in values}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v
    for g in groups:
        for a, b in zip(*simhash._cube_links(g).to_pydict().values()):
            a, b = find(a), find(b)
            label[max(a, b)] = min(a, b)
    together = [v for v in values if v >> 48 == 0x1234]
    want = components(together, together)
    assert [find(v) for v in together] == want


def test_labels_equal_brute_force(spark):
    r = random.Random(1)
    vocab = [f"w{i}" for i in range(200)] + ["Été", "中文"]
    rows = []
    for i in range(200):
        w = [r.choice(vocab) for _ in range(r.choice([0, 1, 2, 3, 40, 120]))]
        if i % 3 == 0 and rows:
            w = (rows[-1][1] or "").split()
            if w and i % 2:
                w[-1] = "changed"
        rows.append((i * 3 - 20, r.choice([" ", "\n", "  "]).join(w)))
    rows += [(900, None), (901, " \t"), (None, "w1 w2 w3 w4"), (902, "again " * 60_000), (902, "another text"), (-900, "AGAIN " * 60_000)]
    r.shuffle(rows)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, _text string, _n int").repartition(6)
    known = [(i, t) for i, t in rows if i is not None]
    prints = [fingerprint(t) for _, t in known]
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(known, prints, components(prints, [i for i, _ in known]))]
    want += [(None, f"{fingerprint('w1 w2 w3 w4'):016x}", None)]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, simhash.labels(df).collect()), key=key) == sorted(want, key=key)


def test_hot_fingerprints_are_joined_by_a_list(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", 5)
    df = spark.createDataFrame([(i, "one two three four" if i < 30 else f"text number {i} of many") for i in range(50)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.labels(df).collect()}
    assert len(got) == 50 and all(got[i] == 0 for i in range(30))


def test_empty_table(spark):
    assert simhash.labels(spark.createDataFrame([], "doc_id long, text string")).collect() == []
