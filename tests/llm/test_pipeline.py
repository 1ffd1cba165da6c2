"""The pipeline against its parts by brute force, and the contract of its stages."""
import re
from collections import defaultdict

import corpus_pipeline
from ladle.llm import secrets
from ladle.llm.common import stored

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def kept_near(rows, k=5, percent=80):
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i for i in sets if find(i) == i}


def without_repeats(rows, w=13):
    first, out = {}, {}
    for i, t in sorted(rows):
        words = WORD.findall(t or "")
        keep = [True] * len(words)
        for j in range(len(words) - w + 1):
            if first.setdefault(tuple(words[j:j + w]), i) < i:
                keep[j:j + w] = [False] * w
        out[i] = t if all(keep) else " ".join(x for x, y in zip(words, keep) if y)
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(stored(stage(spark, steps[-1], SMALL)))
        assert steps[-1].columns == columns
    rows = [[(r["doc_id"], r["text"]) for r in s.collect()] for s in steps]
    assert set(rows[1]) <= set(rows[0])
    assert {i for i, _ in rows[2]} == kept_near(rows[1]) and set(rows[2]) <= set(rows[1])
    assert dict(rows[3]) == without_repeats(rows[2])
    want = {}
    for i, t in rows[3]:
        chars = list(t)
        for _, s, e in secrets.findings(t):
            chars[s:e] = "*" * (e - s)
        want[i] = "".join(chars)
    assert dict(rows[4]) == want
    assert all(r["n_chars"] == len(r["text"]) for r in steps[4].collect() if (r["doc_id"], r["text"]) not in rows[2])
    pieces = defaultdict(int)
    for r in corpus_pipeline.STAGES[-1][1](spark, steps[-1], SMALL).collect():
        pieces[r["doc_id"]] += r["length"]
    assert set(pieces) == {i for i, _ in rows[4]}


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns[:3] == ["doc_id", "start", "length"] and out.count() > 100
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substrings", "secrets", "packing"]


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, _id int, _text string, n_chars long"
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    labels.write.mode("overwrite").parquet(sf := f"{spark.conf.get('spark.checkpoint.dir')}/odd/labels.parquet")
    sf = sf.removesuffix("/labels.parquet")
    for rows in ([], [(None, None, None, None, None, None), (1, "", "en", 1, "x", 0), (1, "", "en", 1, "x", 0), (2, None, "en", 1, "x", None),
                      (3, "the same words " * 20, "en", 1, "x", 300), (4, "the same words " * 20, "en", 1, "x", 300), (5, "token = abcdefgh", "en", 1, "x", 16)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, sf))
            assert docs.columns == ["doc_id", "text", "lang", "_id", "_text", "n_chars"]
        got = sorted((r["doc_id"] or 0, r["text"]) for r in docs.collect())
        if rows:
            assert [i for i, _ in got] == [0, 1, 2, 3, 5] and got[-1][1] == "*" * 16
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == len(got)
