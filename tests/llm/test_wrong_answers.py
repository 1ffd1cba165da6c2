"""Inputs that earlier versions answered wrongly."""
import numpy as np
from pyspark.sql import functions as F

from ladle.llm import secrets, substrings, topk


def test_large_components_keep_exact_scores(spark):
    rng = np.random.default_rng(1)
    v = np.floor(rng.uniform(-1e6, 1e6, (300, 8)))
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(400, v[7].tolist()), (401, v[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.exact_topk(df, F.col("vec_id") % 50 == 0, 5).collect()}
    whole = [(i, [int(256 * c) for c in x]) for i, x in rows]
    for q, a in whole:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)[:5]
            assert [got[q, r] for r in range(1, 6)] == [(i, -s) for s, i in best]


def test_ids_of_62_bits_and_more(spark):
    text = " ".join(f"w{i}" for i in range(20))
    top = 2**63 - 1
    ids = [1, 2, 2**62 + 1, 2**62 + 2, top, -top - 1]
    for pair in (ids[:2], ids[2:4], ids[3:5], [ids[5], ids[4]], [ids[5], 0]):
        df = spark.createDataFrame([(i, text) for i in pair] + [(7, "nothing else here")], "doc_id long, text string").repartition(2)
        got = {r.doc_id: r.n_removed for r in substrings.digests(df).collect()}
        assert (got[pair[0]], got[pair[1]]) == (0, 20), pair


def test_redact_keeps_clashing_columns(spark):
    df = spark.createDataFrame([(1, "password=abcdefgh1", "f", "b", "k"), (2, None, "f", "b", "k")],
                               "doc_id long, text string, findings string, _blob string, _found string")
    out = secrets.redact(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == sorted([(1, "*" * 18, "f", "b", "k"), (2, None, "f", "b", "k")])


def test_long_credentials_in_urls():
    for n in (20, 260, 5000):
        text = f"see https://user:{'p' * n}@host.example/x"
        assert any(kind == "hook" for kind, _, _ in secrets.findings(text))
    assert secrets.findings("-----BEGIN " + "VERY " * 20 + "PRIVATE KEY-----")[0][0] == "pem"
