import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ladle.llm import toxicity
from ladle.llm.common import binary, layout

BAD = ["vile", "rotten", "foul", "nasty"]


def corpus(n, seed=1):
    r = random.Random(seed)
    vocab = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(vocab) for _ in range(r.randrange(20, 120))]
        toxic = r.random() < 0.2
        if toxic:
            for _ in range(r.randrange(2, 6)):
                w[r.randrange(len(w))] = r.choice(BAD) + r.choice(["", ".", ",", "!!"])
        rows.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, int(toxic if r.random() > 0.04 else not toxic), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark, docs):
    rows, labels = corpus(1500)
    lab = spark.createDataFrame([(i, y) for i, y, _ in labels], "doc_id long, toxic int")
    extra = [(None, "vile rotten foul text"), (5000, None), (5001, ""), (5002, " ".join(["word1"] * 30_000)), (7, rows[7][1])]
    return rows + extra, labels, toxicity.scores(docs(rows + extra), lab).collect()


def test_every_row_is_scored(scored):
    rows, _, got = scored
    assert sorted((r.doc_id is not None, r.doc_id) for r in got) == sorted((i is not None, i) for i, _ in rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_accuracy(scored):
    _, labels, got = scored
    truth = {i: y for i, _, y in labels}
    held = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    s, y = np.array([a for a, _ in held]), np.array([b for _, b in held])
    assert ((s >= 0.5) == y).mean() > 0.97  # though 4 % of the labels learned from are wrong
    order = np.argsort(np.argsort(s, kind="stable"))
    auc = (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.97


def test_held_out_labels_are_not_read(spark, docs):
    rows, labels = corpus(400, 3)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    a = spark.createDataFrame([(i, y) for i, y, _ in labels], "doc_id long, toxic int")
    b = spark.createDataFrame([(i, 1 - y if held(i) else y) for i, y, _ in labels], "doc_id long, toxic int")
    x, y = (sorted(tuple(r) for r in toxicity.scores(docs(rows), t).collect()) for t in (a, b))
    assert [r[0] for r in x] == [r[0] for r in y] and np.allclose([r[2] for r in x], [r[2] for r in y])


def test_tables_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.scores(docs([(1, "a"), (2, None)]), none).collect()] == [0.0, 0.0]
    nulls = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.scores(docs([(1, "a")]), nulls).collect()] == [0.0]
    assert toxicity.scores(docs([]), none).collect() == []


def test_drop_toxic_keeps_columns_and_clean_rows(spark, docs):
    rows, labels = corpus(900, 5)
    lab = spark.createDataFrame([(i, y) for i, y, _ in labels], "doc_id long, toxic int")
    df = docs(rows + [(None, None)])
    left = toxicity.drop_toxic(df, lab)
    assert left.columns == df.columns
    ids = {r["doc_id"] for r in left.collect()}
    clean = {i for i, t in rows if not any(b in t for b in BAD)}
    assert None in ids and len(clean - ids) <= 0.01 * len(clean)
    assert len(ids - clean) - 1 <= 0.05 * (len(rows) - len(clean))


def test_all_labels_make_the_lexicons(spark, docs, monkeypatch):
    """Toxic words of a few rows each count, though the classifier's sample holds hardly any of them."""
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 60)
    r = random.Random(9)
    rare = [f"{c}zq{i}" for i, c in enumerate("bcdfghjklm")]
    rows = [(i, " ".join([f"word{r.randrange(300)}" for _ in range(40)] + [rare[i % 100 // 10]] * (i % 10 == 0))) for i in range(1500)]
    lab = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.Classifier(docs(rows), lab)
    w = toxicity.features(*layout(binary(pa.array([" ".join(rare)]))))
    words = w[2][w[3] == 0]
    assert len(words) == len(rare) and (model.lex.value.place[words] >= 0).all()


def test_label_model_trusts_better_voters():
    """Votes drawn from known rates: the posterior tells the classes apart, also with copied voters."""
    r = np.random.default_rng(0)
    y = r.random(20_000) < 0.15
    hit = np.zeros((len(y), toxicity.VOTERS), int)
    for v in range(toxicity.VOTERS):
        hit[:, v] = r.random(len(y)) < np.where(y, 0.7 if v < 12 else 0.1, 0.02 if v < 12 else 0.1)
    hit[:, 3:6] = hit[:, [2]]  # three copies of one voter
    label = np.where(r.random(len(y)) < 0.1, np.where(r.random(len(y)) < 0.95, y, ~y), -1).astype(int)
    key = hit @ (1 << np.arange(toxicity.VOTERS))
    seen, place, n = np.unique(np.stack([key, label]), axis=1, return_inverse=True, return_counts=True)
    q = toxicity.label_model(seen[0], seen[1], n.astype(float), 0.15)[place.ravel()]
    assert ((q > 0.5) == y).mean() > 0.995
    groups = toxicity._dependent(hit, y.astype(float), np.ones(len(y)))
    assert any({2, 3, 4, 5} <= set(g) for g in groups)
