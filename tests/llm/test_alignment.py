"""Alignment of two tokenizers against brute force with the libraries themselves."""
import bisect
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from ladle.llm import align

ODD = [(-1, None), (-2, ""), (-3, " lead  two\n\ttab <|endoftext|> <s> </s> <unk> <0x41>"), (-4, "a▁b"), (-5, "中文 字符 🙂🙂   x\u0000y"),
       (-5, "    "), (None, "same text"), (-6, "q" * 3000), (-7, "\r\n \r\n a"), (-8, "same text"), (-8, "same text"),
       (-9, " ".join(f"Wörd{i % 977} is, well... (number {i})" for i in range(20_000)))]


def byte_of_char():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def brute(rows):
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte, per, held = byte_of_char(), [], Counter()
    for key, text in rows:
        groups = []
        if text:
            raw = b" " + text.encode()
            a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
            ab = [bytes(byte[c] for c in a_tok.id_to_token(i)) for i in a]
            bb = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(ab) == raw == b"".join(bb):
                ends = []
                for tokens in (ab, bb):
                    at, e = 0, []
                    for t in tokens:
                        at += len(t)
                        e.append(at)
                    ends.append(e)
                i = j = 0
                for e in sorted(set(ends[0]) & set(ends[1])):
                    i1, j1 = (bisect.bisect_left(x, e) + 1 for x in ends)
                    groups.append((a[i:i1], b[j:j1]))
                    i, j = i1, j1
        links = Counter((x, y) for u, v in groups for x in u for y in v)
        held.update(links.keys())
        per.append((key, groups, links))
    best = defaultdict(int)
    for (x, _), c in held.items():
        best[x] = max(best[x], c)
    out = []
    for key, groups, links in per:
        text = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in groups)
        out.append((key, sum(len(u) for u, _ in groups), sum(len(v) for _, v in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, held, best


def key(r):
    return tuple((x is not None, x) for x in r)


def test_digests_equal_brute_force(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in d.collect()] + ODD
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, _text string, _pair int").repartition(5)
    want, held, best = brute(rows)
    assert sorted(map(tuple, align.digests(table).collect()), key=key) == sorted(want, key=key)
    pairs = {(r.a_id, r.b_id): (r.n_docs, r.best) for r in align.id_pairs(table).collect()}
    assert pairs == {p: (n, n == best[p[0]]) for p, n in held.items()}


def test_one_text_at_a_time_changes_nothing():
    r = random.Random(5)
    words = ["alpha", "Beta-9", "naïve", "中文字", "don't", "3.14159", "https://x.org/a_b", "🙂"]
    rows = [(i, "".join(r.choice(words) + r.choice([" ", "  ", "\n", "", "\t "]) for _ in range(r.randrange(60)))) for i in range(40)]
    want, _, _ = brute(rows)
    voc = align.vocabularies(align.tokenizer_path(), align.model_path())
    every = align.Aligned([t for _, t in rows], voc)
    for i, ((_, text), w) in enumerate(zip(rows, want)):
        one = align.Aligned([text], voc)
        for x, d in ((one, 0), (every, i)):
            assert (int(x.n_a[d]), int(x.n_b[d]), int(x.sums(x.n_groups)[d]), int(x.sums(x.n_links)[d]), x.digest(d)) == (*w[1:5], w[7])
    # every distinct window once
    assert len(every.texts) == len(set(every.texts)) < len(every.place)


def test_groups_are_byte_ranges(spark, docs):
    rows = [(1, "Größe: 12 km"), (2, None), (3, "a▁b")]
    got = align.groups(docs(rows)).collect()
    raw = " Größe: 12 km".encode()
    voc = align.vocabularies(align.tokenizer_path(), align.model_path())
    assert {r.doc_id for r in got} == {1}
    for r in got:
        assert b"".join(voc.a[i] for i in r.a_ids) == b"".join(voc.b[i] for i in r.b_ids) == raw[r.start:r.end]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align.digests(empty).collect() == [] and align.id_pairs(empty).collect() == []


def test_stored_chunks_are_read_in_bounded_runs(spark, monkeypatch):
    import pyarrow.dataset as ds

    monkeypatch.setattr(align, "CHUNK", 200)
    df = spark.createDataFrame([(i, f"some words of text {i} and a few more of them") for i in range(200)], "doc_id long, text string").coalesce(1)
    chunked = align._chunked(df, "doc_id", "text", None, None)
    groups = [f.metadata.row_group(g).num_rows for f in ds.dataset(chunked.stored_at.removeprefix("file:")).get_fragments() for g in range(f.metadata.num_row_groups)]
    assert sum(groups) > 20 and max(groups) <= align.GROUP_CHUNKS
