import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ladle.llm import warc

SCHEMA = "page_id long, url string, html string, key long, record string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 5, "clash") for i, u, h in rows], SCHEMA)


def record(i, url, html):
    html = html or ""
    return (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{'' if i is None else i}>\r\nWARC-Target-URI: {url or ''}\r\n"
            f"Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(html.encode())}\r\n\r\n{html}\r\n\r\n")


ROWS = [(i, f"http://h/{i}", f"<p>é {i}</p>" * (i % 7)) for i in range(0, 9000, 37)] + [
    (None, None, None), (None, "u", "x"), (4, "http://h/4", "twice"), (4, "http://h/4", "twice"), (5, "", ""), (-3, "neg", "n")]


def test_records(spark):
    got = Counter((r["key"], r["record"]) for r in warc.records(pages(spark, ROWS)).collect())
    assert got == Counter((i, record(i, u, h)) for i, u, h in ROWS)


def brute(one, two):
    a, b = (Counter((i, hashlib.sha256(r.encode()).hexdigest(), len(r.encode())) for i, r in x) for x in (one, two))
    out = set()
    for k in set(a) | set(b):
        if a[k] != b[k]:
            src = one if a[k] else two
            file = None if k[0] is None else k[0] >> 12
            before = sorted(((i is not None, i), hashlib.sha256(r.encode()).hexdigest(), len(r.encode())) for i, r in src
                            if (None if i is None else i >> 12) == file)
            at = 0
            for key, sha, n in before:
                if (key[1], sha) == k[:2]:
                    break
                at += n
            out.add((file, k[0], k[1], a[k], b[k], at, k[2]))
    return out


def damage(rows, kind):
    out = []
    for n, (i, r) in enumerate(rows):
        if n % 50 == 3:
            if kind == "flip":
                r = "?" + r[1:]
            elif kind == "cut":
                r = r[:-4]
            elif kind == "lose":
                continue
            elif kind == "twice":
                out.append((i, r))
        out.append((i, r))
    return out


@pytest.mark.parametrize("kind", ["flip", "cut", "lose", "twice"])
def test_audit_finds_all_damage(spark, kind):
    one = [(i, record(i, u, h)) for i, u, h in ROWS]
    two = damage(one, kind)
    make = lambda rows: spark.createDataFrame(rows, "key long, record string")
    got = warc.audit(make(one), make(two)).collect()
    assert {tuple(r) for r in got} == brute(one, two) and got


def test_audit_of_equal_and_empty_replicas(spark):
    one = warc.records(pages(spark, ROWS))
    assert warc.audit(one, one.orderBy(F.rand(3))).collect() == []
    none = warc.records(pages(spark, []))
    assert warc.audit(none, none).collect() == []
    assert warc.audit(one, none).agg(F.sum("n_expected")).first()[0] == len(ROWS)


def test_only_mismatching_branches_differ(spark):
    one = [(i, f"record {i}") for i in range(600)]
    two = [(i, r + "!" if i == 321 else r) for i, r in one]
    a, b = (warc.tree(warc.manifest(spark.createDataFrame(x, "key long, record string")), 3) for x in (one, two))
    for level, (x, y) in enumerate(zip(a, b)):
        assert [r["_bad"] for r in warc._differing(x, y).collect()] == [321 >> (4 * level)]
        assert x.agg(F.sum("records")).first()[0] == 600
