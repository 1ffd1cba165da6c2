"""Queries of the operators over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import align, fingerprints, lm, neardup, packing, pieces, resample, secrets, simhash, substrings, topk, toxicity, warc
from ladle.llm.common import documents

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


@query("op1_topk", """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
 WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
 FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.exact_topk(vectors, F.col("vec_id") % 50 == 0, 5)


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secrets.digests(secrets.report(docs, secrets.scan_unseen(docs)))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


@query("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_pairs(documents(spark, sf_dir))


@query("op10_lm_scores")
def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


#: Words of a column as a list.
_WORDS = "list_filter(regexp_split_to_array(coalesce({}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


@query("op3_substring_dedup", f"""
WITH w AS (SELECT doc_id, {_WORDS.format('text')} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
f AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
cov AS (SELECT DISTINCT doc_id, i + j AS p FROM (SELECT win.doc_id, i, unnest(range(13)) AS j FROM win JOIN f USING (k) WHERE m < win.doc_id)),
gone AS (SELECT doc_id, list(p) AS ps FROM cov GROUP BY doc_id),
kept AS (SELECT doc_id, ws, list_filter(range(1, len(ws) + 1), lambda p: ps IS NULL OR NOT list_contains(ps, p)) AS ks FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - len(ks) AS BIGINT) AS n_removed,
 sha256(coalesce(array_to_string(list_transform(ks, lambda p: ws[p]), ' '), '')) AS kept_sha256 FROM kept""")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(documents(spark, sf_dir))


@query("op5_minhash_neardup", f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT r.d, e.b FROM r JOIN e ON e.a = r.c)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM (SELECT d AS doc_id, min(c) AS c FROM r GROUP BY d) LEFT JOIN n USING (doc_id)""")
def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.labels(documents(spark, sf_dir), shingle=3, percent=85)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(documents(spark, sf_dir))


def aged(replica: DataFrame) -> DataFrame:
    """A replica as it may be found: of some ids a character is changed, of some the end is cut off,
    some records are gone and some are there twice."""
    key, record = F.col("key"), F.col("record")
    worn = F.when(key % 97 == 5, F.concat(F.substring(record, 1, 40), F.lit("?"), F.substring(record, 42, 2147483647))).when(
        key % 193 == 7, F.expr("substring(record, 1, length(record) - 9)")).otherwise(record)
    times = F.when(key % 389 == 11, 0).when(key % 577 == 13, 2).otherwise(1)
    return replica.select("key", worn.alias("record"), F.explode(F.array_repeat(F.lit(1), F.coalesce(times, F.lit(1)))).alias("_")).drop("_")


@query("op2_warc_audit", """
WITH r AS (SELECT page_id AS key, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>',
 chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Type: text/html; charset=utf-8', chr(13), chr(10), 'Content-Length: ', strlen(coalesce(html, '')),
 chr(13), chr(10), chr(13), chr(10), html, chr(13), chr(10), chr(13), chr(10)) AS record FROM pages),
w AS (SELECT r.key, CASE WHEN r.key % 97 = 5 THEN concat(substr(record, 1, 40), '?', substr(record, 42)) WHEN r.key % 193 = 7
 THEN substr(record, 1, length(record) - 9) ELSE record END AS record FROM r, (VALUES (1), (2)) t(i)
 WHERE t.i <= CASE WHEN r.key % 389 = 11 THEN 0 WHEN r.key % 577 = 13 THEN 2 ELSE 1 END),
m AS (SELECT 0 AS side, key, sha256(record) AS sha256, strlen(record) AS bytes FROM r UNION ALL SELECT 1, key, sha256(record), strlen(record) FROM w),
l AS (SELECT *, key >> 12 AS file, sum(bytes) OVER (PARTITION BY side, key >> 12 ORDER BY key, sha256 ROWS UNBOUNDED PRECEDING) - bytes AS offs FROM m),
g AS (SELECT file, key, sha256, bytes, count(*) FILTER (side = 0) AS n_expected, count(*) FILTER (side = 1) AS n_found,
 min(offs) FILTER (side = 0) AS o0, min(offs) FILTER (side = 1) AS o1 FROM l GROUP BY ALL)
SELECT file, key AS page_id, sha256, n_expected, n_found, CAST(coalesce(o0, o1) AS BIGINT) AS "offset", bytes AS length FROM g WHERE n_expected <> n_found""")
def op2_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary = warc.records(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return warc.audit(primary, aged(primary))


@query("op11_tokenizer_alignment")
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digests(documents(spark, sf_dir))


#: Words of letters, digits and code points beyond ASCII as a list.
_FEATURE_WORDS = ("list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                  "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')")


@query("op12_importance_resampling", f"""
WITH w AS (SELECT doc_id, {_FEATURE_WORDS} AS ws FROM documents),
b AS (SELECT {_FEATURE_WORDS} AS ws FROM benchmark),
f AS (SELECT doc_id, array_to_string(ws[i:i + n - 1], ' ') AS f, count(*) AS k FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(n)) GROUP BY ALL),
g AS (SELECT array_to_string(ws[i:i + n - 1], ' ') AS f, count(*) AS k FROM (SELECT ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM b, (VALUES (1), (2), (3)) v(n)) GROUP BY ALL),
t AS (SELECT list(c ORDER BY i) AS crcs FROM (SELECT i, list_reduce(range(9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))),
d AS (SELECT f, hex(encode(f)) AS h, strlen(f) AS n FROM (SELECT f FROM f UNION SELECT f FROM g)),
h AS (SELECT f, xor(list_reduce(list_transform(range(1, n + 1), lambda i: CAST(CAST('0x' || substr(h, 2 * i - 1, 2) AS INTEGER) AS BIGINT)), lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket FROM d, t),
sb AS (SELECT bucket, sum(k) AS s FROM f JOIN h USING (f) GROUP BY bucket),
tb AS (SELECT bucket, sum(k) AS t FROM g JOIN h USING (f) GROUP BY bucket),
n AS (SELECT CAST(coalesce((SELECT sum(s) FROM sb), 0) AS DOUBLE) AS s, CAST(coalesce((SELECT sum(t) FROM tb), 0) AS DOUBLE) AS t),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(tb.t, 0) + 1.0::DOUBLE) * (n.s + 10000) / ((sb.s + 1.0::DOUBLE) * (n.t + 10000)))) AS BIGINT) AS gain FROM n, sb LEFT JOIN tb USING (bucket)),
v AS (SELECT doc_id, sum(k) AS nf, sum(k * gain) AS weight FROM f JOIN h USING (f) JOIN gain USING (bucket) GROUP BY doc_id),
s AS (SELECT w.doc_id, len(ws) AS words, CAST(coalesce(nf, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
 CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || w.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM w LEFT JOIN v USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM s WHERE words >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 5 * (SELECT count(*) FROM r) // 100 THEN rank END AS rank FROM s LEFT JOIN r USING (doc_id)""")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op13_simhash_neardup")
def op13_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.labels(documents(spark, sf_dir))
