"""Queries for review sentiment (E) over the documents and labels tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators import sentiment as SE
from ladle.plans.catalog import finish, register
from ladle.sources.fixtures import table

NEG_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in SE.NEGATIONS) + "]"
_TK = "list_filter(string_split_regex(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}'']+'), lambda x: x <> '')"

_LEX = f"""lt AS (SELECT doc_id, {_TK.format(c='text')} AS tk FROM documents),
ld AS (SELECT DISTINCT doc_id, unnest(tk) AS token FROM lt),
lex AS (SELECT token, avg(2.0 * (l.quality - l.toxic)) AS valence FROM ld JOIN labels l USING (doc_id)
 GROUP BY token HAVING count(*) >= 5 AND abs(avg(2.0 * (l.quality - l.toxic))) >= 0.5)"""


def _score_sql(src: str, ids: str) -> str:
    """CTE list scoring ``src`` (columns ids..., txt) into sc(ids..., sentiment)."""
    return f"""st AS (SELECT {ids}, {_TK.format(c='txt')} AS tk FROM {src}),
sn AS (SELECT {ids}, tk, list_transform(tk, lambda x, k: list_has_any(list_slice(tk, greatest(1, k - 3), k - 1), {NEG_SQL})) AS ng FROM st),
se AS (SELECT {ids}, unnest(tk) AS token, unnest(ng) AS negated FROM sn),
ss AS (SELECT {ids}, sum(valence * CASE WHEN negated THEN {SE.NEGATION_SCALAR} ELSE 1.0 END) AS s FROM se JOIN lex USING (token) GROUP BY ALL),
sc AS (SELECT {ids}, coalesce(s / sqrt(s * s + {SE.ALPHA}), 0.0) AS sentiment FROM (SELECT {ids} FROM {src}) LEFT JOIN ss USING ({ids}))"""


_LEXICONS: dict = {}


def lexicon(spark, sf):
    """The derived lexicon, stored once per session (it is read by a size
    check and a join in every scoring query)."""
    from ladle.plans.scale import materialize
    key = (id(spark), spark.sparkContext.applicationId, sf)
    if key not in _LEXICONS:
        _LEXICONS[key] = materialize(SE.derive_lexicon(table(spark, sf, "documents"), table(spark, sf, "labels")))
    return _LEXICONS[key]


@register("derive_lexicon", f"""WITH {_LEX}
SELECT token, round(valence, 6) + 0.0 AS valence FROM lex""")
def q_lexicon(spark, sf):
    return finish(lexicon(spark, sf))


@register("score_texts", f"""WITH {_LEX}, src AS (SELECT doc_id, text AS txt FROM documents), {_score_sql('src', 'doc_id')}
SELECT doc_id, round(sentiment, 6) + 0.0 AS sentiment FROM sc""")
def q_score(spark, sf):
    d = table(spark, sf, "documents")
    return finish(SE.score_texts(d, lexicon(spark, sf), "doc_id", "text"))


@register("parse_reviews", """SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_reviews FROM documents""")
def q_parse(spark, sf):
    d = table(spark, sf, "documents").withColumn("reviews_list", SE.review_list_text())
    return finish(d.select("doc_id", F.size(SE.parse_reviews("reviews_list")).alias("n_reviews")))


@register("avg_sentiment", f"""WITH {_LEX},
src AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS review_no,
 unnest(string_split(text, chr(10))) AS txt FROM documents),
{_score_sql('src', 'doc_id, review_no')}
SELECT d.doc_id, round(coalesce(m, 0.0), 6) + 0.0 AS avg_sentiment FROM documents d
 LEFT JOIN (SELECT doc_id, avg(sentiment) AS m FROM sc GROUP BY doc_id) USING (doc_id)""")
def q_avg(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", SE.review_list_text().alias("reviews_list"))
    return finish(SE.avg_sentiment(d, lexicon(spark, sf), "doc_id").select("doc_id", "avg_sentiment"))


def classifier_scores(spark, sf):
    """Classifier outputs per labelled document: POSITIVE / NEGATIVE rows (or
    the LABEL_1 / LABEL_0 aliases on even ids); every third document lacks
    its negative row."""
    l = table(spark, sf, "labels")
    p = (0.5 + 0.4 * F.col("quality") - 0.3 * F.col("toxic")).cast("double")
    even = F.col("doc_id") % 2 == 0
    pos = l.select("doc_id", F.when(even, "LABEL_1").otherwise("POSITIVE").alias("label"), p.alias("score"))
    neg = l.where(F.col("doc_id") % 3 != 0).select(
        "doc_id", F.when(even, "LABEL_0").otherwise("negative").alias("label"), (1.0 - p).alias("score"))
    return pos.unionByName(neg)


_CLF = """clf AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'LABEL_1' ELSE 'POSITIVE' END AS label,
 CAST(0.5 + 0.4 * quality - 0.3 * toxic AS DOUBLE) AS score FROM labels
 UNION ALL SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'LABEL_0' ELSE 'negative' END,
 CAST(1.0 - (0.5 + 0.4 * quality - 0.3 * toxic) AS DOUBLE) FROM labels WHERE doc_id % 3 <> 0),
pol AS (SELECT doc_id, round_even(coalesce(max(CASE WHEN upper(label) IN ('POSITIVE', 'LABEL_1') THEN score END), 0.5)
 - coalesce(max(CASE WHEN upper(label) IN ('NEGATIVE', 'LABEL_0') THEN score END), 0.5), 4) AS polarity FROM clf GROUP BY doc_id)"""


@register("polarity_from_labels", f"WITH {_CLF} SELECT doc_id, round(polarity, 6) + 0.0 AS polarity FROM pol")
def q_polarity(spark, sf):
    return finish(SE.polarity_from_labels(classifier_scores(spark, sf)))


@register("score_multilingual", f"""WITH {_LEX}, {_CLF}, src AS (SELECT doc_id, text AS txt FROM documents),
{_score_sql('src', 'doc_id')}
SELECT d.doc_id, d.lang, round(CASE WHEN trim(coalesce(d.text, '')) <> '' AND p.polarity IS NOT NULL THEN p.polarity ELSE sc.sentiment END, 6) + 0.0
 AS sentiment, CASE WHEN trim(coalesce(d.text, '')) <> '' AND p.polarity IS NOT NULL THEN 'classifier' ELSE 'lexicon' END AS source
FROM documents d JOIN sc USING (doc_id) LEFT JOIN pol p USING (doc_id)""")
def q_multi(spark, sf):
    d = table(spark, sf, "documents")
    return finish(SE.score_multilingual(d, lexicon(spark, sf), classifier_scores(spark, sf)))
