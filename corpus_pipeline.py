"""Corpus pipeline: documents through five operators of ``ladle.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. The first four keep the
columns of documents; the last returns the packed pieces.

1. toxicity: rows that the classifier scores 0.5 or more go.
2. near_duplicates: one row of each component stays (five-word shingles,
   similarity 0.8 or more), the one with the smallest id.
3. substrings: words in windows of 13 that a kept document with a smaller id has
   too go; ``n_chars`` follows the text. A text that loses all its words stays as
   an empty one.
4. secrets: the characters of every finding become asterisks.
5. packing: all texts as token pieces in windows of 1024.

Null texts and ids, empty tables and columns beyond these pass as each operator
defines them; ``n_chars`` is only set where the table has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import neardup, packing, secrets, substrings, toxicity
from ladle.llm.common import documents, stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs, shingle=5, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", toxicity_stage), ("near_duplicates", near_duplicate_stage), ("substrings", substring_stage),
          ("secrets", secret_stage), ("packing", packing_stage)]

#: The classifier, the joins by hashes and the tokenizer have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
