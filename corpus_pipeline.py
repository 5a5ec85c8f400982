"""The corpus pipeline: documents with a language, one of each near-duplicate
class, without personal data, mixed to source weights, as token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given;
all but the last return the columns of ``documents``.  Stages learn what they
need (language models, weights, sizes) from their own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, jaccard, langid, mixing, pii
from lectern.session import materialize

LEAST_LANGUAGE_SCORE = 0.2     # of the score of the language prediction
SHINGLE, SIMILARITY = 5, 80    # words, per cent


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a determinable language."""
    return langid.keep_identified(docs, langid.train(docs), LEAST_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least id of each class of near duplicates."""
    return jaccard.keep_one(docs, SHINGLE, SIMILARITY)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data; ``n_chars`` follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target rate asks for."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, and the digest of what the ids decode to."""
    return bpe.with_ids(docs, ["doc_id", "lang", "source"])


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources", mix),
    ("byte-level BPE", encode),
]

# Learned models and tokenisers cannot be written in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
