"""The training-corpus pipeline: from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept. All but the last return
the columns of ``documents``. Between stages rows are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm import bpe, decontam, secrets, simhash, toxicity
from snapflow.llm.common import fold, table
from snapflow.session import settled

ORACLE_SQL = None  # trained models and token ids have no SQL form


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the labels of three quarters of the ids."""
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2)
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark, and ``n_chars`` follows."""
    spans = "_redacted_spans"
    found = secrets.find(docs, secrets.train(docs), into=spans).withColumn(f"{spans}_text", secrets.redact(F.col("text"), F.col(spans)))
    clean, changed = F.col(f"{spans}_text"), F.size(spans) > 0
    return found.select(*[
        clean.alias(c) if c == "text"
        else F.when(changed, F.length(clean).cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == "n_chars"
        else F.col(f"`{c}`") for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of the text decoded from them."""
    coded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
