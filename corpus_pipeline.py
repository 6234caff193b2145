"""The training-data pipeline: stages over documents, each reading what the one before has written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterloom.llm.bpe import encode_texts
from clusterloom.llm.decontaminate import without_leaks
from clusterloom.llm.jaccard import Rule, one_of_each
from clusterloom.llm.rules import without_rejected
from clusterloom.llm.secrets import redact_secrets
from clusterloom.storage import work_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the guaranteed cutoffs reject; a null or shared id drops no other row."""
    return without_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id.

    Rows are dropped one by one. Rows without an id go where a copy has one;
    groups in which no row has one stay whole.
    """
    return one_of_each(docs, Rule(words=5, percent=80)).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item; a null or shared id drops no other row."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked; the length follows the text."""
    masked = redact_secrets(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    encoded = encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"), outputs=("n_tokens", "ids"))
    return encoded.select("doc_id", "n_tokens", F.col("ids").cast("array<int>").alias("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("BPE encoding", bpe_encoding),
]

#: Exact binomial bounds, components, alignment, redaction and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_dir(spark)
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
