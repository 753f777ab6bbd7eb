"""The corpus pipeline: filter, deduplicate, redact, mix and tokenise ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet to the shared folder and read again as the next stage's ``docs``. All but
the last return the columns of ``documents``. A document is named by its doc_id;
extra columns pass through every stage but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import bpe, minhash, mixing, pii, rules
from tidegate.session import scratch_folder

BATCH_ROWS = "500"  # documents that travel to a Python worker at once: a few megabytes, in its memory and the executor's

# Quality rules are learned, so SQL cannot give run()'s rows; tests compare each stage with a plain version.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    """Bound what is between an executor and its workers, for texts; the stages run in executors of little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed limits and the learned decision list keep."""
    _small_batches(spark)
    return rules.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    _small_batches(spark)
    return minhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind; n_chars follows the text."""
    _small_batches(spark)
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a document taken twice is two rows."""
    return mixing.repeat(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: doc_id, source, n_tokens, ids (little-endian unsigned 32-bit), and the text decoded from them."""
    _small_batches(spark)
    ranks = bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keys=("doc_id", "source"))
    return coded.select("doc_id", "source", "n_tokens", "ids", F.col("decoded").cast("string").alias("decoded"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
