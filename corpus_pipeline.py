"""The corpus pipeline: documents through the stages below, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import bpe, decontam, dedup_exact, jaccard, langid
from folioflow.llm.shared import staged

RANKS = "byte_bpe_multi_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no language that the model knows, go."""
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(True))
    return langid.keep_known(docs, langid.train(docs.filter(learn)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return dedup_exact.drop_exact_duplicates(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates that links connect the row with the smallest doc_id stays."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and starts (byte offsets) of every document that is left."""
    return bpe.encode(docs, bpe.read_ranks(public_tokenizers.path(RANKS)))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("bpe_encode", bpe_encode),
]

#: The language model and the edit-distance search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
