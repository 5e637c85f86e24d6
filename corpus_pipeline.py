"""From documents to token ids: quality rules, exact and near duplicates, source mix, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. The cube method's choice of documents has no SQL, so ORACLE_SQL is None and the
stages are tested against plain Python.

Defined cases: those of each operator; a document with null text has no words and goes in the first
stage; a document that the mix takes twice is there twice and is encoded twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import bpe, exact, mixing, neardup, quality
from pagewright.llm.common import durable
from pagewright.llm.queries import tokenizer_file


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.of_quality(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.without_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.without_near_duplicates(docs, 5, 80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.coding_report(docs, tokenizer_file())


STAGES = [
    ("quality_rules", keep_quality),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = durable(docs, f"pipeline-{name}")
    return docs
