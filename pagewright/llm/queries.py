"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact, extraction, licences, merkle, mixing, neardup, negatives, quality, secret_scan, sharding, substrings, warc
from .oracles import ORACLES


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """The public tokenizer file's place: in the installed package, or under /opt/tokenizers."""
    found = importlib.util.find_spec("public_tokenizers")
    folder = Path(found.origin).parent if found and found.origin else Path("/opt/tokenizers")
    return str(folder / name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": lambda spark, d: sharding.shard(table(spark, d, "documents")),
        "op2_substring_dedup": lambda spark, d: substrings.substring_report(table(spark, d, "documents")),
        "op3_secret_scan": lambda spark, d: secret_scan.secrets_report(table(spark, d, "documents")),
        "op4_exact_dedup": lambda spark, d: exact.exact_duplicates(table(spark, d, "documents")),
        "op5_bpe": lambda spark, d: bpe.coding_report(table(spark, d, "documents"), tokenizer_file()),
        "op6_warc": lambda spark, d: warc.warc_report(table(spark, d, "pages")),
        "op7_minhash_near_dedup": lambda spark, d: neardup.near_report(table(spark, d, "documents"), 3, 85),
        "op8_quality_rules": lambda spark, d: quality.quality_report(table(spark, d, "documents")),
        "op9_html_extraction": lambda spark, d: extraction.extract(table(spark, d, "pages")),
        "op10_mixing": lambda spark, d: mixing.mix_report(table(spark, d, "documents")),
        "op11_merkle_manifest": lambda spark, d: merkle.merkle_report(table(spark, d, "documents")),
        "op12_license_scan": lambda spark, d: licences.licence_report(table(spark, d, "documents")),
        "op13_hard_negatives": lambda spark, d: negatives.hard_negatives(table(spark, d, "embeddings")),
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
