"""Documents through five operators; each stage works on what its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next one's ``docs``.  All but the last return the
columns of documents; the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinlink.llm import decontamination, jaccard, mixing, quality, sharding
from kinlink.llm.shared import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the weakly supervised rules reject."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class linked at a similarity of 0.8 or more."""
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents so that sources near their target weights, a row a copy."""
    return mixing.mix(docs, ["doc_id"])


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the rows to 24 shards in a reproducible shuffle."""
    return sharding.shard_rows(docs, ["doc_id"], 24)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("sharding", shards),
]

#: Hashes, estimated rules and permutations are not SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
