"""From raw documents to shards of training data, stage by stage.

Each stage takes the documents that the one before kept, and is written as Parquet
and read again, so that a lost executor costs the stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cdclake.llm import decontaminate, language, minhash, mixing, sharding
from cdclake.session import scratch_dir

SHARDS = 40

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay; those without a letter or any known n-gram go."""
    return language.recognised(docs, language.fit_profiles(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more, the one with the smallest id stays."""
    return minhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row, or a whole shorter item, with the benchmark go."""
    return decontaminate.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the tokens, sampled so that sources, languages and topics have their target weights."""
    return mixing.sample(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with ``shard`` and ``slot`` of a reproducible shuffle."""
    return sharding.shard_rows(docs, SHARDS, ["doc_id", "text"]).drop("position")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: SQL cannot express language profiles and dart signatures; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
