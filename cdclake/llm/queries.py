"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cdclake.llm import (
    centroids,
    decontaminate,
    exact_dedup,
    html_text,
    language,
    lm,
    minhash,
    mixing,
    quality,
    sharding,
    toxicity,
    warc,
    whitening,
)
from cdclake.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SHARDS = 40


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int) -> Column:
    """The documents' held-out fold: CRC-32 of the id's text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    figures = [F.round(c, 6).alias(c) for c in ("weight", "probability")]
    return mixed.select("doc_id", "source", "lang", "topic", "tokens", *figures, "sampled")


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit_quality(docs.filter(fold(5) != 0), labels)
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language.fit_profiles(docs.filter(fold(3) != 1))
    found = language.identify(docs, profiles, ["doc_id"])
    return found.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(content).cast("long") + 16).alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.xxhash64("text").alias("text_mark"),
    )
    placed = sharding.shard_rows(rows, SHARDS, ["doc_id", "text_mark", "size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm.score(docs, lm.train(docs.filter(fold(7) != 2)), ["doc_id"])
    return scored.select(
        "doc_id", (fold(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return warc.read_archives(archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(table(spark, sf_dir, "documents")).drop("text_mark")


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    error = whitening.identity_error(vectors, model) if model else 0.0
    rows = whitening.whiten(vectors, model, ["vec_id"])
    return rows.select(
        "vec_id",
        "component",
        F.lit(model.n if model else 0).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        "explained",
        F.lit(error).alias("identity_error"),
        F.col("deviation").alias("deviation_exact"),
    )


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    whole = ("distance", "cluster_inertia", "inertia")
    return found.select("vec_id", "cluster", *(F.col(c).try_cast("long").alias(c) for c in whole), "centroid_sha256")


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit_toxicity(docs.filter(fold(4) != 2), labels)
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
