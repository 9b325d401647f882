"""Landed messages as a static or a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdclake.schema import MESSAGE


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """All messages landed under ``path``."""
    return spark.read.schema(MESSAGE).parquet(path)


def stream_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages landed under ``path``, as a stream.

    Files must land in ``seq`` order.  ``max_files_per_trigger`` bounds how much
    one micro-batch takes in.
    """
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
