"""Counts, position ranges and sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.functions.positions import commit_date, lsn_str


def event_counts(changes: DataFrame) -> DataFrame:
    """Changes per table, operation and commit day."""
    day = commit_date(F.col("commit_time"), F.col("timestamp"))
    return changes.groupBy("table", "operation", day.alias("commit_date")).agg(F.count(F.lit(1)).alias("events"))


def message_counts(messages: DataFrame) -> DataFrame:
    """Messages per slot and kind, the kinds that give no change row included.

    A truncate gives none, so this is where it shows.
    """
    return messages.groupBy("slot", "kind").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(~F.col("kind").isin("I", "U", "D", "C", "R", "B")).alias("ignored"),
    )


def lsn_ranges(changes: DataFrame, *by: str | Column) -> DataFrame:
    """Lowest and highest position and the number of changes, per commit day or ``by``."""
    day = commit_date(F.col("commit_time"), F.col("timestamp")).alias("commit_date")
    ranges = changes.groupBy("slot", *(by or (day,))).agg(
        F.min("lsn").alias("min_lsn"), F.max("lsn").alias("max_lsn"), F.count(F.lit(1)).alias("events")
    )
    return ranges.withColumn("first", lsn_str(F.col("min_lsn"))).withColumn("last", lsn_str(F.col("max_lsn")))


def file_stats(lake: DataFrame) -> DataFrame:
    """Per file: size, rows, bytes per row, and size relative to its image text."""
    text = F.coalesce(F.length("before"), F.lit(0)) + F.coalesce(F.length("after"), F.lit(0))
    per_file = lake.groupBy("commit_date", "batch_id", F.col("_metadata.file_path").alias("file")).agg(
        F.first("_metadata.file_size").alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(text).alias("image_chars"),
    )
    return per_file.withColumn("bytes_per_row", F.col("bytes") / F.col("rows")).withColumn(
        "ratio", F.col("bytes") / F.nullif(F.col("image_chars"), F.lit(0))
    )


def image_widths(changes: DataFrame) -> DataFrame:
    """Fields per image: totals and averages by table and operation."""
    before, after = (F.size(F.json_object_keys(c)) for c in ("before", "after"))
    widths = changes.groupBy("table", "operation").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.when(F.col("before").isNotNull(), before)).alias("before_fields"),
        F.sum(F.when(F.col("after").isNotNull(), after)).alias("after_fields"),
    )
    return widths.withColumn("avg_before", F.col("before_fields") / F.col("events")).withColumn(
        "avg_after", F.col("after_fields") / F.col("events")
    )
