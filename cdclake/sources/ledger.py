"""The segment and progress ledgers on disk."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.schema import PROGRESS, SEGMENT
from cdclake.sources.files import delete, file_names, folders, micros_in_files, put_if_absent, replace_folders

_BATCH = T.StructField("batch_id", T.LongType())


def _write(rows: DataFrame, schema: T.StructType, path: str, batch_id: int) -> None:
    spark = rows.sparkSession
    micros_in_files(spark)
    writer = (
        rows.select(*schema.fieldNames(), F.lit(batch_id).cast("bigint").alias(_BATCH.name))
        .write.mode("overwrite")
        .partitionBy(_BATCH.name)
        .option("partitionOverwriteMode", "dynamic")
    )
    replace_folders(spark, f"{path}/{_BATCH.name}={batch_id}", lambda: writer.parquet(path))


def write_segments(segments: DataFrame, ledger: str, batch_id: int) -> None:
    """Record a batch's segments; recording a batch again replaces its rows."""
    _write(segments, SEGMENT, f"{ledger}/segments", batch_id)


def write_progress(progress: DataFrame, ledger: str, batch_id: int) -> None:
    """Record a batch's progress samples; recording again replaces them."""
    _write(progress, PROGRESS, f"{ledger}/progress", batch_id)


def _segment_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType([*SEGMENT.fields, _BATCH])).parquet(path)


def _fold(spark: SparkSession, ledger: str) -> int | None:
    """The batch up to which the segment ledger was folded last."""
    done = [int(n.removesuffix(".json")) for n in file_names(spark, f"{ledger}/folds") if n.endswith(".json") and n[0].isdigit()]
    return max(done, default=None)


def read_segments(spark: SparkSession, ledger: str) -> DataFrame:
    """The segment ledger.  A ledger that is not there is an error."""
    rows, fold = _segment_rows(spark, f"{ledger}/segments"), _fold(spark, ledger)
    if fold is None:
        return rows
    return _segment_rows(spark, f"{ledger}/folds/rows-{fold}").unionByName(rows.filter(F.col(_BATCH.name) > fold))


def fold_segments(spark: SparkSession, ledger: str, fold: Callable[[DataFrame], DataFrame]) -> int | None:
    """Put what ``fold`` makes of the rows of all batches in their place; returns the last of these, None if none is new.

    The folded rows count from the moment that their record is put, in place of those
    of the batches, which are removed after.  Cut short anywhere it loses nothing.
    """
    pattern = f"{ledger}/segments/{_BATCH.name}=*"
    batches = [int(f.rsplit("=", 1)[1]) for f in folders(spark, pattern)]
    newest, last = max(batches, default=None), _fold(spark, ledger)
    if newest is None or last is not None and newest <= last:
        return None
    micros_in_files(spark)
    rows = fold(read_segments(spark, ledger)).withColumn(_BATCH.name, F.lit(newest).cast("bigint"))
    rows.select(*SEGMENT.fieldNames(), _BATCH.name).write.mode("overwrite").parquet(f"{ledger}/folds/rows-{newest}")
    put_if_absent(spark, f"{ledger}/folds/{newest}.json", "{}")
    for batch in batches:
        delete(spark, f"{ledger}/segments/{_BATCH.name}={batch}")
    if last is not None:
        delete(spark, f"{ledger}/folds/rows-{last}")
        delete(spark, f"{ledger}/folds/{last}.json")
    return newest


def read_progress(spark: SparkSession, ledger: str) -> DataFrame:
    """The progress ledger.  A ledger that is not there is an error."""
    return spark.read.schema(T.StructType([*PROGRESS.fields, _BATCH])).parquet(f"{ledger}/progress")
