"""Which changes go into which file: segments, day runs and the file manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdclake.functions.positions import commit_date
from cdclake.operators.scan import CHUNK_BITS, Running, ordered_scan
from cdclake.session import materialized

#: Events per segment.
BATCH_SIZE = 1000

#: Codec label in a file key.
CODEC = "ZSTD"


def event_index(changes: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """``changes`` with ``idx``: the position of each event in its slot, from 0."""
    counted = ordered_scan(changes, ["slot"], "seq", {"idx": Running("sum", F.lit(1).cast("bigint"))}, chunk_bits)
    return counted.withColumn("idx", F.col("idx") - 1)


def with_segment(changes: DataFrame, n: int = BATCH_SIZE, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """``changes`` with ``idx`` and ``segment``: runs of ``n`` events in arrival order."""
    indexed = event_index(changes, chunk_bits)
    idx = F.col("idx")
    return indexed.withColumn("segment", ((idx - F.pmod(idx, F.lit(n))) / n).cast("bigint"))


def segments_by_count(changes: DataFrame, n: int = BATCH_SIZE, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """One not yet finished segment per ``n`` consecutive events; the tail is partial."""
    return (
        with_segment(changes, n, chunk_bits)
        .groupBy("slot", "segment")
        .agg(
            F.min("idx").alias("start_idx"),
            (F.max("idx") + 1).alias("end_idx"),
            F.max_by("lsn", "idx").alias("last_lsn"),
            F.max_by("timestamp", "idx").alias("cut_at"),
        )
        .select(
            "slot",
            "start_idx",
            "end_idx",
            F.lit(False).alias("done"),
            "last_lsn",
            "cut_at",
            F.lit(None).cast("timestamp").alias("done_at"),
        )
    )


def segments_by_interval(changes: DataFrame, interval: str = "30 seconds") -> DataFrame:
    """One not yet finished segment per tick with events since the tick before.

    Ticks are aligned to the epoch.  Events are counted into ticks first, so the
    running position is taken over ticks, not over events.
    """
    per_tick = (
        changes.groupBy("slot", F.window("timestamp", interval).alias("tick"))
        .agg(F.count(F.lit(1)).alias("n"), F.max_by("lsn", "seq").alias("last_lsn"))
        .select("slot", F.col("tick.end").alias("cut_at"), "n", "last_lsn")
        .withColumn("cut_micros", F.unix_micros("cut_at"))
    )
    # Chunks of 2^42 microseconds (about 51 days) of ticks.
    placed = ordered_scan(per_tick, ["slot"], "cut_micros", {"end_idx": Running("sum", F.col("n"))}, chunk_bits=42)
    return placed.select(
        "slot",
        (F.col("end_idx") - F.col("n")).alias("start_idx"),
        "end_idx",
        F.lit(False).alias("done"),
        "last_lsn",
        "cut_at",
        F.lit(None).cast("timestamp").alias("done_at"),
    )


def day_runs(changes: DataFrame, n: int = BATCH_SIZE, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """``changes`` with ``segment``, ``commit_date`` and ``run``.

    A run is a stretch of consecutive events of one commit day inside a segment;
    a day that comes back starts a new run.
    """
    in_segment = Window.partitionBy("slot", "segment").orderBy("idx")
    day = F.col("commit_date")
    changed = F.when(day != F.lag(day).over(in_segment), 1).otherwise(0)
    return (
        with_segment(changes, n, chunk_bits)
        .withColumn("commit_date", commit_date(F.col("commit_time"), F.col("timestamp")))
        .withColumn("__changed", changed)
        .withColumn("run", F.sum("__changed").over(in_segment.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("__changed")
    )


def file_key(namespace: Column, day: Column, last_decoded: Column, sequence: Column) -> Column:
    """``namespace/YYYY/MM/DD/<last decode micros>-<sequence>.<codec>.parquet``."""
    dated = F.replace(day.cast("string"), F.lit("-"), F.lit("/"))
    return F.concat(
        namespace, F.lit("/"), dated, F.lit("/"), F.unix_micros(last_decoded), F.lit("-"), sequence,
        F.lit(f".{CODEC}.parquet"),
    )


def file_manifest(
    changes: DataFrame,
    namespace: str | Column,
    n: int = BATCH_SIZE,
    *predicates: Column,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """One row per day run, with its positions, row count and file key.

    Runs, decode times and positions count every event; ``rows`` counts those
    that pass the predicates.  A run with no row left has no file, so it gets no
    key and uses no sequence number.  Sequence numbers rise with the runs of a
    slot; the slots of a namespace are numbered one after the other, from 1, so that
    no key comes twice.  A namespace given as a column must be the same in all rows
    of a slot.

    The runs (one row per file) are written to the scratch folder first, because
    numbering them reads them twice; the changes are gone through only once.
    """
    kept = reduce(Column.__and__, predicates, F.lit(True))
    where = namespace if isinstance(namespace, Column) else F.lit(namespace)
    runs = (
        day_runs(changes, n, chunk_bits)
        .groupBy("slot", "segment", "run", "commit_date")
        .agg(
            F.first(where).alias("__namespace"),
            F.min("idx").alias("start_idx"),
            F.count(F.lit(1)).alias("events"),
            F.count_if(kept).alias("rows"),
            F.min_by("lsn", "idx").alias("first_lsn"),
            F.max_by("lsn", "idx").alias("last_lsn"),
            F.max_by("timestamp", "idx").alias("last_decoded"),
        )
    )
    has_file = F.col("rows") > 0
    runs = materialized(runs.withColumn("namespace", F.col("__namespace")).drop("__namespace"), "runs")
    files = runs.groupBy("slot", "namespace").agg(F.count_if(has_file).alias("n"))  # a row per slot
    earlier = Window.partitionBy("namespace").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("slot", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__earlier"))
    numbered = ordered_scan(
        runs,
        ["slot"],
        "start_idx",
        {"sequence": Running("sum", has_file.cast("bigint"))},
        # About as many runs per chunk as a chunk of changes has changes.
        chunk_bits=chunk_bits + max(n.bit_length() - 1, 0),
        constants=offsets,
    ).withColumn("sequence", F.col("sequence") + F.col("__earlier"))
    return numbered.select(
        "slot",
        "segment",
        "run",
        "commit_date",
        "start_idx",
        "events",
        "rows",
        "first_lsn",
        "last_lsn",
        "last_decoded",
        F.when(has_file, F.col("sequence")).alias("sequence"),
        F.when(has_file, file_key(F.col("namespace"), F.col("commit_date"), F.col("last_decoded"), F.col("sequence"))).alias("key"),
    )
