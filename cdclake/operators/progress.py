"""Durable positions, resuming, backlog and health."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdclake.operators.scan import CHUNK_BITS, Running, chunk_of, ordered_scan
from cdclake.sources.ledger import fold_segments, read_segments

#: How long delivery may be blocked before a slot is not ready.
MAX_BLOCK = dt.timedelta(seconds=60)


#: Event positions per chunk of a segment ledger, as a power of two: thousands of
#: segments of the usual size.
SEGMENT_CHUNK_BITS = 22


def contiguous_prefix(
    segments: DataFrame, read_idx: int | Column = 0, chunk_bits: int = SEGMENT_CHUNK_BITS
) -> DataFrame:
    """Per slot, how far every segment is finished, and the position that confirms.

    The prefix starts at ``read_idx`` (a number, or a column of ``segments`` that
    is the same in all rows of a slot) and ends before the first segment that is
    unfinished or does not start where the one before ends.  ``acked_lsn`` is the
    position of its last segment and ``confirmed_lsn`` the highest in it: after a
    replay the last position can be below one that is durable already.  Segments
    behind ``read_idx`` were confirmed earlier.  A slot whose prefix is empty keeps its
    ``read_idx`` and has null positions; one with no segment from there on has no
    row.

    Each chunk of the ledger is reduced to one row (where it starts and ends, and
    how far it is unbroken); only these are put in order per slot.
    """
    read = read_idx if isinstance(read_idx, Column) else F.lit(read_idx)
    start, end, chunk = F.col("start_idx"), F.col("end_idx"), "__chunk"
    live = (
        segments.withColumn("__read", read.cast("bigint"))
        .filter(start >= F.col("__read"))
        .withColumn(chunk, chunk_of(start, chunk_bits))
    )
    inside = Window.partitionBy("slot", chunk).orderBy("start_idx")
    before = F.lag("end_idx").over(inside)
    breaks = F.when(F.col("done") & F.coalesce(start == before, F.lit(True)), 0).otherwise(1)
    broken = F.sum("__breaks").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    unbroken_end = F.when(F.col("__broken") == 0, end)
    chunks = (
        live.withColumn("__breaks", breaks)
        .withColumn("__broken", broken)
        .groupBy("slot", chunk)
        .agg(
            F.min("__read").alias("read"),
            F.min(start).alias("first_start"),
            F.max_by(end, start).alias("last_end"),
            F.max(unbroken_end).alias("unbroken_end"),
            F.max_by("last_lsn", unbroken_end).alias("unbroken_lsn"),
            F.max(F.when(F.col("__broken") == 0, F.col("last_lsn"))).alias("highest_lsn"),
            (F.max("__broken") > 0).alias("has_break"),
        )
    )
    in_slot = Window.partitionBy("slot").orderBy(chunk)
    linked = F.col("first_start") == F.coalesce(F.lag("last_end").over(in_slot), "read")
    earlier = F.max(F.col("has_break") | ~F.col("linked")).over(in_slot.rowsBetween(Window.unboundedPreceding, -1))
    reached = F.when(F.col("linked") & ~F.coalesce("broken_earlier", F.lit(False)), F.col("unbroken_end"))
    return (
        chunks.withColumn("linked", linked)
        .withColumn("broken_earlier", earlier)
        .groupBy("slot")
        .agg(
            F.coalesce(F.max(reached), F.max("read")).alias("read_idx"),
            F.max_by("unbroken_lsn", reached).alias("acked_lsn"),
            F.max(F.when(reached.isNotNull(), F.col("highest_lsn"))).alias("confirmed_lsn"),
        )
    )


def folded(segments: DataFrame, chunk_bits: int = SEGMENT_CHUNK_BITS) -> DataFrame:
    """``segments`` with every run of adjacent finished ones as two rows: all but the last, and the last.

    The first has the highest position of its segments, the second its own, so that
    :func:`contiguous_prefix` from the ledger's start and :func:`acked_position` give the
    same on either.  Unfinished segments stay.  What is left is bounded by the gaps and
    by what is open, however long the ledger was.
    """
    kept = ["start_idx", "end_idx", "done", "last_lsn", "cut_at", "done_at"]
    before = {"__end": Running("lag", F.col("end_idx")), "__done": Running("lag", F.col("done"))}
    scanned = ordered_scan(segments.select("slot", *kept), ["slot"], "start_idx", before, chunk_bits)
    joins = F.col("done") & F.coalesce("__done", F.lit(False)) & F.coalesce(F.col("start_idx") == F.col("__end"), F.lit(False))
    begins = F.when(joins, F.lit(None)).otherwise(F.col("start_idx"))
    runs = ordered_scan(scanned, ["slot"], "start_idx", {"__run": Running("last", begins)}, chunk_bits)
    ends = runs.groupBy("slot", "__run").agg(F.max("start_idx").alias("__last"))
    return (
        runs.join(ends, ["slot", "__run"])
        .groupBy("slot", "__run", (F.col("start_idx") == F.col("__last")).alias("__part"))
        .agg(
            F.min("start_idx").alias("start_idx"), F.max("end_idx").alias("end_idx"), F.bool_and("done").alias("done"),
            F.max("last_lsn").alias("last_lsn"), F.max("cut_at").alias("cut_at"), F.max("done_at").alias("done_at"),
        )
        .select("slot", *kept)
    )


def fold_ledger(spark: SparkSession, ledger: str) -> int | None:
    """Fold the segment ledger (see :func:`folded`); returns the last batch it covers, None if there is nothing new.

    Do it now and then beside a running stream: readers see the ledger before or after.
    """
    return fold_segments(spark, ledger, folded)


def acked_position(positions: DataFrame, value: str = "acked_lsn") -> DataFrame:
    """Current confirmed position per slot: the highest one ever published."""
    return positions.groupBy("slot").agg(F.max(value).alias("acked_lsn"))


def acked_history(
    positions: DataFrame, value: str = "acked_lsn", order: str = "end_idx", chunk_bits: int = SEGMENT_CHUNK_BITS
) -> DataFrame:
    """``positions`` with ``confirmed_lsn``: the highest value up to each row.

    Lower values are ignored, so the result never falls along ``order``.
    """
    return ordered_scan(positions, ["slot"], order, {"confirmed_lsn": Running("max", F.col(value))}, chunk_bits)


def position_regressions(progress: DataFrame) -> DataFrame:
    """Samples whose confirmed position is lower than in the sample before."""
    timed = progress.withColumn("__at", F.unix_micros("at"))
    # Chunks of 2^36 microseconds (about 19 hours) of samples.
    scanned = ordered_scan(timed, ["slot"], "__at", {"previous_lsn": Running("lag", F.col("acked_lsn"))}, chunk_bits=36)
    return scanned.filter(F.col("acked_lsn") < F.col("previous_lsn")).drop("__at")


def safe_restart(
    messages: DataFrame, acked: int | DataFrame, chunk_bits: int = CHUNK_BITS
) -> DataFrame:
    """Messages that a restart from the confirmed position must handle again.

    ``acked`` is a position, or rows ``slot, acked_lsn``.  A transaction whose
    commit ends above it is replayed whole, also if some of its rows lie below,
    and also if its commit never arrived.  One whose commit ends exactly there is
    not replayed.  Relation messages are always kept: later rows need them.
    """
    end = F.when(F.col("kind") == "C", F.col("end_lsn"))
    if isinstance(acked, DataFrame):
        by_slot, confirmed_to = acked.select("slot", F.col("acked_lsn").alias("__acked")), F.col("__acked")
    else:
        by_slot, confirmed_to = None, F.lit(acked)
    ended = ordered_scan(messages, ["slot", "session"], "seq", {"__txn_end": Running("next", end)}, chunk_bits, by_slot)
    confirmed = F.coalesce(F.col("__txn_end") <= confirmed_to, F.lit(False))
    return ended.filter(~confirmed | (F.col("kind") == "R")).select(*messages.columns)


def resume(
    spark: SparkSession,
    messages: DataFrame,
    ledger: str,
    last_acked: DataFrame | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Messages after the position that is confirmed for their slot.

    A slot's position is the highest in the finished prefix of the segment ledger,
    and never lower than its row of ``last_acked`` (``slot, acked_lsn``), what this
    process confirmed last.  A slot in one of the two only is taken from there; one
    in neither starts from the beginning.  A ledger that cannot be read is an error:
    starting anywhere else could skip changes.
    """
    confirmed = contiguous_prefix(read_segments(spark, ledger)).select("slot", F.col("confirmed_lsn").alias("acked_lsn"))
    if last_acked is not None:
        confirmed = acked_position(confirmed.unionByName(last_acked.select("slot", "acked_lsn")))
    return safe_restart(messages, confirmed.select("slot", F.coalesce("acked_lsn", F.lit(0).cast("bigint")).alias("acked_lsn")), chunk_bits)


def backlog(progress: DataFrame) -> DataFrame:
    """Per slot, the most events that waited to become durable, and how many wait now."""
    depth = F.col("write_idx") - F.col("read_idx")
    return progress.groupBy("slot").agg(F.max(depth).alias("max_backlog"), F.max_by(depth, "at").alias("backlog"))


#: What :func:`stream_health` says of a slot.
STOPPED, BLOCKED, READY = "stopped", "blocked", "ready"


def stream_health(progress: DataFrame, now: Column) -> DataFrame:
    """Per slot, whether it is ready at ``now``, from its newest sample.

    Not ready: no stream is known to run, or delivery has been blocked for more
    than 60 seconds.
    """
    newest = progress.groupBy("slot").agg(
        F.max_by(F.struct("at", "streaming", "blocked_since"), "at").alias("s"),
    )
    blocked = F.unix_micros(now) - F.unix_micros("s.blocked_since")
    limit = int(MAX_BLOCK.total_seconds() * 1_000_000)
    status = (
        F.when(~F.coalesce("s.streaming", F.lit(False)), STOPPED)
        .when(blocked > limit, BLOCKED)
        .otherwise(READY)
    )
    return newest.select("slot", F.col("s.at").alias("at"), status.alias("status"), (status == READY).alias("ready"))
