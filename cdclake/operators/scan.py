"""Ordered scans that never put a whole sequence into one task.

A slot is one long sequence of messages, so a window over it would run in a
single task.  A scan here cuts the sequence into chunks of ``2 ** chunk_bits``
positions, reduces every chunk to one row, scans those rows, and finishes inside
each chunk with the chunk's starting value.  The rows of the chunks are scanned in
the same way, by blocks of as many chunks.  The result is the same as that of the
plain window; a task sees one chunk, one block, or a row per block.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions per chunk as a power of two.
CHUNK_BITS = 14

#: Chunks per block as a power of two.
BLOCK_BITS = 14

_CHUNK, _BLOCK = "__chunk", "__block"


@dataclass(frozen=True)
class Running:
    """One running value.

    ``how`` is ``last`` (newest non-null value up to this row), ``next`` (first
    non-null value from this row on), ``lag`` (value of the row before), ``max``
    or ``sum`` (both up to and including this row).
    """

    how: str
    value: Column


def chunk_of(order: Column, chunk_bits: int = CHUNK_BITS) -> Column:
    """Chunk number of a position."""
    return F.shiftright(order, chunk_bits)


def _local(scan: Running, forward, backward) -> Column:
    if scan.how == "last":
        return F.last(scan.value, ignorenulls=True).over(forward.rowsBetween(Window.unboundedPreceding, 0))
    if scan.how == "next":
        return F.last(scan.value, ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, 0))
    if scan.how == "lag":
        return F.lag(scan.value).over(forward)
    if scan.how == "max":
        return F.max(scan.value).over(forward.rowsBetween(Window.unboundedPreceding, 0))
    if scan.how == "sum":
        return F.sum(scan.value).over(forward.rowsBetween(Window.unboundedPreceding, 0))
    raise ValueError(f"unknown scan {scan.how!r}")


def _per_chunk(scan: Running, order: Column) -> Column:
    if scan.how == "last":
        return F.max_by(scan.value, F.when(scan.value.isNotNull(), order))
    if scan.how == "next":
        return F.min_by(scan.value, F.when(scan.value.isNotNull(), order))
    if scan.how == "lag":
        return F.max_by(scan.value, order)
    return F.max(scan.value) if scan.how == "max" else F.sum(scan.value)


def _seed(scan: Running, name: str, forward, backward) -> Column:
    before = forward.rowsBetween(Window.unboundedPreceding, -1)
    if scan.how == "last":
        return F.last(name, ignorenulls=True).over(before)
    if scan.how == "next":
        return F.last(name, ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, -1))
    if scan.how == "lag":
        return F.lag(name).over(forward)
    return (F.max if scan.how == "max" else F.sum)(name).over(before)


def _combine(scan: Running, local: Column, seed: Column, first: Column) -> Column:
    if scan.how in ("last", "next"):
        return F.coalesce(local, seed)
    if scan.how == "lag":
        return F.when(first, seed).otherwise(local)
    if scan.how == "max":
        return F.greatest(local, seed)  # ignores nulls
    return F.coalesce(local + seed, local, seed)


def chunk_seeds(
    summary: DataFrame,
    keys: list[str],
    scans: Mapping[str, Running],
    constants: DataFrame | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """``keys``, the chunk, and what each scan has come to before the chunk starts.

    ``summary`` has a row per ``keys`` and chunk with the value of each scan in the
    chunk alone, under the scan's name.  Blocks of chunks are reduced to a row, these
    are scanned, and each block goes on from what came before it.  ``constants``
    (see :func:`ordered_scan`) join the rows of the blocks and come along.
    """
    own = {name: Running(scan.how, F.col(name)) for name, scan in scans.items()}
    part = [*keys, _BLOCK]
    blocked = summary.select(*keys, _CHUNK, F.shiftright(_CHUNK, block_bits).alias(_BLOCK), *scans)

    blocks = blocked.groupBy(*part).agg(*[_per_chunk(scan, F.col(_CHUNK)).alias(f"{n}_of_block") for n, scan in own.items()])
    along = Window.partitionBy(*keys)
    before = blocks.select(
        *part,
        *[
            _seed(scan, f"{n}_of_block", along.orderBy(_BLOCK), along.orderBy(F.desc(_BLOCK))).alias(f"{n}_before")
            for n, scan in own.items()
        ],
    )
    added = []
    if constants is not None:
        by = [k for k in keys if k in constants.columns]
        added = [c for c in constants.columns if c not in by]
        before = before.join(constants, by, "left")
    inside = Window.partitionBy(*part)
    forward, backward = inside.orderBy(_CHUNK), inside.orderBy(F.desc(_CHUNK))
    local = blocked.select(
        *part,
        _CHUNK,
        *[_seed(scan, n, forward, backward).alias(f"{n}_local") for n, scan in own.items()],
        (F.row_number().over(forward) == 1).alias("__first"),
    )
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"b.{k}")) for k in part]
    joined = local.alias("l").join(before.alias("b"), reduce(Column.__and__, same), "left")
    return joined.select(
        *[F.col(f"l.{k}").alias(k) for k in (*keys, _CHUNK)],
        *[F.col(f"b.{c}").alias(c) for c in added],
        *[_combine(scan, F.col(f"{n}_local"), F.col(f"{n}_before"), F.col("__first")).alias(n) for n, scan in own.items()],
    )


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: str,
    scans: Mapping[str, Running],
    chunk_bits: int = CHUNK_BITS,
    constants: DataFrame | None = None,
) -> DataFrame:
    """``df`` with one more column per scan, computed per ``keys`` along ``order``.

    ``keys`` must not be null, and ``order`` must be a bigint that is unique
    within them.  ``constants`` holds further columns by some of the keys, one row
    each; they reach the rows through the blocks and chunks, because a join on the
    key alone would gather a whole key in one task.
    """
    position = F.col(order)
    chunked = df.withColumn(_CHUNK, chunk_of(position, chunk_bits))
    part = [*keys, _CHUNK]

    summary = chunked.groupBy(*part).agg(
        *[_per_chunk(scan, position).alias(f"__{name}_seed") for name, scan in scans.items()]
    )
    seeds = chunk_seeds(summary, keys, {f"__{name}_seed": scan for name, scan in scans.items()}, constants)
    added = [] if constants is None else [c for c in constants.columns if c not in keys]

    inside = Window.partitionBy(*part)
    forward, backward = inside.orderBy(order), inside.orderBy(F.desc(order))
    local = chunked.select(
        "*",
        *[_local(scan, forward, backward).alias(f"__{name}_local") for name, scan in scans.items()],
        (F.row_number().over(forward) == 1).alias("__first"),
    )
    # Same keys as the window, so the join needs no shuffle of the wide side.
    joined = local.join(seeds, part, "left")
    return joined.select(
        *df.columns,
        *added,
        *[
            _combine(scan, F.col(f"__{name}_local"), F.col(f"__{name}_seed"), F.col("__first")).alias(name)
            for name, scan in scans.items()
        ],
    )
