"""Reproducible shuffle and shards by a Feistel permutation of row numbers.

Rows are numbered from 0 in the order of a hash of their identity, whatever the
partitioning.  A Feistel network over ``a * b >= n`` values permutes the numbers;
a value outside ``0 .. n-1`` walks on along its cycle until it is inside.  The
place of a row follows from its number alone: shard ``p % shards``, slot
``p // shards``.  Everything is built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 6
#: Steps of a walk.  At most sqrt(n) of n + sqrt(n) values lie outside, so that this is a
#: proven bound below 4,096 rows, and beyond has a chance of at most 64**-64 to be too few.
WALK = 64
#: Ranges of the hash that are numbered apart; also the rows of the broadcast table of their first numbers.
BUCKETS = 1 << 13


def shard_rows(
    df: DataFrame, shards: int, identity: list[str], seed: int = 1, buckets: int = BUCKETS
) -> DataFrame:
    """``df`` with ``position``, ``shard`` and ``slot``; columns of these names are replaced.

    Shards hold equal numbers of rows, at most one apart, and slots run from 0
    without gaps.  ``identity`` names columns that tell rows apart; rows equal in
    all of them, nulls included, are interchangeable and share a hash range.
    An empty table gives no rows; fewer rows than shards leave shards empty.
    """
    df = df.drop("position", "shard", "slot")
    mark = F.xxhash64(*identity)
    numbered = number_rows(df, mark, identity, buckets)
    place = permuted(F.col("__feistel_row"), F.col("__feistel_rows"), seed)
    return (
        numbered.withColumn("position", place)
        .drop("__feistel_row", "__feistel_rows")
        .withColumns(
            {
                "shard": F.pmod(F.col("position"), F.lit(shards)).cast("int"),
                "slot": F.floor(F.col("position") / F.lit(shards)).cast("long"),
            }
        )
    )


def number_rows(df: DataFrame, mark: Column, identity: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``__feistel_row``, its number from 0, and ``__feistel_rows``, the number of rows.

    Only the counts per hash range meet in one task: ``buckets`` rows at most,
    which is also the proven size of what is broadcast.
    """
    bucket = F.pmod(mark, F.lit(buckets))
    before = Window.orderBy("__feistel_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(bucket.alias("__feistel_bucket"))
        .agg(F.count("*").alias("n"))
        .select(
            "__feistel_bucket",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__feistel_start"),
            F.sum("n").over(Window.partitionBy()).alias("__feistel_rows"),
        )
    )
    within = Window.partitionBy("__feistel_bucket").orderBy("__feistel_mark", *identity)
    tagged = df.withColumns({"__feistel_bucket": bucket, "__feistel_mark": mark})
    return (
        tagged.withColumn("__feistel_within", F.row_number().over(within))
        .join(F.broadcast(starts), "__feistel_bucket")
        .withColumn("__feistel_row", F.col("__feistel_start") + F.col("__feistel_within") - 1)
        .drop("__feistel_bucket", "__feistel_mark", "__feistel_within", "__feistel_start")
    )


def permuted(row: Column, rows: Column, seed: int) -> Column:
    """Where row number ``row`` of ``rows`` goes; a permutation of ``0 .. rows-1``."""
    a = F.greatest(F.ceil(F.sqrt(rows.cast("double"))).cast("long"), F.lit(1))
    b = F.floor((rows + a - 1) / a).cast("long")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        _network(row, a, b, seed),
        lambda at, _: F.when(at < rows, at).otherwise(_network(at, a, b, seed)),
    )
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("a walk of the permutation is too short")))


def _network(value: Column, a: Column, b: Column, seed: int) -> Column:
    """One pass: the halves, of ``a`` and ``b`` values, are shifted by hashes of each other in turn."""

    def turn(halves: Column, i: Column) -> Column:
        left, right = halves["l"], halves["r"]
        by_right = F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), i, right), a), a)
        by_left = F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), i, left), b), b)
        return F.when(i % 2 == 0, F.struct(by_right.alias("l"), right.alias("r"))).otherwise(
            F.struct(left.alias("l"), by_left.alias("r"))
        )

    start = F.struct(F.floor(value / b).cast("long").alias("l"), F.pmod(value, b).alias("r"))
    end = lambda halves: halves["l"] * b + halves["r"]
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, end)
