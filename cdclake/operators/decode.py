"""Decode landed messages into change rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdclake.functions.images import DEFAULT_TYPES, TypeRegistry, image, layout
from cdclake.functions.positions import COMMIT_TABLE
from cdclake.operators.scan import CHUNK_BITS, Running, chunk_of, chunk_seeds
from cdclake.schema import MESSAGE

#: Message kinds that give one change row each, and the operation of that row.
OPERATIONS = {"I": "insert", "U": "update", "D": "delete", "C": "commit"}

#: Message kinds that only update what later rows are decoded with.
STATE_KINDS = ("R", "B")

#: Messages that one task decodes, about.  It sorts them twice, at one or two KB each.
TASK_MESSAGES = 50_000

_CHUNK = "__chunk"


def is_event(kind: Column) -> Column:
    """True for the kinds that give a change row."""
    return kind.isin(*OPERATIONS)


def event_lsn(kind: Column, wal_start: Column, end_lsn: Column) -> Column:
    """Position that is safe to confirm once the event is durable.

    A row has the position of its change record; a commit has the end of its
    commit record, where the next transaction may start.
    """
    return F.when(kind == "C", end_lsn).otherwise(wal_start)


def _seed_messages(kept: DataFrame, chunk_bits: int) -> DataFrame:
    """The relation and begin messages in force where each chunk starts.

    They are returned as messages placed just before the chunk, so that a scan
    of the chunk alone sees what a scan of the whole slot would see.
    """
    kind, seq = F.col("kind"), F.col("seq")
    begin_time = F.when(kind == "B", F.col("commit_time"))
    summary = kept.groupBy("slot", "session", "relation_id", _CHUNK).agg(
        F.max(F.when(kind == "R", seq)).alias("last_relation"),
        F.max_by(begin_time, F.when(begin_time.isNotNull(), seq)).alias("last_begin"),
        F.max(F.when(begin_time.isNotNull(), seq)).alias("last_begin_seq"),
    )
    chunk_start = (F.shiftleft(F.col(_CHUNK), chunk_bits) - 1).alias("seq")

    per_slot = summary.groupBy("slot", _CHUNK).agg(F.max_by("last_begin", "last_begin_seq").alias("last_begin"))
    begins = (
        chunk_seeds(per_slot, ["slot"], {"last_begin": Running("last", F.col("last_begin"))})
        .filter(F.col("last_begin").isNotNull())
        .select("slot", _CHUNK, chunk_start, F.lit("B").alias("kind"), F.col("last_begin").alias("commit_time"))
    )

    # A description joins the one chunk it is the last of, and goes on from there.
    relation = ["slot", "session", "relation_id"]
    of_relation = summary.filter(F.col("relation_id").isNotNull()).select(*relation, _CHUNK, "last_relation")
    text = F.struct("namespace", "relation_name", "columns").alias("description")
    described = kept.filter(kind == "R").select("slot", F.col("seq").alias("last_relation"), text)
    with_text = (
        of_relation.filter(F.col("last_relation").isNotNull())
        .join(described, ["slot", "last_relation"])
        .select(*relation, _CHUNK, "description")
        .unionByName(
            of_relation.filter(F.col("last_relation").isNull()).select(*relation, _CHUNK), allowMissingColumns=True
        )
    )
    relations = (
        chunk_seeds(with_text, relation, {"description": Running("last", F.col("description"))})
        .filter(F.col("description").isNotNull())
        .select(*relation, _CHUNK, chunk_start, F.lit("R").alias("kind"), "description.*")
    )
    return begins.unionByName(relations, allowMissingColumns=True)


def decode(
    messages: DataFrame,
    registry: TypeRegistry = DEFAULT_TYPES,
    carry: DataFrame | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Change rows of a set of messages.

    * a row takes the newest relation message of its id before it in its
      session, and the commit time of the newest begin message before it in its
      slot (which a reconnect does not reset);
    * a row of a relation that was never described has table ``unknown-<id>`` and
      empty images;
    * other kinds (truncate, type, origin) give no row; see
      :func:`cdclake.operators.metrics.message_counts`.

    ``carry`` holds relation and begin messages that came before ``messages``.

    The messages are shuffled once, by slot and chunk of ``seq``; both scans, the
    images run inside those partitions.  What is in force where a chunk starts is found
    from a row per chunk, itself scanned by blocks of chunks; nothing is broadcast.
    The messages are counted first: the number of partitions follows it, because one that
    is fixed, or chosen by compressed size, lets the memory of a task grow with the input.
    """
    kept = messages.select(*MESSAGE.fieldNames()).filter(F.col("kind").isin(*OPERATIONS, *STATE_KINDS))
    if carry is not None:
        kept = kept.unionByName(carry.select(*MESSAGE.fieldNames()))
    kept = kept.withColumn(_CHUNK, chunk_of(F.col("seq"), chunk_bits))
    seeded = kept.unionByName(_seed_messages(kept, chunk_bits), allowMissingColumns=True)
    tasks = -(-messages.count() // TASK_MESSAGES)
    if tasks > 1:
        seeded = seeded.repartition(tasks, "slot", _CHUNK)

    kind = F.col("kind")
    so_far = (Window.unboundedPreceding, 0)
    in_slot = Window.partitionBy("slot", _CHUNK).orderBy("seq").rowsBetween(*so_far)
    in_relation = Window.partitionBy("slot", _CHUNK, "session", "relation_id").orderBy("seq").rowsBetween(*so_far)

    def described(value: Column) -> Column:
        return F.last(F.when(kind == "R", value), ignorenulls=True).over(in_relation)

    timed = seeded.withColumn(
        "begin_time", F.last(F.when(kind == "B", F.col("commit_time")), ignorenulls=True).over(in_slot)
    )
    resolved = timed.select(
        "*",
        described(F.coalesce("relation_name", F.lit(""))).alias("table_name"),
        F.nullif(described(F.coalesce("namespace", F.lit(""))), F.lit("")).alias("table_namespace"),
        described(layout(F.col("columns"))).alias("layout"),
    ).filter(is_event(kind))

    old, new, shape = F.col("old_tuple"), F.col("new_tuple"), F.col("layout")
    operation = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])[kind]
    return resolved.select(
        F.when(kind == "C", F.lit(COMMIT_TABLE))
        .otherwise(F.coalesce("table_name", F.concat(F.lit("unknown-"), F.col("relation_id"))))
        .alias("table"),
        operation.alias("operation"),
        F.col("received_at").alias("timestamp"),
        event_lsn(kind, F.col("wal_start"), F.col("end_lsn")).alias("lsn"),
        F.when(
            kind.isin("U", "D") & F.col("old_type").isin("K", "O"),
            image(shape, old, registry, key_only=F.col("old_type") == "K"),
        ).alias("before"),
        F.when(kind.isin("I", "U"), image(shape, new, registry)).alias("after"),
        F.when(kind == "C", F.col("commit_time")).otherwise(F.col("begin_time")).alias("commit_time"),
        "slot",
        "session",
        "seq",
        "relation_id",
        F.col("table_namespace").alias("namespace"),
    )


def select_tables(changes: DataFrame, tables: Iterable[str] | None = None) -> DataFrame:
    """Changes of the published tables; all of them without a list.

    Commit markers belong to no table and are always kept.
    """
    if tables is None:
        return changes
    return changes.filter((F.col("operation") == "commit") | F.col("table").isin(*tables))
