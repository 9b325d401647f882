"""Keep the lake up to date from a stream of landed messages.

Each micro-batch is decoded and written like a batch, with three things kept
between batches, one folder per batch so that a repeated batch reads the same:

* the *carry*: the relation messages of the live session, the last begin message
  and the counters of each slot, from which the next batch goes on;
* with ``dedup``, a row per session that says which changes have come, and the
  changes of which that is not known yet (:mod:`cdclake.operators.replays`);
* the segment and progress ledgers, recorded once the batch is durable;
* Spark's own checkpoint, which decides what the next batch is.

A batch that fails anywhere is run again by Spark under the same id and replaces
whatever it had written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cdclake.functions.images import DEFAULT_TYPES, TypeRegistry
from cdclake.operators.decode import decode, event_lsn, is_event
from cdclake.operators.filters import filter_changes, not_commit
from cdclake.operators.replays import SESSIONS, remove_replays
from cdclake.operators.scan import CHUNK_BITS
from cdclake.schema import CHANGE, MESSAGE, PROGRESS
from cdclake.session import passing_scratch
from cdclake.sources.files import delete, exists
from cdclake.sources.lake import DEFAULT_NAMESPACE, MAX_RECORDS_PER_FILE, has_stream_batches, write_batch
from cdclake.sources.ledger import read_progress, write_progress, write_segments

FLUSH_INTERVAL = "30 seconds"

#: Carry rows are messages; a row of kind ``S`` holds a slot's counters after the
#: batch: the highest ``seq`` and ``session``, the confirmed position
#: (``wal_start``), when the newest event came (``received_at``), and below.
CARRY = T.StructType(
    [
        *MESSAGE.fields,
        T.StructField("first_seq", T.LongType()),  # of the batch
        T.StructField("old_seq", T.LongType()),  # highest before the batch
        T.StructField("start_idx", T.LongType()),  # events before the batch
        T.StructField("end_idx", T.LongType()),  # events after the batch
        T.StructField("last_lsn", T.LongType()),  # of the batch
        T.StructField("old_acked", T.LongType()),  # confirmed before the batch
    ]
)

Sink = Callable[[DataFrame, int], None]


def ledger_path(root: str, namespace: str = DEFAULT_NAMESPACE) -> str:
    """Where the ledgers of a lake are kept."""
    return f"{root}/_ledgers/{namespace}"


def _counters(batch: DataFrame, carry: DataFrame) -> DataFrame:
    """The ``S`` rows after the batch, from those before it."""
    event = is_event(F.col("kind"))
    lsn = event_lsn(F.col("kind"), F.col("wal_start"), F.col("end_lsn"))
    now = batch.groupBy("slot").agg(
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("new_seq"),
        F.max("session").alias("new_session"),
        F.count_if(event).alias("n"),
        F.max_by(lsn, F.when(event, F.col("seq"))).alias("last_lsn"),
        F.max("received_at").alias("received_at"),
    )
    before = carry.filter("kind = 'S'").select(
        "slot",
        F.col("seq").alias("old_seq"),
        F.col("session").alias("old_session"),
        F.col("wal_start").alias("old_acked"),
        F.col("end_idx").alias("old_events"),
    )
    start = F.coalesce("old_events", F.lit(0).cast("bigint"))
    return now.join(before, "slot", "full_outer").select(
        "slot",
        F.lit("S").alias("kind"),
        F.greatest("new_seq", "old_seq").alias("seq"),
        F.greatest("new_session", "old_session").alias("session"),
        F.greatest("last_lsn", "old_acked").alias("wal_start"),
        "received_at",
        "first_seq",
        "old_seq",
        start.alias("start_idx"),
        (start + F.coalesce("n", F.lit(0))).alias("end_idx"),
        "last_lsn",
        "old_acked",
    )


def _next_carry(batch: DataFrame, carry: DataFrame) -> DataFrame:
    """What the next batch goes on from: counters, last begins, live relations."""
    keep = [c for c in MESSAGE.fieldNames() if c not in ("old_tuple", "new_tuple")]
    known = batch.select(*keep).unionByName(carry.select(*keep))
    counters = _counters(batch, carry)

    def newest(rows: DataFrame, *keys: str) -> DataFrame:
        per_key = rows.groupBy(*[F.col(k).alias(f"__{k}") for k in keys])
        return per_key.agg(F.max_by(F.struct(*keep), "seq").alias("m")).select("m.*")

    begins = newest(known.filter("kind = 'B' AND commit_time IS NOT NULL"), "slot")
    relations = newest(known.filter("kind = 'R'"), "slot", "session", "relation_id")
    live = relations.join(counters.select("slot", "session"), ["slot", "session"], "left_semi")
    rows = counters.unionByName(begins, allowMissingColumns=True).unionByName(live, allowMissingColumns=True)
    return rows.select(
        *[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in CARRY.fields]
    )


def _without_replays(changes: DataFrame, folder: str, batch_id: int, chunk_bits: int) -> DataFrame:
    """The new changes of a batch; what is remembered of the sessions after it is written beside that of the batch before."""
    spark = changes.sparkSession

    def before(name: str, schema: T.StructType) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{folder}/batch={batch_id - 1}/{name}")

    kept, sessions, held = remove_replays(changes, before("sessions", SESSIONS), before("held", CHANGE), chunk_bits)
    for name, rows in (("sessions", sessions), ("held", held)):
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}/{name}")
    return kept


def stream_changes(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    namespace: str = DEFAULT_NAMESPACE,
    flush_interval: str | None = FLUSH_INTERVAL,
    predicates: Sequence[Column] | None = None,
    registry: TypeRegistry = DEFAULT_TYPES,
    sink: Sink | None = None,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    chunk_bits: int = CHUNK_BITS,
    dedup: bool = False,
) -> StreamingQuery:
    """Start writing a stream of messages to the lake, one batch per interval.

    Without ``flush_interval`` the query takes in all that has landed and stops
    (a drain).  ``predicates`` decide what is stored (commit markers are dropped
    by default); positions advance over everything, also when nothing is stored.
    ``sink`` replaces the lake write.  With ``dedup`` a reconnect's replays are not
    stored; it must be set, or not, for the whole life of a checkpoint.  Changes whose
    transaction may have been stored before wait in the checkpoint until its commit comes.

    Messages must arrive in ``seq`` order per slot; a batch that starts at or
    below the last ``seq`` of the batches before is an error.
    """
    spark = messages.sparkSession
    carries, replays = f"{checkpoint}/carry", f"{checkpoint}/replays"
    ledger = ledger_path(root, namespace)
    chosen = (not_commit(),) if predicates is None else tuple(predicates)

    def to_lake(changes: DataFrame, batch_id: int) -> None:
        write_batch(changes, root, namespace, batch_id, max_records_per_file)

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id > 0:
            carry = session.read.schema(CARRY).parquet(f"{carries}/batch={batch_id - 1}")
        else:
            _refuse_foreign_lake(session, root, namespace, f"{carries}/batch=0")
            carry = session.createDataFrame([], CARRY)
        # Written first and read back, so that the counters are computed once.
        _next_carry(batch, carry).write.mode("overwrite").parquet(f"{carries}/batch={batch_id}")
        counters = session.read.schema(CARRY).parquet(f"{carries}/batch={batch_id}").filter("kind = 'S'")
        late = counters.filter(F.col("first_seq") <= F.col("old_seq")).head(1)
        if late:
            raise ValueError(
                f"slot {late[0].slot!r}: messages from seq {late[0].first_seq} on, "
                f"but seq {late[0].old_seq} was already taken in"
            )

        def sample(at: Column, read_idx: str, blocked_since: Column) -> DataFrame:
            return counters.select(
                "slot",
                at.alias("at"),
                F.lit(True).alias("streaming"),
                blocked_since.cast("timestamp").alias("blocked_since"),
                F.col("end_idx").alias("write_idx"),
                F.col(read_idx).alias("read_idx"),
                (F.col("wal_start") if read_idx == "end_idx" else F.col("old_acked")).alias("acked_lsn"),
            )

        # What has arrived waits from here on; if the batch fails, this is what stays recorded.
        began = F.lit(dt.datetime.now(dt.timezone.utc))
        waiting = sample(began, "start_idx", began)
        write_progress(waiting, ledger, batch_id)

        known = carry.filter("kind IN ('R', 'B')")
        with passing_scratch(session):
            changes = decode(batch, registry, known, chunk_bits)
            if dedup:
                _require_replays(session, replays, batch_id)
                changes = _without_replays(changes, replays, batch_id, chunk_bits)
            (sink or to_lake)(filter_changes(changes, *chosen), batch_id)

        recorded = F.lit(dt.datetime.now(dt.timezone.utc))
        segments = counters.filter(F.col("end_idx") > F.col("start_idx")).select(
            "slot",
            "start_idx",
            "end_idx",
            F.lit(True).alias("done"),
            "last_lsn",
            F.col("received_at").alias("cut_at"),
            recorded.alias("done_at"),
        )
        write_segments(segments, ledger, batch_id)
        write_progress(waiting.unionByName(sample(recorded, "end_idx", F.lit(None))), ledger, batch_id)
        # This batch starts from the carry before it; older ones are never read again.
        delete(session, f"{carries}/batch={batch_id - 2}")
        if dedup:
            delete(session, f"{replays}/batch={batch_id - 2}")

    writer = messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if flush_interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=flush_interval).start()


def drain(messages: DataFrame, root: str, checkpoint: str, namespace: str = DEFAULT_NAMESPACE, **options) -> None:
    """Take in everything that has landed, make it durable, and stop."""
    stream_changes(messages, root, checkpoint, namespace, flush_interval=None, **options).awaitTermination()


def _refuse_foreign_lake(spark: SparkSession, root: str, namespace: str, own_carry: str) -> None:
    """A first batch must not replace the batches of another checkpoint.

    The carry is written before anything else, so a first batch that is run again
    has one; a lake or a ledger with stream batches and without it was filled from
    elsewhere.  Batch loads do not matter: they are numbered apart.
    """
    filled = has_stream_batches(spark, root, namespace) or exists(spark, f"{ledger_path(root, namespace)}/segments")
    if filled and not exists(spark, own_carry):
        raise ValueError(f"{root}/{namespace} has batches of a stream already; go on with the checkpoint they were written with")


def _require_replays(spark: SparkSession, folder: str, batch_id: int) -> None:
    if batch_id > 0 and not exists(spark, f"{folder}/batch={batch_id - 1}/held"):
        raise ValueError("the batches before were stored with their replays; remove these on reading, or start a new checkpoint")


def query_progress(query: StreamingQuery, spark: SparkSession, ledger: str) -> DataFrame:
    """Newest recorded progress per slot, with the live state of ``query``.

    Delivery counts as blocked while a trigger runs, since the trigger before
    ended; :func:`cdclake.operators.progress.stream_health` judges how long.
    """
    blocked_since = None
    last = query.lastProgress
    if query.isActive and last is not None and query.status["isTriggerActive"]:
        began = dt.datetime.fromisoformat(last["timestamp"].replace("Z", "+00:00"))
        blocked_since = began + dt.timedelta(milliseconds=last["durationMs"].get("triggerExecution", 0))
    newest = read_progress(spark, ledger).groupBy("slot").agg(
        *[F.max_by(c, "at").alias(c) for c in ("write_idx", "read_idx", "acked_lsn")]
    )
    return newest.select(
        "slot",
        F.current_timestamp().alias("at"),
        F.lit(query.isActive).alias("streaming"),
        F.lit(blocked_since).cast("timestamp").alias("blocked_since"),
        "write_idx",
        "read_idx",
        "acked_lsn",
    ).select(*PROGRESS.fieldNames())
