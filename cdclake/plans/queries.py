"""The registered queries: every operator, run over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions.images import DEFAULT_TYPES
from cdclake.functions.positions import commit_date, lsn_str, lsn_value
from cdclake.operators import cuts, metrics, planning, progress, reconcile
from cdclake.operators.decode import decode, select_tables
from cdclake.operators.filters import filter_changes, not_commit
from cdclake.plans import synth
from cdclake.session import materialized, scratch_dir
from cdclake.sources import lake
from cdclake.sources.ledger import read_segments, write_segments
from cdclake.sources.messages import read_messages, stream_messages
from cdclake.streaming.stream import drain, ledger_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: A position in the middle of every data set: where transaction 60 ends.
CONFIRMED = 16777216 + 61 * 5 * 120
#: Small segments, so that many are cut at every scale.
SEGMENT_SIZE = 100
#: Segments cut by count or interval: at some scales and times the one comes first, at some the other.
JOINT_SIZE, JOINT_HOURS = 30, 2
NAMESPACE = "ns"
RERUN_UNTIL = "2024-01-12"
#: Events that are finished in the ledgers that a session resumes from: within the first replay.
FINISHED = 700


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


_LANDINGS: dict[tuple[str, str, str], str] = {}

#: How messages are landed: texts of cells hardly repeat, so a dictionary of them is built in vain.
LANDING_OPTIONS = {
    "parquet.enable.dictionary": "false",
    **{
        f"parquet.enable.dictionary#{column}": "true"
        for column in ("slot", "kind", "old_type", "old_tuple.list.element.kind", "new_tuple.list.element.kind")
    },
}


def landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Messages derived from a driver table, landed as Parquet once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDINGS:
        path = scratch_dir(spark, f"landing-{name}")
        build().write.options(**LANDING_OPTIONS).parquet(path)
        _LANDINGS[key] = path
    return read_messages(spark, _LANDINGS[key])


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "events", lambda: synth.event_messages(spark, sf_dir))


def changes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(event_messages(spark, sf_dir))


def rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_changes(changes_of(spark, sf_dir), not_commit())


def day_text(day: Column) -> Column:
    return day.cast("string")


def micros(name: str, alias: str | None = None) -> Column:
    return F.unix_micros(name).alias(alias or f"{name}_us")


# ------------------------------------------------------------------- decode


@query
def event_counts(spark, sf_dir):
    counts = metrics.event_counts(rows_of(spark, sf_dir))
    return counts.withColumn("commit_date", day_text(F.col("commit_date")))


@query
def relation_asof(spark, sf_dir):
    seen = F.coalesce("after", "before").contains('"extra":').alias("extra_seen")
    return rows_of(spark, sf_dir).select("session", "seq", "relation_id", "table", "namespace", seen)


@query
def unknown_relation(spark, sf_dir):
    rows = rows_of(spark, sf_dir).filter(F.col("table").startswith("unknown-"))
    return rows.select("seq", "table", "operation", "before", "after")


@query
def commit_time_fill(spark, sf_dir):
    return changes_of(spark, sf_dir).select("seq", "operation", micros("commit_time"))


def _images(spark, sf_dir, operation):
    rows = changes_of(spark, sf_dir).filter(F.col("operation") == operation)
    return rows.select("seq", "table", "lsn", "before", "after")


@query
def insert_images(spark, sf_dir):
    return _images(spark, sf_dir, "insert")


@query
def update_images(spark, sf_dir):
    return _images(spark, sf_dir, "update")


@query
def delete_images(spark, sf_dir):
    return _images(spark, sf_dir, "delete")


@query
def commit_markers(spark, sf_dir):
    rows = changes_of(spark, sf_dir).filter(F.col("operation") == "commit")
    return rows.select("seq", "table", "lsn", "before", "after", micros("commit_time"), micros("timestamp"))


@query
def key_only_images(spark, sf_dir):
    keyed = event_messages(spark, sf_dir).filter((F.col("old_type") == "K") | F.col("kind").isin("R", "B"))
    return decode(keyed).select("seq", "before")


@query
def cell_types(spark, sf_dir):
    bulk = landed(spark, sf_dir, "lineitem", lambda: synth.lineitem_messages(spark, sf_dir))
    return filter_changes(decode(bulk), not_commit()).select("seq", "after")


@query
def type_registry(spark, sf_dir):
    # jsonb text is JSON already; embed it instead of quoting it.
    registry = DEFAULT_TYPES.with_handler(3802, lambda text: text)
    rows = filter_changes(decode(event_messages(spark, sf_dir), registry), not_commit())
    return rows.select("seq", "operation", "before", "after")


@query
def table_selection(spark, sf_dir):
    chosen = select_tables(changes_of(spark, sf_dir), ["table_01", "table_03"])
    return chosen.groupBy("table", "operation").agg(F.count(F.lit(1)).alias("events"))


@query
def message_counts(spark, sf_dir):
    return metrics.message_counts(event_messages(spark, sf_dir))


# ---------------------------------------------------- dates, positions, filters


@query
def utc_commit_day(spark, sf_dir):
    day = commit_date(F.col("commit_time"), F.col("timestamp"))
    return changes_of(spark, sf_dir).select("seq", day_text(day).alias("commit_date"))


@query
def lsn_text(spark, sf_dir):
    position = F.col("lsn") * 4099
    return changes_of(spark, sf_dir).select("seq", position.alias("position"), lsn_str(position).alias("text"))


@query
def lsn_number(spark, sf_dir):
    text = F.concat(F.hex("o_custkey"), F.lit("/"), F.hex("o_orderkey"))
    orders = synth.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", text.alias("text"), lsn_value(text).alias("position"))


@query
def filter_chain(spark, sf_dir):
    kept = filter_changes(
        changes_of(spark, sf_dir), not_commit(), F.col("table") != "table_05", F.col("lsn") > CONFIRMED
    )
    return kept.select("seq", "table", "operation", "lsn")


# --------------------------------------------------------------------- lake


def written_lake(spark: SparkSession, sf_dir: str) -> str:
    """A lake of the events' row changes; returns its root."""
    root = scratch_dir(spark, "lake")
    lake.write_changes(rows_of(spark, sf_dir), root, NAMESPACE, load=1)
    return root


def stored(rows: DataFrame) -> DataFrame:
    return rows.select(
        "table",
        "operation",
        micros("timestamp"),
        "lsn",
        "before",
        "after",
        micros("commit_time"),
        "session",
        "seq",
        day_text(F.col("commit_date")).alias("commit_date"),
    )


@query
def lake_roundtrip(spark, sf_dir):
    return stored(lake.read_changes(spark, written_lake(spark, sf_dir), NAMESPACE))


@query
def day_pruned_read(spark, sf_dir):
    root = written_lake(spark, sf_dir)
    return stored(lake.read_changes(spark, root, NAMESPACE, "2024-01-05", "2024-01-09"))


@query
def dated_export(spark, sf_dir):
    root = written_lake(spark, sf_dir)
    target = scratch_dir(spark, "dated")
    lake.export_dated(spark, root, target, NAMESPACE)
    days = lake.read_changes(spark, root, NAMESPACE).agg(F.min("commit_date"), F.max("commit_date")).first()
    rows = lake.read_dated(spark, target, NAMESPACE, *days)
    return rows.select(
        "table", "operation", micros("timestamp"), "lsn", "before", "after",
        day_text(F.col("commit_date")).alias("commit_date"),
    )


@query
def batch_then_stream(spark, sf_dir):
    # The first session is loaded as a batch, and a stream goes on from there.
    work = scratch_dir(spark, "batch-then-stream")
    messages = event_messages(spark, sf_dir)
    early = filter_changes(decode(messages.filter("session = 0")), not_commit())
    lake.write_changes(early, f"{work}/lake", NAMESPACE, load=1)
    messages.filter("session > 0").write.options(**LANDING_OPTIONS).parquet(f"{work}/landing")
    drain(stream_messages(spark, f"{work}/landing"), f"{work}/lake", f"{work}/checkpoint", NAMESPACE)
    return stored(lake.read_changes(spark, f"{work}/lake", NAMESPACE))


@query
def rerun_batch(spark, sf_dir):
    # A load is written again after its changes shrank to the first days.
    root = written_lake(spark, sf_dir)
    fewer = rows_of(spark, sf_dir).filter(commit_date(F.col("commit_time"), F.col("timestamp")) <= F.lit(RERUN_UNTIL).cast("date"))
    lake.write_changes(fewer, root, NAMESPACE, load=1, replace=True)
    return stored(lake.read_changes(spark, root, NAMESPACE))


@query
def compacted_days(spark, sf_dir):
    # Two loads, of which the second holds part of the first again, are made one.  What both are
    # taken from is stored, so that it is decoded once.
    root = scratch_dir(spark, "compacted")
    rows = materialized(rows_of(spark, sf_dir), "decoded")
    lake.write_changes(rows.filter("seq % 3 < 2"), root, NAMESPACE, load=1)
    lake.write_changes(rows.filter("seq % 3 > 0"), root, NAMESPACE, load=2)
    days = lake.read_changes(spark, root, NAMESPACE).agg(F.min("commit_date"), F.max("commit_date")).first()
    lake.compact_days(spark, root, NAMESPACE, *days, load=3)
    back = lake.read_changes(spark, root, NAMESPACE)
    return stored(back.filter("batch_id = -3")).unionByName(stored(back.filter("batch_id <> -3")))


@query
def empty_batch(spark, sf_dir):
    # Nothing passes the filters: no row is stored, and the position advances over all.
    work = scratch_dir(spark, "empty-batch")
    event_messages(spark, sf_dir).write.options(**LANDING_OPTIONS).parquet(f"{work}/landing")
    drain(stream_messages(spark, f"{work}/landing"), f"{work}/lake", f"{work}/checkpoint", NAMESPACE, predicates=[F.lit(False)])
    files = lake.stored_files(spark, f"{work}/lake", NAMESPACE)
    prefix = progress.contiguous_prefix(read_segments(spark, ledger_path(f"{work}/lake", NAMESPACE)))
    return prefix.withColumn("files", F.lit(files).cast("bigint"))


@query
def order_breaks(spark, sf_dir):
    # A writer that keeps each 50th row back by 200 positions.  A day is one file, sorted by one
    # task, so it has only the columns that order its rows.
    path = scratch_dir(spark, "disordered")
    late = F.col("seq") + F.when(F.col("seq") % 50 == 0, 200 * 32).otherwise(0)
    rows = lake.to_lake_rows(rows_of(spark, sf_dir)).select(*lake.FILE_ORDER, "commit_date", late.alias("written"))
    rows.repartition("commit_date").sortWithinPartitions("commit_date", "written").write.partitionBy("commit_date").parquet(path)
    found = reconcile.order_breaks(spark.read.parquet(path))
    return found.select("seq", "lsn", micros("timestamp"))


@query
def file_stats(spark, sf_dir):
    # Sizes and the number of files depend on the cluster, so they are only tested.
    stats = metrics.file_stats(lake.read_changes(spark, written_lake(spark, sf_dir), NAMESPACE))
    return stats.groupBy(day_text(F.col("commit_date")).alias("commit_date")).agg(
        F.sum("rows").alias("rows"),
        F.sum("image_chars").alias("image_chars"),
        F.bool_and((F.col("bytes") > 0) & (F.col("bytes_per_row") > 0)).alias("sized"),
    )


# ----------------------------------------------------------------- planning


def plain_segments(segments: DataFrame) -> DataFrame:
    return segments.select("slot", "start_idx", "end_idx", "done", "last_lsn", micros("cut_at"))


@query
def segments_by_count(spark, sf_dir):
    return plain_segments(planning.segments_by_count(changes_of(spark, sf_dir), SEGMENT_SIZE))


@query
def segments_by_interval(spark, sf_dir):
    return plain_segments(planning.segments_by_interval(changes_of(spark, sf_dir), "1 hour"))


@query
def segments_joint(spark, sf_dir):
    changes = decode(two_slots(event_messages(spark, sf_dir)))
    segments = cuts.segments_joint(changes, JOINT_SIZE, f"{JOINT_HOURS} hours")
    return segments.select("slot", "start_idx", "end_idx", "done", "last_lsn", micros("cut_at"), "cut_by")


@query
def day_runs(spark, sf_dir):
    runs = planning.day_runs(changes_of(spark, sf_dir), SEGMENT_SIZE)
    return runs.select("seq", "idx", "segment", "run", day_text(F.col("commit_date")).alias("commit_date"))


def two_slots(messages: DataFrame) -> DataFrame:
    """The messages as those of two slots, which agree in all but the name."""
    return messages.unionByName(messages.withColumn("slot", F.lit("twin")))


def _manifest(spark, sf_dir):
    changes = decode(two_slots(event_messages(spark, sf_dir)))
    return planning.file_manifest(changes, NAMESPACE, SEGMENT_SIZE, not_commit())


@query
def file_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir).select(
        "slot", "segment", "run", day_text(F.col("commit_date")).alias("commit_date"), "start_idx", "events", "rows",
        "first_lsn", "last_lsn", micros("last_decoded"), "sequence", "key",
    )


# ----------------------------------------------------------------- progress


@query
def contiguous_prefix(spark, sf_dir):
    return progress.contiguous_prefix(synth.segment_ledger(spark, sf_dir))


@query
def folded_prefix(spark, sf_dir):
    ledger = scratch_dir(spark, "folded-ledger")
    segments = synth.segment_ledger(spark, sf_dir)
    late = F.col("start_idx") >= 1000
    write_segments(segments.filter(~late), ledger, 0)
    progress.fold_ledger(spark, ledger)
    write_segments(segments.filter(late), ledger, 1)
    progress.fold_ledger(spark, ledger)
    return progress.contiguous_prefix(read_segments(spark, ledger))


@query
def acked_position(spark, sf_dir):
    return progress.acked_position(synth.segment_ledger(spark, sf_dir).filter("done"), "last_lsn")


@query
def acked_history(spark, sf_dir):
    history = progress.acked_history(synth.segment_ledger(spark, sf_dir).filter("done"), "last_lsn")
    return history.select("slot", "end_idx", "last_lsn", "confirmed_lsn")


@query
def safe_restart(spark, sf_dir):
    replay = progress.safe_restart(event_messages(spark, sf_dir), CONFIRMED)
    return replay.filter(F.col("kind") != "R").select("session", "seq", "kind")


@query
def resume(spark, sf_dir):
    # One slot is finished into a replay, whose positions lie below earlier ones; the
    # other's first segment is not, but it has confirmed a position before.
    ledger = scratch_dir(spark, "ledger")
    messages = two_slots(event_messages(spark, sf_dir))
    segments = planning.segments_by_count(decode(messages), SEGMENT_SIZE)
    done = (F.col("slot") == "main") & (F.col("end_idx") <= FINISHED)
    write_segments(segments.withColumn("done", done), ledger, 0)
    before = spark.createDataFrame([("twin", CONFIRMED)], "slot string, acked_lsn bigint")
    replay = progress.resume(spark, messages, ledger, before)
    return replay.filter(F.col("kind") != "R").select("slot", "session", "seq", "kind")


@query
def backlog(spark, sf_dir):
    return progress.backlog(synth.progress_ledger(spark, sf_dir))


@query
def stream_health(spark, sf_dir):
    now = F.lit("2024-01-31 00:00:00Z").cast("timestamp")
    health = progress.stream_health(synth.progress_ledger(spark, sf_dir), now)
    return health.select("slot", micros("at"), "status", "ready")


@query
def position_regressions(spark, sf_dir):
    found = progress.position_regressions(synth.progress_ledger(spark, sf_dir))
    return found.select("slot", micros("at"), "acked_lsn", "previous_lsn")


# ----------------------------------------------------------- reconciliation

KEY_FIELDS = {"id": T.LongType(), "event_type": T.StringType(), "value": T.DecimalType(38, 2)}


@query
def missing_changes(spark, sf_dir):
    # The lake lost every change of each 101st id.  It is stored: filters on images that are still to be
    # made would make them anew for each condition.
    lossy = reconcile.row_identity(materialized(rows_of(spark, sf_dir), "decoded")).filter(F.coalesce(F.col("id") % 101 != 0, F.lit(True)))
    # Of each 103rd inserted or updated id, the value expected is null and the one stored does not fit.
    overflowing = lossy.withColumn(
        "after", F.when(F.col("id") % 103 == 0, F.regexp_replace("after", r'"value":[0-9.]+', '"value":' + "7" * 40)).otherwise(F.col("after"))
    )
    expected = synth.committed_changes(spark, sf_dir).withColumn("value", F.when(F.col("id") % 103 != 0, F.col("value")))
    found = reconcile.missing_changes(expected, overflowing.drop("id"), KEY_FIELDS)
    return found.withColumn("value", F.col("value").cast("string"))


@query
def rolled_back_leaks(spark, sf_dir):
    leak = landed(spark, sf_dir, "leak", lambda: synth.event_messages(spark, sf_dir, leak=True))
    leaky = filter_changes(decode(leak), not_commit())
    found = reconcile.rolled_back_leaks(leaky, synth.rolled_back_ids(spark, sf_dir))
    return found.select("seq", "id", "operation")


@query
def misplaced_rows(spark, sf_dir):
    # Each 37th position is filed a day late.
    rows = lake.to_lake_rows(rows_of(spark, sf_dir))
    wrong = F.when(F.col("seq") % 37 == 0, F.date_add("commit_date", 1)).otherwise(F.col("commit_date"))
    found = reconcile.misplaced_rows(rows.withColumn("commit_date", wrong))
    return found.select(
        "seq",
        day_text(F.col("commit_date")).alias("commit_date"),
        day_text(F.col("expected_date")).alias("expected_date"),
    )


@query
def mixed_day_files(spark, sf_dir):
    # A writer that cuts files by position only.
    file = F.concat(F.lit("f"), F.floor(F.col("seq") / 2048))
    found = reconcile.mixed_day_files(rows_of(spark, sf_dir), file)
    return found.select(
        "file",
        day_text(F.col("first_day")).alias("first_day"),
        day_text(F.col("last_day")).alias("last_day"),
        "rows",
    )


@query
def duplicate_keys(spark, sf_dir):
    # A writer whose sequence restarts every five files and that leaves out the time.
    key = F.regexp_replace("key", r"\d+-\d+\.", F.concat((F.col("sequence") % 5).cast("string"), F.lit(".")))
    return reconcile.duplicate_keys(_manifest(spark, sf_dir).withColumn("key", key))


@query
def conservation(spark, sf_dir):
    # A lake that lost each 41st position and stored each 43rd twice.
    changes = changes_of(spark, sf_dir)
    kept = changes.filter(F.col("seq") % 41 != 0)
    return reconcile.conservation(changes, kept.unionByName(kept.filter(F.col("seq") % 43 == 0)))


@query
def expand_image(spark, sf_dir):
    fields = {
        "id": T.LongType(),
        "user_id": T.IntegerType(),
        "event_type": T.StringType(),
        "value": T.DecimalType(38, 2),
        "is_error": T.BooleanType(),
        "created_on": T.StringType(),
        "note": T.StringType(),
    }
    rows = rows_of(spark, sf_dir).filter(F.col("after").isNotNull())
    typed = reconcile.expand_image(F.col("after"), fields)
    # Before the image's own members stands embedded JSON with members of the same names,
    # a number of 40 digits, and a name with a quote in it.
    harder = F.concat(F.lit('{"props":{"value":1,"id":2},"long":1234567890123456789012345678901234567890,"q\\"t":'), F.col("seq"), F.lit(","), F.expr("substring(after, 2)"))
    harder = F.when(F.col("after") == "{}", "{}").otherwise(harder)
    exact = reconcile.expand_image(harder, dict.fromkeys(("value", "long", 'q"t'), reconcile.EXACT))
    return rows.select(
        "seq",
        *[c.alias(n) for n, c in typed.items()],
        exact["value"].alias("digits"),
        exact["long"].alias("long_digits"),
        exact['q"t'].alias("quoted_name"),
    ).withColumn("value", F.col("value").cast("string"))


@query
def row_identity(spark, sf_dir):
    return reconcile.row_identity(rows_of(spark, sf_dir)).select("seq", "operation", "id")


@query
def dedup_replays(spark, sf_dir):
    changes = decode(two_slots(event_messages(spark, sf_dir)))
    return reconcile.dedup_replays(changes).select("slot", "session", "seq", "lsn", "operation")


# ------------------------------------------------------------------ metrics


@query
def lsn_ranges(spark, sf_dir):
    ranges = metrics.lsn_ranges(changes_of(spark, sf_dir))
    return ranges.withColumn("commit_date", day_text(F.col("commit_date")))


@query
def image_widths(spark, sf_dir):
    return metrics.image_widths(rows_of(spark, sf_dir))


# ---------------------------------------------------------------- streaming

#: Positions at which the streamed landing is cut; the stream restarts at each.
CUTS = (1000, 3000)


#: Cuts inside a bulk load, inside the first transaction that is replayed, and inside a replayed bulk load.
REPLAY_CUTS = (1393, 3857, 3953)


def streamed_lake(spark: SparkSession, sf_dir: str, cuts: tuple[int, ...] = CUTS, **options) -> str:
    """A lake filled by a stream that is stopped and resumed; returns its root."""
    work = scratch_dir(spark, "stream")
    landing, root, checkpoint = f"{work}/landing", f"{work}/lake", f"{work}/checkpoint"
    messages = event_messages(spark, sf_dir)
    bounds = (-1, *cuts, None)
    for low, high in zip(bounds, bounds[1:]):
        part = messages.filter(F.col("seq") > low)
        if high is not None:
            part = part.filter(F.col("seq") <= high)
        part.write.mode("append").options(**LANDING_OPTIONS).parquet(landing)
        drain(stream_messages(spark, landing), root, checkpoint, NAMESPACE, **options)
    return root


@query
def stream_parity(spark, sf_dir):
    return stored(lake.read_changes(spark, streamed_lake(spark, sf_dir), NAMESPACE))


@query
def stream_dedup(spark, sf_dir):
    root = streamed_lake(spark, sf_dir, REPLAY_CUTS, dedup=True, predicates=())
    return lake.read_changes(spark, root, NAMESPACE).select("slot", "session", "seq", "lsn", "operation")


@query
def record_progress(spark, sf_dir):
    ledger = ledger_path(streamed_lake(spark, sf_dir), NAMESPACE)
    return read_segments(spark, ledger).select("batch_id", "slot", "start_idx", "end_idx", "done", "last_lsn")


@query
def landed_messages(spark, sf_dir):
    return event_messages(spark, sf_dir).select("session", "seq", "kind", "relation_id", "old_type", "end_lsn")
