import pytest
from pyspark.sql import functions as F

from cdclake.operators import progress, reconcile
from cdclake.operators.decode import decode
from cdclake.operators.filters import filter_changes, not_commit
from cdclake.sources import lake
from cdclake.sources.ledger import read_progress, read_segments
from cdclake.sources.messages import stream_messages
from cdclake.streaming.stream import CARRY, drain, ledger_path, query_progress, stream_changes
from tests import history
from tests.test_lake import rows_of

SEQ = history.FIELDS.index("seq")


class Work:
    def __init__(self, spark, path):
        self.spark = spark
        self.landing, self.root, self.checkpoint = (f"{path}/{x}" for x in ("landing", "lake", "checkpoint"))

    def land(self, messages):
        history.frame(self.spark, messages).write.mode("append").parquet(self.landing)

    def drain(self, **options):
        drain(stream_messages(self.spark, self.landing), self.root, self.checkpoint, "ns", chunk_bits=4, **options)

    def lake(self):
        return lake.read_changes(self.spark, self.root, "ns")

    def segments(self):
        rows = read_segments(self.spark, ledger_path(self.root, "ns")).orderBy("slot", "start_idx").collect()
        return [(r.slot, r.start_idx, r.end_idx, r.last_lsn) for r in rows]


@pytest.fixture
def work(spark, tmp_path):
    return Work(spark, tmp_path)


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_batch(spark, work, seed):
    messages = history.random_history(seed, slots=2, txns=25)
    order = sorted(messages, key=lambda m: m[SEQ])
    third = len(order) // 3
    for part in (order[:third], order[third : 2 * third], order[2 * third :]):
        work.land(part)
        work.drain()
    expected = filter_changes(decode(history.frame(spark, order)), not_commit())
    stored = expected.withColumn("commit_time", F.coalesce("commit_time", F.timestamp_micros(F.lit(-62135596800000000))))
    assert rows_of(work.lake()) == rows_of(stored)

    # The ledger covers every event, commits included, without a gap.
    events = decode(history.frame(spark, order)).groupBy("slot").count().collect()
    prefix = progress.contiguous_prefix(read_segments(spark, ledger_path(work.root, "ns"))).collect()
    assert {r.slot: r.read_idx for r in prefix} == {r.slot: r["count"] for r in events}
    assert reconcile.misplaced_rows(work.lake()).count() == 0
    assert progress.position_regressions(read_progress(spark, ledger_path(work.root, "ns"))).count() == 0


def test_messages_out_of_order_are_refused(work):
    messages = sorted(history.random_history(4, txns=6), key=lambda m: m[SEQ])
    work.land(messages[5:])
    work.drain()
    work.land(messages[:5])
    with pytest.raises(Exception, match="was already taken in"):
        work.drain()


def test_failed_batch_is_run_again_without_duplicates(spark, work):
    messages = sorted(history.random_history(6, txns=12), key=lambda m: m[SEQ])
    work.land(messages[:30])
    work.drain()
    work.land(messages[30:])

    def fail_after_writing(changes, batch_id):
        lake.write_batch(changes, work.root, "ns", batch_id)
        raise RuntimeError("store is down")

    with pytest.raises(Exception, match="store is down"):
        work.drain(sink=fail_after_writing)
    assert len(work.segments()) == 1
    work.drain()
    expected = filter_changes(decode(history.frame(spark, messages)), not_commit())
    assert reconcile.conservation(expected, work.lake()).count() == 0
    assert len(work.segments()) == 2


def test_position_advances_when_nothing_is_stored(spark, work):
    messages = history.random_history(7, txns=4)
    work.land(messages)
    work.drain(predicates=[F.lit(False)])
    (r,) = progress.contiguous_prefix(read_segments(spark, ledger_path(work.root, "ns"))).collect()
    assert r.read_idx == decode(history.frame(spark, messages)).count()
    assert r.acked_lsn is not None


def test_another_checkpoint_cannot_replace_the_lake(work, tmp_path):
    messages = sorted(history.random_history(8, txns=8), key=lambda m: m[SEQ])
    work.land(messages)
    work.drain()
    work.checkpoint = str(tmp_path / "fresh")
    with pytest.raises(Exception, match="has batches of a stream already"):
        work.drain()


def test_a_stream_goes_on_after_a_batch_load(spark, work):
    early, late = history.random_history(21, txns=8), history.random_history(22, txns=8)
    loaded = filter_changes(decode(history.frame(spark, early)), not_commit())
    lake.write_changes(loaded, work.root, "ns", load=1)
    work.land(late)
    work.drain()
    streamed = filter_changes(decode(history.frame(spark, late)), not_commit())
    assert reconcile.conservation(streamed, work.lake().filter("batch_id >= 0")).count() == 0
    assert reconcile.conservation(loaded, work.lake().filter("batch_id < 0")).count() == 0
    # and a load may follow the stream
    lake.write_changes(loaded, work.root, "ns", load=2)
    assert work.lake().count() == streamed.count() + 2 * loaded.count()


def test_lake_without_a_ledger_is_refused_too(spark, work, tmp_path):
    messages = history.random_history(23, txns=4)
    lake.write_batch(filter_changes(decode(history.frame(spark, messages)), not_commit()), work.root, "ns", 0)
    work.land(messages)
    with pytest.raises(Exception, match="has batches of a stream already"):
        work.drain()


def test_progress_shows_what_waits(spark, work):
    messages = sorted(history.random_history(24, txns=12), key=lambda m: m[SEQ])
    work.land(messages)

    def fail(changes, batch_id):
        raise RuntimeError("store is down")

    with pytest.raises(Exception, match="store is down"):
        work.drain(sink=fail)
    samples = read_progress(spark, ledger_path(work.root, "ns"))
    (waiting,) = progress.backlog(samples).collect()
    events = decode(history.frame(spark, messages)).count()
    assert (waiting.backlog, waiting.max_backlog) == (events, events)
    later = F.current_timestamp() + F.expr("INTERVAL 2 MINUTES")
    assert progress.stream_health(samples, later).first().status == "blocked"
    work.drain()
    samples = read_progress(spark, ledger_path(work.root, "ns"))
    (done,) = progress.backlog(samples).collect()
    assert (done.backlog, done.max_backlog) == (0, events)
    assert progress.stream_health(samples, later).first().status == "ready"


def test_old_carries_are_removed(work):
    messages = sorted(history.random_history(25, txns=16), key=lambda m: m[SEQ])
    for k in range(4):
        work.land(messages[k * len(messages) // 4 : (k + 1) * len(messages) // 4])
        work.drain()
    import os

    assert sorted(os.listdir(f"{work.checkpoint}/carry")) == ["batch=2", "batch=3"]


def test_failed_first_batch_is_run_again(spark, work):
    messages = history.random_history(12, txns=6)
    work.land(messages)

    def fail_after_writing(changes, batch_id):
        lake.write_batch(changes, work.root, "ns", batch_id)
        raise RuntimeError("store is down")

    with pytest.raises(Exception, match="store is down"):
        work.drain(sink=fail_after_writing)
    work.drain()
    work.drain()
    expected = filter_changes(decode(history.frame(spark, messages)), not_commit())
    assert reconcile.conservation(expected, work.lake()).count() == 0


def test_carry_holds_live_relations_only(spark, work):
    messages = sorted(history.random_history(9, txns=30), key=lambda m: m[SEQ])
    work.land(messages)
    work.drain()
    carry = spark.read.schema(CARRY).parquet(f"{work.checkpoint}/carry/batch=0").collect()
    kinds = sorted(r.kind for r in carry)
    assert kinds.count("S") == 1 and kinds.count("B") == 1
    state = next(r for r in carry if r.kind == "S")
    assert state.seq == max(m[SEQ] for m in messages)
    relations = [(r.session, r.relation_id) for r in carry if r.kind == "R"]
    assert {s for s, _ in relations} <= {state.session} and len(set(relations)) == len(relations)


def test_running_query_reports_health(spark, work):
    work.land(history.random_history(10, txns=3))
    query = stream_changes(
        stream_messages(spark, work.landing), work.root, work.checkpoint, "ns", flush_interval="1 second"
    )
    try:
        query.processAllAvailable()
        ledger = ledger_path(work.root, "ns")
        now = F.current_timestamp()
        (r,) = progress.stream_health(query_progress(query, spark, ledger), now).collect()
        assert r.ready
    finally:
        query.stop()
    (r,) = progress.stream_health(query_progress(query, spark, ledger), now).collect()
    assert (r.ready, r.status) == (False, "stopped")


def test_bad_interval_is_an_error(spark, work):
    work.land(history.random_history(10, txns=3))
    with pytest.raises(Exception, match="(?i)interval"):
        stream_changes(stream_messages(spark, work.landing), work.root, work.checkpoint, flush_interval="soon")


def test_a_stream_without_replays_equals_the_batch_and_leaves_no_scratch(spark, work):
    from cdclake import session

    messages = sorted(history.random_history(11, slots=2, txns=14), key=lambda m: m[SEQ])
    named = list(session._NAMED)
    third = len(messages) // 3
    for part in (messages[:third], messages[third:]):
        work.land(part)
        work.drain(dedup=True, predicates=())
    expected = reconcile.dedup_replays(decode(history.frame(spark, messages)))
    assert {(r.slot, r.seq) for r in work.lake().select("slot", "seq").collect()} == {(r.slot, r.seq) for r in expected.select("slot", "seq").collect()}
    assert [n for n in session._NAMED if n not in named and "positions" in n] == []


def test_a_stream_can_not_begin_to_remove_replays_midway(work):
    messages = sorted(history.random_history(12, txns=6), key=lambda m: m[SEQ])
    work.land(messages[:10])
    work.drain()
    work.land(messages[10:])
    with pytest.raises(Exception, match="stored with their replays"):
        work.drain(dedup=True)
