import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cdclake.operators import planning, progress, reconcile
from cdclake.operators.decode import decode
from cdclake.operators.filters import filter_changes, not_commit
from cdclake.schema import CHANGE, MESSAGE, PROGRESS, SEGMENT
from cdclake.sources import ledger as ledgers
from cdclake.sources.ledger import write_segments
from tests import history

UTC = dt.timezone.utc
DAY1 = dt.datetime(2026, 5, 9, 23, 59, 59, tzinfo=UTC)
DAY2 = DAY1 + dt.timedelta(seconds=2)
DAY3 = DAY2 + dt.timedelta(hours=24)


def changes_at(spark, times, slot="s", operations=None, decoded=None):
    rows = []
    for i, t in enumerate(times):
        op = operations[i] if operations else "insert"
        rows.append(("t", op, decoded[i] if decoded else t, i + 1, None, "{}", t, slot, 1, i + 1, 7, "public"))
    return spark.createDataFrame(rows, CHANGE)


# ------------------------------------------------------------------ planning


@pytest.mark.parametrize(
    ("times", "files"),
    [
        ([DAY1] * 4, [4]),
        ([DAY1, DAY2, DAY2, DAY2], [1, 3]),
        ([DAY1, DAY1, DAY1, DAY2], [3, 1]),
        ([DAY1, DAY2, DAY2, DAY3, DAY3], [1, 2, 2]),
        ([DAY1, DAY2, DAY1], [1, 1, 1]),
    ],
)
def test_files_split_by_day(spark, times, files):
    manifest = planning.file_manifest(changes_at(spark, times), "ns").orderBy("segment", "run").collect()
    assert [r.events for r in manifest] == files
    assert [r.sequence for r in manifest] == list(range(1, len(files) + 1))


def test_key_uses_commit_day_and_last_decode_time(spark):
    decoded = DAY1 + dt.timedelta(seconds=5)
    changes = changes_at(spark, [DAY1, DAY1], operations=["insert", "commit"], decoded=[decoded, decoded])
    (row,) = planning.file_manifest(changes, "ns", 1000, not_commit()).collect()
    assert row.key == f"ns/2026/05/09/{int(decoded.timestamp()) * 1_000_000}-1.ZSTD.parquet"
    assert (row.events, row.rows) == (2, 1)


def test_keys_are_unique_on_equal_microseconds(spark):
    manifest = planning.file_manifest(changes_at(spark, [DAY1] * 3), "ns", 1)
    assert manifest.select("key").distinct().count() == 3
    assert reconcile.duplicate_keys(manifest).count() == 0
    same = manifest.withColumn("key", F.lit("k"))
    assert [tuple(r) for r in reconcile.duplicate_keys(same).collect()] == [("k", 3)]


def test_run_left_empty_has_no_file(spark):
    changes = changes_at(spark, [DAY1, DAY2, DAY2], operations=["commit", "insert", "commit"])
    rows = planning.file_manifest(changes, "ns", 10, not_commit()).orderBy("run").collect()
    assert [(r.events, r.rows, r.sequence, r.key is None) for r in rows] == [(1, 0, None, True), (2, 1, 1, False)]


@pytest.mark.parametrize("seed", range(4))
def test_random_days_keep_every_event_once_and_in_order(spark, seed):
    rng = random.Random(seed)
    n, size = rng.randint(1, 50), rng.randint(1, 7)
    midnight = dt.datetime(2026, 5, 10, tzinfo=UTC)
    times = [midnight + dt.timedelta(seconds=rng.uniform(-2, 2)) for _ in range(n)]
    runs = planning.day_runs(changes_at(spark, times), size, chunk_bits=3).orderBy("seq").collect()
    assert [r.seq for r in runs] == list(range(1, n + 1))
    assert [r.idx for r in runs] == list(range(n))
    assert [r.segment for r in runs] == [i // size for i in range(n)]
    days = [t.date() for t in times]
    run = 0
    for i, r in enumerate(runs):
        if i % size == 0:
            run = 0
        elif days[i] != days[i - 1]:
            run += 1
        assert (r.run, r.commit_date) == (run, days[i])


def test_segments_by_count_has_a_partial_tail(spark):
    rows = planning.segments_by_count(changes_at(spark, [DAY1] * 6), 4, chunk_bits=1).orderBy("start_idx").collect()
    assert [(r.start_idx, r.end_idx, r.last_lsn, r.done) for r in rows] == [(0, 4, 4, False), (4, 6, 6, False)]


def test_segments_by_interval_skip_empty_ticks(spark):
    base = dt.datetime(2026, 5, 9, 12, tzinfo=UTC)
    times = [base + dt.timedelta(seconds=s) for s in (0, 29, 30, 95)]
    rows = planning.segments_by_interval(changes_at(spark, times), "30 seconds").orderBy("start_idx").collect()
    assert [(r.start_idx, r.end_idx, r.last_lsn) for r in rows] == [(0, 2, 2), (2, 3, 3), (3, 4, 4)]


# ------------------------------------------------------------------ progress


def ledger(spark, segments, slot="s"):
    rows = [(slot, a, b, done, lsn, DAY1, None) for a, b, done, lsn in segments]
    return spark.createDataFrame(rows, SEGMENT)


def test_prefix_waits_for_out_of_order_finishes(spark):
    finished, got = set(), []
    for finish in (2, 4, 1, 3):
        finished.add(finish)
        rows = [(2 * i, 2 * i + 2, i + 1 in finished, 2 * i + 2) for i in range(4)]
        (r,) = progress.contiguous_prefix(ledger(spark, rows)).collect()
        got.append(r.acked_lsn or 0)
    assert got == [0, 0, 4, 8]


def test_prefix_from_a_read_index(spark):
    rows = [(0, 2, True, 2), (2, 4, True, 9), (4, 6, True, 5), (8, 9, True, 7)]
    (r,) = progress.contiguous_prefix(ledger(spark, rows), 2).collect()
    assert (r.read_idx, r.acked_lsn) == (6, 5)
    placed = ledger(spark, rows).withColumn("at", F.lit(8))
    (r,) = progress.contiguous_prefix(placed, F.col("at")).collect()
    assert (r.read_idx, r.acked_lsn) == (9, 7)
    (r,) = progress.contiguous_prefix(ledger(spark, rows[1:])).collect()
    assert (r.read_idx, r.acked_lsn) == (0, None)


@pytest.mark.parametrize("seed", range(4))
def test_random_ledgers(spark, seed):
    rng = random.Random(seed)
    frames, expected = [], {}
    for slot in ("a", "b", "c"):
        at, rows, prefix, lsn, whole = 0, [], 0, None, True
        for _ in range(rng.randint(1, 30)):
            size, done, last = rng.randint(1, 5), rng.random() < 0.85, rng.randint(1, 1000)
            if rng.random() < 0.05:
                at += 1  # a lost segment
                whole = False
            rows.append((at, at + size, done, last))
            whole = whole and done
            at += size
            if whole:
                prefix, lsn = at, last
        rng.shuffle(rows)
        frames.append(ledger(spark, rows, slot))
        expected[slot] = (prefix, lsn)
    segments = frames[0].unionByName(frames[1]).unionByName(frames[2])
    got = {r.slot: (r.read_idx, r.acked_lsn) for r in progress.contiguous_prefix(segments, chunk_bits=seed + 1).collect()}
    assert got == expected


def test_long_ledger(spark):
    segments = spark.range(200_000).select(
        F.lit("s").alias("slot"), F.col("id").alias("start_idx"), (F.col("id") + 1).alias("end_idx"),
        (F.col("id") != 150_000).alias("done"), (F.col("id") * 3).alias("last_lsn"),
    )
    (r,) = progress.contiguous_prefix(segments).collect()
    assert (r.read_idx, r.acked_lsn) == (150_000, 149_999 * 3)


def test_position_never_falls(spark):
    rows = ledger(spark, [(0, 1, True, 10), (1, 2, True, 5), (2, 3, True, 12)])
    history_ = progress.acked_history(rows, "last_lsn", chunk_bits=1).orderBy("end_idx").collect()
    assert [r.confirmed_lsn for r in history_] == [10, 10, 12]
    assert progress.acked_position(rows, "last_lsn").first().acked_lsn == 12


def back_to_back(spark):
    """T1 and T2 with T2's commit record starting where T1's ends."""
    t = dict(slot="s", session=1)
    return spark.createDataFrame(
        [
            history.msg(**t, seq=1, kind="B", wal_start=10),
            history.msg(**t, seq=2, kind="R", relation_id=1, relation_name="t", wal_start=0),
            history.msg(**t, seq=3, kind="I", relation_id=1, wal_start=10),
            history.msg(**t, seq=4, kind="C", wal_start=20, end_lsn=30),
            history.msg(**t, seq=5, kind="B", wal_start=12),
            history.msg(**t, seq=6, kind="I", relation_id=1, wal_start=12),
            history.msg(**t, seq=7, kind="C", wal_start=30, end_lsn=40),
            history.msg(**t, seq=8, kind="B", wal_start=41),
            history.msg(**t, seq=9, kind="I", relation_id=1, wal_start=41),
        ],
        MESSAGE,
    )


def test_restart_takes_a_position_per_slot(spark):
    both = back_to_back(spark).unionByName(back_to_back(spark).withColumn("slot", F.lit("other")))
    acked = spark.createDataFrame([("s", 40), ("unused", 1)], "slot string, acked_lsn bigint")
    got = progress.safe_restart(both, acked, chunk_bits=1).collect()
    assert sorted(r.seq for r in got if r.slot == "s") == [2, 8, 9]
    assert sorted(r.seq for r in got if r.slot == "other") == list(range(1, 10))


@pytest.mark.parametrize(
    ("acked", "seqs"),
    [(0, range(1, 10)), (12, range(1, 10)), (30, [2, 5, 6, 7, 8, 9]), (39, [2, 5, 6, 7, 8, 9]), (40, [2, 8, 9])],
)
def test_restart_skips_only_whole_confirmed_transactions(spark, acked, seqs):
    got = progress.safe_restart(back_to_back(spark), acked, chunk_bits=1)
    assert sorted(r.seq for r in got.collect()) == list(seqs)


def test_resume_reads_the_ledger_and_fails_without_one(spark, tmp_path):
    messages = back_to_back(spark)
    write_segments(ledger(spark, [(0, 2, True, 30), (2, 4, False, 40)]), str(tmp_path / "ledger"), 0)
    got = progress.resume(spark, messages, str(tmp_path / "ledger"))
    assert sorted(r.seq for r in got.collect()) == [2, 5, 6, 7, 8, 9]
    later = progress.resume(spark, messages, str(tmp_path / "ledger"), last_acked=spark.createDataFrame([("s", 40)], "slot string, acked_lsn bigint"))
    assert sorted(r.seq for r in later.collect()) == [2, 8, 9]
    with pytest.raises(AnalysisException):
        progress.resume(spark, messages, str(tmp_path / "nothing")).collect()


def test_resume_keeps_slots_apart_and_never_goes_back(spark, tmp_path):
    both = back_to_back(spark).unionByName(back_to_back(spark).withColumn("slot", F.lit("other")))
    # Slot s is finished with 40 and then, in a replay, with 30; slot other has an unfinished segment.
    segments = ledger(spark, [(0, 2, True, 40), (2, 4, True, 30), (4, 6, False, 50)])
    other = ledger(spark, [(0, 2, False, 30)]).withColumn("slot", F.lit("other"))
    write_segments(segments.unionByName(other), str(tmp_path / "ledger"), 0)
    (s,) = progress.contiguous_prefix(segments).collect()
    assert (s.acked_lsn, s.confirmed_lsn) == (30, 40)

    def seqs(rows, slot):
        return sorted(r.seq for r in rows if r.slot == slot)

    got = progress.resume(spark, both, str(tmp_path / "ledger")).collect()
    assert seqs(got, "s") == [2, 8, 9] and seqs(got, "other") == list(range(1, 10))
    for_s = spark.createDataFrame([("s", 20), ("unused", 99)], "slot string, acked_lsn bigint")
    got = progress.resume(spark, both, str(tmp_path / "ledger"), for_s).collect()
    assert seqs(got, "s") == [2, 8, 9] and seqs(got, "other") == list(range(1, 10))


def test_health_allows_exactly_sixty_seconds(spark):
    now = DAY1 + dt.timedelta(hours=1)

    def ago(seconds):
        return now - dt.timedelta(seconds=seconds)

    rows = [
        ("exact", ago(1), True, ago(60), 0, 0, 0),
        ("over", ago(1), True, ago(60) - dt.timedelta(microseconds=1), 0, 0, 0),
        ("free", ago(1), True, None, 0, 0, 0),
        ("down", ago(9), True, None, 0, 0, 0),
        ("down", ago(1), False, None, 0, 0, 0),
        ("unheard", ago(1), None, None, 0, 0, 0),
    ]
    got = progress.stream_health(spark.createDataFrame(rows, PROGRESS), F.lit(now))
    assert {r.slot: r.ready for r in got.collect()} == {"exact": True, "over": False, "free": True, "down": False, "unheard": False}


def test_backlog_and_regressions(spark):
    rows = [
        ("s", DAY1, True, None, 10, 2, 50),
        ("s", DAY2, True, None, 12, 9, 40),
        ("s", DAY3, True, None, 13, 13, 60),
    ]
    samples = spark.createDataFrame(rows, PROGRESS)
    (r,) = progress.backlog(samples).collect()
    assert (r.max_backlog, r.backlog) == (8, 0)
    (r,) = progress.position_regressions(samples).collect()
    assert (r.acked_lsn, r.previous_lsn) == (40, 50)


# ------------------------------------------------------------ reconciliation


@pytest.mark.parametrize("seed", range(4))
def test_replays_are_removed_once_per_source_change(spark, seed):
    messages = history.random_history(seed + 20)
    changes = decode(history.frame(spark, messages))
    rows = sorted(changes.select("session", "lsn", "operation", "seq").collect(), key=lambda r: r.seq)
    seen, places, kept = set(), {}, []
    for r in rows:
        group = (r.session, r.lsn, r.operation == "commit")
        places[group] = places.get(group, 0) + 1
        key = (r.lsn, r.operation == "commit", places[group])
        if key not in seen:
            seen.add(key)
            kept.append(r.seq)
    got = sorted(r.seq for r in reconcile.dedup_replays(changes, chunk_bits=3).collect())
    assert got == kept
    assert len(got) < len(rows)


def test_missing_and_leaked_rows(spark):
    from pyspark.sql import types as T

    fields = {"id": T.LongType(), "v": T.StringType(), "n": T.DecimalType(38, 2)}
    rows = [
        ("t", "insert", DAY1, 1, None, '{"id":1,"n":9999999999999999.99,"v":"a"}', DAY1, "s", 1, 1, 7, "p"),
        ("t", "update", DAY1, 2, '{"id":2}', '{"id":2,"n":1.00,"v":"b"}', DAY1, "s", 1, 2, 7, "p"),
        ("t", "delete", DAY1, 3, '{"id":3}', None, DAY1, "s", 1, 3, 7, "p"),
        ("t", "insert", DAY1, 4, None, '{"id":4,"n":null,"v":null}', DAY1, "s", 1, 4, 7, "p"),
    ]
    lake = spark.createDataFrame(rows, CHANGE)
    expected = spark.createDataFrame(
        [
            ("insert", 1, "a", "9999999999999999.99"),
            ("insert", 1, "a", "9999999999999999.98"),
            ("update", 2, "b", "1"),
            ("delete", 3, "ignored", "7"),
            ("delete", 1, None, None),
            ("insert", 4, None, None),
            ("delete", 1, None, None),
        ],
        "operation string, id bigint, v string, n string",
    ).withColumn("n", F.col("n").cast("decimal(38,2)"))
    got = reconcile.missing_changes(expected, lake, fields).collect()
    assert sorted((r.operation, r.id, str(r.n)) for r in got) == [
        ("delete", 1, "None"),
        ("delete", 1, "None"),
        ("insert", 1, "9999999999999999.98"),
    ]
    ids = spark.createDataFrame([(3,), (9,)], "id bigint")
    assert [r.seq for r in reconcile.rolled_back_leaks(lake, ids).collect()] == [3]


def test_exact_numbers_of_any_length(spark):
    long = "123456789012345678901234567890123456789012.50"
    image = f'{{"a":"x,\\"n\\":5","n":{long},"s.t":"Infinity","z":null}}'
    df = spark.createDataFrame([(image,)], "i string")
    fields = {"n": reconcile.EXACT, "s.t": reconcile.EXACT, "z": reconcile.EXACT, "a": reconcile.EXACT}
    got = df.select(*[c.alias(n) for n, c in reconcile.expand_image(F.col("i"), fields).items()]).first()
    assert (got[0], got[1], got[2], got[3]) == (long, "Infinity", None, None)


def test_exact_numbers_stand_at_the_top(spark):
    image = '{"props":{"value":1,"a":[2,{"value":3}]},"q\\"t":-4,"s":"\\\\","value":2.50}'
    df = spark.createDataFrame([(image,)], "i string")
    fields = dict.fromkeys(("value", 'q"t', "s", "props", "a"), reconcile.EXACT)
    got = df.select(*[c.alias(f"c{k}") for k, c in enumerate(reconcile.expand_image(F.col("i"), fields).values())]).first()
    assert tuple(got) == ("2.50", "-4", None, None, None)


def test_a_number_that_does_not_fit_is_not_null(spark):
    from pyspark.sql import types as T

    row = ("t", "insert", DAY1, 1, None, '{"id":1,"n":' + "9" * 40 + "}", DAY1, "s", 1, 1, 7, "p")
    lake = spark.createDataFrame([row], CHANGE)
    expected = spark.createDataFrame([("insert", 1, None)], "operation string, id bigint, n string").withColumn("n", F.col("n").cast("decimal(38,2)"))
    missing = reconcile.missing_changes(expected, lake, {"id": T.LongType(), "n": T.DecimalType(38, 2)})
    assert missing.count() == 1


def test_a_change_missing_very_often_is_given_as_often(spark):
    from pyspark.sql import types as T

    expected = spark.range(25_003).select(F.lit("delete").alias("operation"), F.lit(1).cast("bigint").alias("id"))
    missing = reconcile.missing_changes(expected, spark.createDataFrame([], CHANGE), {"id": T.LongType()})
    assert missing.count() == 25_003


def test_conservation_counts_lost_and_repeated_events(spark):
    changes = changes_at(spark, [DAY1] * 5)
    lake = changes.filter("seq <> 2").unionByName(changes.filter("seq = 3"))
    got = {(r.seq, r.decoded, r.stored) for r in reconcile.conservation(changes, lake).collect()}
    assert got == {(2, 1, 0), (3, 1, 2)}


def test_filter_chain(spark):
    changes = changes_at(spark, [DAY1] * 4, operations=["insert", "commit", "delete", "insert"])
    assert filter_changes(changes).count() == 4
    kept = filter_changes(changes, not_commit(), F.col("seq") > 1, F.col("operation") == "insert").collect()
    assert [r.seq for r in kept] == [4]


# ------------------------------------------------------------- ledger folding


def drawn_ledger(spark, seed, slots=6, segments=60):
    rng, rows = random.Random(seed), []
    for k in range(slots):
        at = 0
        for i in range(segments):
            size = rng.randrange(1, 9)
            if rng.random() < 0.03:
                at += 5  # a lost segment
            rows.append((f"s{k}", at, at + size, rng.random() > 0.06 or i < 8 * k, rng.randrange(10**6), None, None))
            at += size
    return spark.createDataFrame(rows, SEGMENT)


@pytest.mark.parametrize("seed", [1, 2])
def test_folding_keeps_the_prefix_and_is_bounded_by_gaps(spark, seed):
    ledger = drawn_ledger(spark, seed)
    small = progress.folded(ledger, chunk_bits=5).cache()
    for job in (progress.contiguous_prefix, lambda x: progress.acked_position(x.filter("done"), "last_lsn")):
        assert sorted(map(tuple, job(small).collect())) == sorted(map(tuple, job(ledger).collect()))
    open_or_gap = ledger.filter("NOT done").count() + 6 * 3
    assert small.count() <= 3 * open_or_gap + 2 * 6 < ledger.count()
    assert small.filter("done").agg({"end_idx": "max"}).first()[0] == ledger.filter("done").agg({"end_idx": "max"}).first()[0]
    again = progress.folded(small, chunk_bits=5)
    assert again.count() <= small.count()
    assert sorted(map(tuple, progress.contiguous_prefix(again).collect())) == sorted(map(tuple, progress.contiguous_prefix(ledger).collect()))


def test_folded_ledger_goes_on(spark, tmp_path, monkeypatch):
    path = str(tmp_path)

    def segments(low, high):
        return spark.createDataFrame([("a", i * 10, i * 10 + 10, True, 100 + i, None, None) for i in range(low, high)], SEGMENT)

    def state():
        return [tuple(r) for r in progress.contiguous_prefix(ledgers.read_segments(spark, path)).collect()]

    for batch in range(4):
        ledgers.write_segments(segments(batch * 5, batch * 5 + 5), path, batch)
    before = state()
    with monkeypatch.context() as patched:  # fails before the folded rows count
        patched.setattr(ledgers, "put_if_absent", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            progress.fold_ledger(spark, path)
    assert state() == before
    with monkeypatch.context() as patched:  # fails before the old rows are removed
        patched.setattr(ledgers, "delete", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            progress.fold_ledger(spark, path)
    assert state() == before and ledgers.read_segments(spark, path).count() == 2
    assert progress.fold_ledger(spark, path) is None
    ledgers.write_segments(segments(15, 20), path, 3)  # the last batch is run again
    assert state() == before
    ledgers.write_segments(segments(20, 30), path, 4)
    assert state() == [("a", 300, 129, 129)]
    assert progress.fold_ledger(spark, path) == 4
    assert state() == [("a", 300, 129, 129)] and ledgers.read_segments(spark, path).count() == 2
    assert progress.fold_ledger(spark, path) is None


@pytest.mark.parametrize(
    "image",
    [
        '{"p":"{\\"k\\": 76}","a":1.50,"v":[[1]]}',
        '{"p":"x{","q":[{"a":1,"t":"]}"},"{"],"a":1.50}',
        '{"p":{"b":{"c":{"a":9}}},"a":1.50}',
        '{"p":[' + ",".join(['""'] * 1500) + '],"a":1.50}',
        '{"p":" ,\\"a\\":1","a":1.50}',
    ],
)
def test_both_ways_to_an_exact_number_agree(spark, image):
    df = spark.createDataFrame([(image,)], "i string")
    tokens = reconcile._member_by_tokens(F.col("i"), "a")
    assert tuple(df.select(reconcile._member_text(F.col("i"), "a"), tokens).first()) == ("1.50", "1.50")
