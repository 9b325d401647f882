"""Replay removal batch by batch against the whole, on random histories that break anywhere."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cdclake.operators import reconcile, replays
from cdclake.schema import CHANGE

SLOTS = 24


def history(seed: int, slot: str, txns: int = 14):
    """Rows ``(slot, session, seq, lsn, is_commit)`` as sessions send them, each from some confirmed transaction on.

    Transactions overlap: their rows stand between the commits before them. Some are
    bulk loads whose rows share a position, some have only a commit.
    """
    rng = random.Random(f"{seed}-{slot}")
    log, at = [], 1000
    for _ in range(txns):
        begun = at - rng.choice([0, 0, 40, 90])
        at += 100
        if rng.random() < 0.3:
            position = rng.randrange(max(0, begun), at) | 1
            rows = [position] * rng.randrange(1, 9)
        else:
            rows = sorted({rng.randrange(max(0, begun), at) | 1 for _ in range(rng.randrange(0, 5))})
        log.append((rows, at))  # commits are even, rows odd
    taken = {p for rows, _ in log for p in rows}
    used = set()
    for rows, _ in log:  # no two transactions share a position
        for i, p in enumerate(rows):
            while p in used and (i == 0 or rows[i - 1] != p):
                p += 2
                if p not in taken:
                    break
            rows[i] = p
        used |= set(rows)
    out, seq, session, position = [], 0, 1, 0
    while position < len(log):
        rows, commit = log[position]
        broken = rng.random() < 0.25
        stop = rng.randrange(0, len(rows) + 1) if broken else len(rows)
        for p in rows[:stop]:
            seq += rng.randrange(1, 4)
            out.append((slot, session, seq, p, False))
        if not broken:
            seq += rng.randrange(1, 4)
            out.append((slot, session, seq, commit, True))
            position += 1
        if broken or rng.random() < 0.1:
            session, position = session + 1, max(0, position - rng.choice([0, 0, 1, 2, 5]))
    return out


def as_changes(spark, rows):
    df = spark.createDataFrame([(*r, r[2]) for r in rows] or [], "slot string, session long, seq long, lsn long, is_commit boolean, n long")
    shaped = {
        "table": F.lit("t"),
        "operation": F.when(F.col("is_commit"), "commit").otherwise("insert"),
        "timestamp": F.timestamp_seconds("n"),
        "commit_time": F.timestamp_seconds("n"),
        "after": F.col("n").cast("string"),
    }
    return df.select(
        *[
            shaped.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CHANGE.fields
        ]
    )


def plain(rows):
    """The earliest row of each (position, commit or not, place at that position in its session)."""
    first, last, place = {}, {}, {}
    for slot, session, seq, lsn, commit in sorted(rows, key=lambda r: (r[0], r[2])):
        stretch = (slot, session, commit)
        place[stretch] = place[stretch] + 1 if last.get(stretch) == lsn else 0
        last[stretch] = lsn
        first.setdefault((slot, lsn, commit, place[stretch]), (slot, seq))
    return sorted(first.values())


def run_batches(spark, batches, path):
    sessions, held = spark.createDataFrame([], replays.SESSIONS), as_changes(spark, [])
    kept, most = [], 0
    for k, batch in enumerate(batches):
        new, sessions, held = replays.remove_replays(as_changes(spark, batch).repartition(3), sessions, held, chunk_bits=3)
        kept += [(r.slot, r.seq) for r in new.select("slot", "seq").collect()]
        for name, df in (("sessions", sessions), ("held", held)):
            df.write.parquet(f"{path}/{k}-{name}")
        sessions = spark.read.schema(replays.SESSIONS).parquet(f"{path}/{k}-sessions")
        held = spark.read.schema(CHANGE).parquet(f"{path}/{k}-held")
        most = max(most, sessions.groupBy("slot").count().agg(F.max("count")).first()[0] or 0)
    return sorted(kept), sessions, held, most


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cuts_give_what_the_whole_gives(spark, tmp_path, seed):
    rng = random.Random(seed)
    batches, rows = [[] for _ in range(5)], []
    for k in range(SLOTS):
        mine = history(seed, f"s{k:02d}")
        cuts = sorted(rng.randrange(len(mine) + 1) for _ in range(4))
        for b, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(mine)])):
            batches[b] += mine[low:high]
        rows += mine
    kept, _, held, most = run_batches(spark, batches, str(tmp_path))
    assert kept == plain(rows)
    assert held.count() == 0
    assert kept == sorted((r.slot, r.seq) for r in reconcile.dedup_replays(as_changes(spark, rows), chunk_bits=3).collect())
    sessions_sent = defaultdict(set)
    for r in rows:
        sessions_sent[r[0]].add(r[1])
    assert most <= max(map(len, sessions_sent.values()))


def rows_of(slot, session, seq, *positions):
    """``(slot, session, seq + i, position, is commit)``; commits are given as negative numbers."""
    return [(slot, session, seq + i, abs(p), p < 0) for i, p in enumerate(positions)]


def renamed(rows, slot):
    return [(slot, *r[1:]) for r in rows]


def test_cut_inside_a_bulk_load_and_inside_its_replay(spark, tmp_path):
    one = rows_of("a", 1, 0, 5, -10, 11, 11, 11, 11)  # breaks in a bulk load of six
    two = rows_of("a", 2, 100, 5, -10, 11, 11, 11, 11, 11, 11, -20, 21)
    three = rows_of("a", 3, 200, 11, 11, 11, 11, 11, 11, -20, 21, 25, -30)
    whole = one + two + three
    ways = {
        "inside": [one[:4], one[4:] + two[:1], two[1:5], two[5:] + three[:2], three[2:]],
        "single": [whole[:1], whole[1:3], whole[3:9], whole[9:10], whole[10:]],
        "at-once": [whole, [], [], [], []],
        "in-replay": [one + two[:4], two[4:6], two[6:], three[:5], three[5:]],
    }
    batches = [[r for slot, way in ways.items() for r in renamed(way[k], slot)] for k in range(5)]
    kept, sessions, held, _ = run_batches(spark, batches, str(tmp_path))
    assert kept == plain([r for slot in ways for r in renamed(whole, slot)]) and held.count() == 0
    for slot in ways:  # the newest, and those before that are not closed or joined yet
        assert sessions.filter(F.col("slot") == slot).count() <= 2


def test_rows_wait_until_it_is_known_whether_their_transaction_is_stored(spark, tmp_path):
    # Position 12 is below the stored commit 20: the transaction may be stored, or have run beside it.
    before, start = rows_of("a", 1, 0, 11, -14, 15, -20), rows_of("a", 2, 100, 12, 13)
    stored = rows_of("a", 2, 100, 11)  # a session that starts with the transaction of commit 14, cut in it
    ways = {
        "open": [before, start, []],
        "new": [before, start, rows_of("a", 2, 102, -30)],
        # Broken off for good, then sent again by a third session: the first arrival stays.
        "again": [before, start, rows_of("a", 3, 200, 12, 13, 17, -30)],
        "stored": [before, stored, rows_of("a", 2, 101, -14, 15)],
    }
    batches = [[r for slot, way in ways.items() for r in renamed(way[k], slot)] for k in range(3)]
    kept, _, held, _ = run_batches(spark, batches, str(tmp_path))
    seqs = {slot: [s for k, s in kept if k == slot] for slot in ways}
    assert seqs == {"open": [0, 1, 2, 3], "new": [0, 1, 2, 3, 100, 101, 102], "again": [0, 1, 2, 3, 100, 101, 202, 203], "stored": [0, 1, 2, 3]}
    assert sorted((r.slot, r.seq) for r in held.collect()) == [("open", 100), ("open", 101)]


def test_many_reconnects_leave_one_row_and_few_ranges(spark, tmp_path):
    rows, seq = [], 0
    for session in range(1, 31):
        for txn in range(max(0, session * 5 - 8), session * 5):
            for p in (txn * 10 + 1, txn * 10 + 3):
                rows.append(("a", session, seq, p, False))
                seq += 1
            rows.append(("a", session, seq, txn * 10 + 10, True))
            seq += 1
    kept, sessions, _, _ = run_batches(spark, [rows[:333], rows[333:]], str(tmp_path))
    assert kept == plain(rows)
    assert sessions.count() == 2  # the newest, and one interval for all before
    scanned = replays._transactions_of_rows(as_changes(spark, rows), 3)
    assert scanned.select("txn").distinct().count() > 200


def test_many_ranges_are_joined_by_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replays, "BROADCAST_RANGES", 0)
    rows = history(9, "x") + history(9, "y")
    kept, _, _, _ = run_batches(spark, [rows], str(tmp_path))
    assert kept == plain(rows)


def test_first_cover_is_that_of_comparing_all_pairs(spark):
    rng = random.Random(3)
    intervals = [(slot, s, low, low + rng.choice([-1, 0, 1, 7, 60, 900])) for slot in "ab" for s in range(40) for low in [rng.randrange(1000)]]
    points = [(slot, at) for slot in "ab" for at in range(0, 2000, 3)]
    found = replays._first_cover(
        spark.createDataFrame(points, "slot string, at long"),
        spark.createDataFrame(intervals, "slot string, session long, low long, high long"),
        "first",
    )
    covers = {(slot, at): [s for k, s, low, high in intervals if k == slot and low <= at <= high] for slot, at in points}
    assert {(r.slot, r.at): r.first for r in found.collect()} == {p: min(c, default=None) for p, c in covers.items()}


def test_sessions_are_not_compared_in_pairs(spark):
    # Neither a join of a slot's sessions with each other, nor a list of all of them beside each transaction.
    after = spark.createDataFrame([], replays.SESSIONS).selectExpr(
        "*", *[f"cast(null as bigint) {c}" for c in ("old_txn", "old_lsn", "old_rows", "old_drop")], "false here"
    )
    txns = spark.createDataFrame([], "slot string, session long, txn long, begin_lsn long, n long, commit_lsn long, last_seq long")
    begun = replays._with_begin(txns, after)
    judged = replays._judged(begun, after, replays._completed_elsewhere(begun, after))
    text = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in text and "session#" in text
    assert judged.count() == 0
