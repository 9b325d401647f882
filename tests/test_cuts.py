"""The joint rule of count and interval against a plain loop."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cdclake.operators import cuts
from cdclake.operators.cuts import Function, Phases
from tests.test_replays import as_changes


def plain_loop(times, n, interval):
    """``(end, cut time, by)`` of one slot's events, as a buffer with a ticker cuts them."""
    out, pending, now = [], 0, None
    tick = times[0] + interval
    for i, at in enumerate(times):
        now = at if now is None else max(now, at)
        while tick <= now:
            if pending:
                out.append((i, tick, "tick"))
                pending = 0
            tick += interval
        pending += 1
        if pending == n:
            out.append((i + 1, now, "count"))
            pending, tick = 0, now + interval
    if pending:
        out.append((len(times), tick, "tick"))
    return out


def draw_times(rng, size, interval):
    """Times with bursts, lulls and steady stretches, now and then falling back."""
    at, times = rng.randrange(10 * interval), []
    while len(times) < size:
        step = rng.choice([0, 1, interval // 7, interval // 3, interval, 5 * interval])
        for _ in range(rng.randrange(1, 12)):
            at += rng.randrange(step + 1)
            times.append(at - (rng.randrange(interval) if rng.random() < 0.05 else 0))
    return times[:size]


def by_chunks(times, n, interval, bits):
    """The operator's steps without Spark."""
    latest, flat = None, []
    for t in times:
        latest = t if latest is None else max(latest, t)
        flat.append(latest)
    bits = max(bits, (n - 1).bit_length())
    chunks = sorted({i >> bits for i in range(1, len(flat) + 1)})

    def near(c):
        idx = [i for i in range(1, len(flat) + 1) if abs((i >> bits) - c) <= 1]
        return pa.table({"idx": idx, "at": [flat[i - 1] for i in idx], "lsn": idx})

    level = [[cuts._function_of(near(c), c, n, interval, bits) for c in chunks]]
    fan = cuts.FAN_OUT
    while len(level[-1]) > 1:
        rows = level[-1]
        blocks = [[{"chunk": k, **r} for k, r in enumerate(rows[b : b + fan])] for b in range(0, len(rows), fan)]
        level.append([cuts._composed(pa.Table.from_pylist(b), interval) for b in blocks])
    states = [0]
    level.pop()
    while level:
        rows, handed = level.pop(), []
        for b, state in enumerate(states):
            for row in rows[b * fan : (b + 1) * fan]:
                handed.append(state)
                state = Function(row, interval)(state)
        states = handed
    out = []
    for c, state in zip(chunks, states, strict=True):
        out += [(r["end_idx"], r["cut_us"], r["cut_by"]) for r in cuts._cuts_of(near(c), c, state, n, interval, bits).to_pylist()]
    return sorted(out)


@pytest.mark.parametrize("seed", range(60))
def test_chunks_composed_give_the_plain_loop(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(cuts, "FAN_OUT", rng.choice([2, 3, 64]))
    n, interval = rng.choice([1, 2, 3, 7, 16]), rng.choice([1, 2, 10, 1000])
    times = draw_times(rng, rng.randrange(1, 400), interval)
    assert by_chunks(times, n, interval, rng.choice([2, 3, 5])) == plain_loop(times, n, interval)


def test_step_functions_against_a_table():
    rng = random.Random(7)
    for _ in range(200):
        interval = rng.randrange(1, 12)
        phases, table = Phases(interval), [None] * interval
        for m in range(rng.randrange(8)):
            time, span = rng.randrange(40), rng.randrange(interval + 2)
            phases.add(m, time, span)
            for phase in range(interval):
                if (time - phase) % interval >= span:
                    table[phase] = m
        assert [phases.find(p) for p in range(interval)] == table


def test_the_operator_against_the_plain_loop(spark):
    rng, rows, wanted = random.Random(11), [], {}
    interval = 2_000_000
    for k in range(4):
        times = draw_times(rng, 300 if k else 5, interval)
        rows += [(f"s{k}", 1, 3 * i + k, 100 + i, i % 5 == 4, t) for i, t in enumerate(times)]
        wanted[f"s{k}"] = plain_loop(times, 6, interval)
    changes = as_changes(spark, [r[:5] for r in rows]).drop("timestamp")
    at = spark.createDataFrame([(r[0], r[2], r[5]) for r in rows], "slot string, seq long, us long")
    changes = changes.join(at, ["slot", "seq"]).withColumn("timestamp", F.timestamp_micros("us"))
    got = cuts.segments_joint(changes, 6, "2 seconds", chunk_bits=3).withColumn("us", F.unix_micros("cut_at")).collect()
    for slot, ends in wanted.items():
        mine = sorted((r for r in got if r.slot == slot), key=lambda r: r.end_idx)
        assert [(r.end_idx, r.us, r.cut_by) for r in mine] == ends
        assert [r.start_idx for r in mine] == [0, *(e for e, _, _ in ends[:-1])]
        assert [r.last_lsn for r in mine] == [99 + e for e, _, _ in ends]
        assert not any(r.done or r.done_at for r in mine)


def test_nothing_and_bad_arguments(spark):
    none = as_changes(spark, [])
    assert cuts.segments_joint(none, 5, "1 second").collect() == []
    with pytest.raises(ValueError):
        cuts.segments_joint(none, 0, "1 second")
    with pytest.raises(ValueError):
        cuts.segments_joint(none, 5, "0 seconds")


def test_a_chunk_is_gone_through_once(monkeypatch):
    added, add = [], cuts.Phases.add
    monkeypatch.setattr(cuts.Phases, "add", lambda self, *given: added.append(given) or add(self, *given))
    events = range(16, 64)  # the chunk before, the chunk, and the next one
    rows = pa.table({"idx": list(events), "at": [i * i for i in events]})
    cuts._function_of(rows, 2, 3, 100, 4)
    assert 0 < len(added) <= len(events)
