"""Segments by count and by interval at once: a cut by count starts the interval anew.

Pending events are cut when there are ``n`` of them, and at every tick.  Ticks come
each ``interval`` since the last cut by count, or since the slot's first event.  So each
cut depends on the one before, along the whole slot; still no task sees a slot:

* what a chunk of the slot needs to know of all before it is little: where in the
  chunk the first cut by count is, if the chunk before has settled that, or else
  only the phase of the ticks, the last such cut's time modulo the interval;
* so a chunk is a function from that to the same for the next chunk.  By phase it is a
  step function; its other arguments are the few cuts that the chunk before can lead to;
* functions of neighbouring chunks are composed, block by block and level by level;
  then what each chunk really starts from is handed down again, and every chunk
  lists its cuts.

The interval map of phases is the one step that column functions do not express; it
runs in grouped Arrow batches, one chunk of positions at a time.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.operators.planning import BATCH_SIZE
from cdclake.operators.scan import CHUNK_BITS, Running, ordered_scan
from cdclake.session import materialized

#: Chunks, or blocks of them, whose functions are composed in one task.
FAN_OUT = 64

#: A state is a cut by count at event ``m`` of the chunk (``m``), or a phase that no cut
#: has been found for (``-1 - phase``), or such a phase that this chunk has been searched
#: for already (``-1 - interval - phase``).  ``_SAME`` in a step function: the phase stays.
_SAME = -(1 << 62)

_FUNCTION = "slot string, chunk long, nodes array<long>, exits array<long>, at array<long>, to array<long>, late_at array<long>, late_to array<long>"


class Phases:
    """A step function on the phases ``0 .. interval - 1``."""

    def __init__(self, interval: int, value: int | None = None):
        self.interval, self.starts, self.values = interval, [0], [value]

    def _assign(self, low: int, high: int, value: int) -> None:
        if low >= high:
            return
        first, last = bisect_left(self.starts, low), bisect_left(self.starts, high)
        if last == len(self.starts) or self.starts[last] != high:
            if high < self.interval:
                self.starts.insert(last, high)
                self.values.insert(last, self.values[last - 1])
        self.starts[first:last], self.values[first:last] = [low], [value]

    def add(self, m: int, time: int, span: int) -> None:
        """Let ``m`` be the cut for the phases that have no tick within the ``span`` that its ``n`` events take."""
        if span >= self.interval:
            return
        low = (time + 1) % self.interval if span else 0
        high = low + self.interval - span
        self._assign(low, min(high, self.interval), m)
        self._assign(0, high - self.interval, m)

    def copy(self) -> Phases:
        same = Phases(self.interval)
        same.starts, same.values = self.starts.copy(), self.values.copy()
        return same

    def before(self, end: int) -> Phases:
        """Without the cuts at ``end`` or later."""
        same = self.copy()
        same.values = [None if m is None or m >= end else m for m in same.values]
        return same

    def find(self, phase: int) -> int | None:
        return self.values[bisect_right(self.starts, phase) - 1]


class Stretch:
    """Consecutive events ``first, first + 1, ...`` and their times, which never fall."""

    def __init__(self, first: int, times: np.ndarray, n: int, interval: int):
        self.first, self.end, self.n, self.interval = first, first + len(times), n, interval
        self.times = times.tolist()

    def time(self, i: int) -> int:
        return self.times[i - self.first]

    def next_cuts(self, low: int, high: int, last: int, entry: int | None = None) -> tuple[dict[int, int | None], Phases]:
        """For a cut at each event from ``low`` up to ``last`` the next cut by count before ``high``, or None.

        Also the first cut from ``entry`` on, by the phase of the ticks before.
        """
        phases, found, times, first, n = Phases(self.interval), {}, self.times, self.first, self.n
        entered = None
        for j in range(high - 1, low - 1, -1):
            m = j + n
            if entered is None and entry is not None and m < entry:
                entered = phases.copy()
            if m < high:
                time = times[m - first]
                phases.add(m, time, time - times[j + 1 - first])
            if j < last:
                found[j] = phases.find(times[j - first] % self.interval)
        return found, phases.copy() if entered is None else entered

    def by_phase(self, low: int, high: int) -> Phases:
        """The first cut by count from ``low`` to ``high - 1``, by the phase of the ticks before."""
        phases = Phases(self.interval)
        for m in range(high - 1, max(low, self.n) - 1, -1):
            phases.add(m, self.time(m), self.time(m) - self.time(m - self.n + 1))
        return phases


def _stretch(rows: pa.Table, n: int, interval: int) -> Stretch:
    idx, at = rows.column("idx").to_numpy(), rows.column("at").to_numpy()
    order = np.argsort(idx)
    first, times = int(idx[order[0]]), at[order]
    if first == 1:  # event 0 stands for the start of the ticks: it counts for nothing
        first, times = 0, np.concatenate([times[:1], times])
    return Stretch(first, times, n, interval)


def _exit(node: int, cuts: dict[int, int | None], end: int, time, interval: int) -> int:
    """The state in which the chunk that ends at ``end`` is left, from a cut at ``node`` in it."""
    while True:
        following = cuts[node]
        if following is None:
            return -1 - interval - time(node) % interval
        if following >= end:
            return following
        node = following


def _bounds(chunk: int, bits: int, stretch: Stretch) -> tuple[int, int, int]:
    """Where the chunk begins and ends, and where the stretch of it and the next ends."""
    low = chunk << bits
    return low, min(low + (1 << bits), stretch.end), min(low + (2 << bits), stretch.end)


def _function_of(rows: pa.Table, chunk: int, n: int, interval: int, bits: int) -> dict:
    stretch = _stretch(rows, n, interval)
    low, end, far = _bounds(chunk, bits, stretch)
    # One way back through the next chunk, this one and that before; of two cuts the earlier one counts, wherever it ends.
    back = low if chunk == 0 else max(stretch.first, low - (1 << bits))
    cuts, phases = stretch.next_cuts(back, far, end, low)
    phases = phases.before(end)
    entered = {m for m in phases.values if m is not None}
    if chunk == 0:
        entered.add(0)
    else:
        entered |= {m for j, m in cuts.items() if j < low and m is not None and low <= m < end}
    exits = {m: _exit(m, cuts, end, stretch.time, interval) for m in sorted(entered)}
    return {
        "nodes": list(exits), "exits": list(exits.values()),
        "at": phases.starts, "to": [_SAME if m is None else exits[m] for m in phases.values],
        "late_at": [0], "late_to": [_SAME],
    }


class Function:
    """What a chunk, or a block of them, makes of the state that it is entered in."""

    def __init__(self, row: dict, interval: int):
        self.interval = interval
        self.exits = dict(zip(row["nodes"], row["exits"], strict=True))
        self.plain, self.late = (row["at"], row["to"]), (row["late_at"], row["late_to"])

    def __call__(self, state: int) -> int:
        if state >= 0:
            return self.exits[state]
        phase, (at, to) = self.split(state)
        found = to[bisect_right(at, phase) - 1]
        return -1 - phase if found == _SAME else found

    def split(self, state: int):
        phase = -1 - state
        return (phase - self.interval, self.late) if phase >= self.interval else (phase, self.plain)


def _steps(functions: list[Function], late: bool, interval: int) -> tuple[list[int], list[int]]:
    """The step function of functions one after the other."""
    pieces = [(0, interval, _SAME)]
    for k, f in enumerate(functions):
        at, to = f.late if late and k == 0 else f.plain
        done = []
        for low, high, state in pieces:
            if state != _SAME:
                done.append((low, high, f(state)))
                continue
            for begin, end, value in zip(at, [*at[1:], interval], to, strict=True):
                if begin < high and low < end:
                    done.append((max(low, begin), min(high, end), value))
        pieces = done
    merged = [p for i, p in enumerate(pieces) if i == 0 or pieces[i - 1][2] != p[2]]
    return [p[0] for p in merged], [p[2] for p in merged]


def _composed(rows: pa.Table, interval: int) -> dict:
    functions = [Function(r, interval) for r in rows.sort_by("chunk").to_pylist()]
    exits = {}
    for node in functions[0].exits:
        state = node
        for f in functions:
            state = f(state)
        exits[node] = state
    at, to = _steps(functions, False, interval)
    late_at, late_to = _steps(functions, True, interval)
    return {"nodes": list(exits), "exits": list(exits.values()), "at": at, "to": to, "late_at": late_at, "late_to": late_to}


def _row(slot: str, chunk: int, values: dict) -> pa.Table:
    whole = pa.list_(pa.int64())
    columns = {"slot": pa.array([slot], pa.string()), "chunk": pa.array([chunk], pa.int64())}
    return pa.table(columns | {k: pa.array([v], whole) for k, v in values.items()})


def _cuts_of(rows: pa.Table, chunk: int, state: int, n: int, interval: int, bits: int) -> pa.Table:
    """Where pending events are cut: the end, when, the last position, and by what.

    From the state that the chunk is entered in to the next chunk's first cut by count,
    if this one leads there; else to the chunk's end, where the next goes on by the phase.
    """
    stretch = _stretch(rows, n, interval)
    low, end, far = _bounds(chunk, bits, stretch)
    cuts, _ = stretch.next_cuts(low, far, end)
    if state >= 0:
        node, phase, begin = state, 0, state
    else:
        late, phase, begin = -1 - state >= interval, (-1 - state) % interval, low
        node = None if late else stretch.by_phase(low, end).find(phase)
    positions = dict(zip(rows.column("idx").to_pylist(), rows.column("lsn").to_pylist(), strict=True))
    found = []
    i = begin
    while i < (end if node is None or node < end else node):
        time = stretch.time(i)
        if i == node:
            if i > 0:
                found.append((i, time, positions[i], "count"))
            phase, node = time % interval, cuts[i]
        else:
            tick = (time - phase) // interval
            if i + 1 >= stretch.end or (stretch.time(i + 1) - phase) // interval != tick:
                found.append((i, (tick + 1) * interval + phase, positions[i], "tick"))
        i += 1
    kinds = (("end_idx", pa.int64()), ("cut_us", pa.int64()), ("last_lsn", pa.int64()), ("cut_by", pa.string()))
    return pa.table({name: pa.array([f[k] for f in found], kind) for k, (name, kind) in enumerate(kinds)})


def _nothing(schema: str) -> pa.Table:
    kinds = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([], kinds[kind]) for name, kind in fields})


def segments_joint(changes: DataFrame, n: int = BATCH_SIZE, interval: str = "30 seconds", chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """One not yet finished segment per cut, by whichever of count and interval comes first; ``cut_by`` says which.

    An event's time is when it was decoded, or the latest such time before it in its
    slot.  A tick comes before the events of the same instant.  Ticks at which nothing
    is pending cut nothing; what is pending at the end is cut by the next tick.
    """
    spark = changes.sparkSession
    step = spark.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL '{interval}')")).first()[0]
    if n < 1 or step < 1:
        raise ValueError("segments need a count and an interval above 0")
    bits = max(chunk_bits, (n - 1).bit_length())  # a chunk has at least n events
    times = changes.select("slot", "seq", "lsn", F.unix_micros("timestamp").alias("micros"))
    counted = ordered_scan(
        times, ["slot"], "seq", {"idx": Running("sum", F.lit(1).cast("bigint")), "at": Running("max", F.col("micros"))}, chunk_bits
    )
    events = materialized(counted.select("slot", "idx", "at", "lsn", F.shiftright("idx", bits).alias("own")), "events")
    near = events.withColumn("chunk", F.explode(F.array([F.col("own") + k for k in (-1, 0, 1)]))).filter("chunk >= 0")

    def function(rows: pa.Table) -> pa.Table:
        chunk = rows.column("chunk")[0].as_py()
        if chunk not in set(rows.column("own").to_pylist()):
            return _nothing(_FUNCTION)  # the place after the last chunk
        return _row(rows.column("slot")[0].as_py(), chunk, _function_of(rows, chunk, n, step, bits))

    def compose(rows: pa.Table) -> pa.Table:
        return _row(rows.column("slot")[0].as_py(), rows.column("block")[0].as_py(), _composed(rows, step))

    levels = [materialized(near.groupBy("slot", "chunk").applyInArrow(function, _FUNCTION), "cut-functions")]
    while not levels[-1].filter("chunk > 0").isEmpty():
        blocks = levels[-1].withColumn("block", F.floor(F.col("chunk") / FAN_OUT))
        levels.append(materialized(blocks.groupBy("slot", "block").applyInArrow(compose, _FUNCTION), "cut-functions"))

    def hand_down(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        state, states = rows.column("state")[0].as_py(), []
        for row in rows.to_pylist():
            states.append(state)
            state = Function(row, step)(state)
        return pa.table({"slot": rows.column("slot"), "chunk": rows.column("chunk"), "state": pa.array(states, pa.int64())})

    states = levels.pop().select("slot", "chunk", F.lit(0).cast("bigint").alias("state"))  # the ticks start at event 0
    while levels:
        blocks = levels.pop().withColumn("block", F.floor(F.col("chunk") / FAN_OUT))
        entered = blocks.join(states.select("slot", F.col("chunk").alias("block"), "state"), ["slot", "block"])
        states = materialized(entered.groupBy("slot", "block").applyInArrow(hand_down, "slot string, chunk long, state long"), "cut-states")

    def cut(rows: pa.Table) -> pa.Table:
        found = _cuts_of(rows, rows.column("chunk")[0].as_py(), rows.column("state")[0].as_py(), n, step, bits)
        return found.add_column(0, "slot", pa.array([rows.column("slot")[0].as_py()] * len(found), pa.string()))

    found = near.join(states, ["slot", "chunk"]).groupBy("slot", "chunk")
    ends = materialized(found.applyInArrow(cut, "slot string, end_idx long, cut_us long, last_lsn long, cut_by string"), "cuts")
    placed = ordered_scan(ends, ["slot"], "end_idx", {"start_idx": Running("lag", F.col("end_idx"))}, bits)
    return placed.select(
        "slot",
        F.coalesce("start_idx", F.lit(0).cast("bigint")).alias("start_idx"),
        "end_idx",
        F.lit(False).alias("done"),
        "last_lsn",
        F.timestamp_micros("cut_us").alias("cut_at"),
        F.lit(None).cast("timestamp").alias("done_at"),
        "cut_by",
    )
