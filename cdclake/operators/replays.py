"""Replay removal in pieces: what a batch adds to all that came before it.

:func:`cdclake.operators.reconcile.dedup_replays` needs all changes at once.  Here
they come batch by batch, cut anywhere, and what is remembered is a row per session:

* a session sends whole transactions in the order of their commits, so what it has
  sent is an interval of commit positions and the first rows of one open transaction;
* a later transaction is a replay if its commit lies in an interval of an earlier
  session; of a transaction that an earlier session left open, the rows that it had
  sent are replays.  A transaction is known by its first row's position;
* where a batch ends in a transaction whose commit is not known yet, the commits
  before it mostly tell.  Where they don't (the first transaction of a session that
  starts at or below what is stored), its rows are held back until they do.

The rows that go are ranges of arrival numbers, few for each session, so the changes
themselves are not shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.operators.scan import CHUNK_BITS, Running, chunk_of, ordered_scan
from cdclake.session import materialized

#: What is known of a session: the commits it has sent, and of its open transaction the
#: first row's position, the rows sent, and how many first ones are replays
#: (``ALL``: every one; null: not known yet, so they are held).
SESSIONS = T.StructType(
    [
        T.StructField("slot", T.StringType()),
        T.StructField("session", T.LongType()),
        T.StructField("first_commit", T.LongType()),
        T.StructField("last_commit", T.LongType()),
        T.StructField("open_lsn", T.LongType()),
        T.StructField("open_rows", T.LongType()),
        T.StructField("open_drop", T.LongType()),
    ]
)

ALL = 1 << 62

#: Ranges that may be broadcast, 48 bytes each; more are joined by chunks of arrival numbers.
BROADCAST_RANGES = 20_000

#: Log positions per chunk where commits are ordered by them, as a power of two (twice as many as bytes of log).
POSITION_BITS = 24

_SESSION = ["slot", "session"]


def remove_replays(
    changes: DataFrame, sessions: DataFrame, held: DataFrame, chunk_bits: int = CHUNK_BITS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The new changes of a batch, and the ``sessions`` and ``held`` rows after it.

    ``changes`` are all decoded changes of the batch with their commit markers, which
    arrived after those of the batches before; ``sessions`` (see :data:`SESSIONS`) and
    ``held`` (like ``changes``) are what the batch before left, empty at first.  All
    batches together give what :func:`~cdclake.operators.reconcile.dedup_replays` gives
    on all changes, but for rows still held: their transaction is open, and whether it
    was stored before is not known.  Sessions must be numbered in order of arrival.
    """
    rows = changes.unionByName(held.select(*changes.columns))
    # Narrow rows, written once: they are read again where a transaction is cut in two.
    scanned = materialized(_transactions_of_rows(rows, chunk_bits), "positions")
    txns = (
        scanned.groupBy(*_SESSION, "txn")
        .agg(
            F.max("begin_lsn").alias("begin_lsn"),
            F.count(F.lit(1)).alias("n"),
            F.max(F.when(F.col("commit"), F.col("lsn"))).alias("commit_lsn"),
            F.max("seq").alias("last_seq"),
        )
        .transform(materialized, "transactions")
    )
    after = materialized(_sessions_after(txns, sessions), "sessions")
    begun = _with_begin(txns, after)
    elsewhere = materialized(_completed_elsewhere(begun, after), "completed")
    judged = materialized(_judged(begun, after, elsewhere), "judged")
    ranges = materialized(_ranges(judged, scanned), "ranges")
    known = ranges.agg(F.count("*").alias("all"), F.count_if("hold").alias("held")).first()
    kept = _outside(rows, ranges, known["all"], chunk_bits, "left_anti") if known["all"] else rows
    waiting = _outside(rows, ranges.filter("hold"), known["held"], chunk_bits, "left_semi") if known["held"] else held.limit(0)
    return kept.select(*changes.columns), _folded(after, judged, elsewhere), waiting.select(*changes.columns)


def _transactions_of_rows(rows: DataFrame, chunk_bits: int) -> DataFrame:
    """Positions of the rows, with ``txn`` (the ``seq`` their transaction begins with here), its first position and index."""
    positions = rows.select(*_SESSION, "seq", "lsn", (F.col("operation") == "commit").alias("commit"))
    counted = ordered_scan(
        positions, _SESSION, "seq",
        {"__ended": Running("lag", F.col("commit")), "idx": Running("sum", F.lit(1).cast("bigint"))}, chunk_bits,
    )
    begins = F.coalesce("__ended", F.lit(True))
    return ordered_scan(
        counted,
        _SESSION,
        "seq",
        {
            "txn": Running("last", F.when(begins, F.col("seq"))),
            "begin_lsn": Running("last", F.when(begins, F.col("lsn"))),
            "begin_idx": Running("max", F.when(begins, F.col("idx"))),
        },
        chunk_bits,
    ).drop("__ended")


def _sessions_after(txns: DataFrame, sessions: DataFrame) -> DataFrame:
    """Every known session after the batch; ``old_*`` is its open transaction before, ``tail_txn`` the open one here."""
    now = txns.groupBy(*_SESSION).agg(
        F.min("commit_lsn").alias("c_first"),
        F.max("commit_lsn").alias("c_last"),
        F.min("txn").alias("first_txn"),
        F.max_by(F.struct("txn", "begin_lsn", "n", "commit_lsn"), "txn").alias("tail"),
    )
    tail, here = F.col("tail"), F.col("tail").isNotNull()
    goes_on = F.col("open_drop").isNotNull() & here  # a held transaction is here as a whole
    same = goes_on & (tail["txn"] == F.col("first_txn"))
    ended = here & tail["commit_lsn"].isNotNull()

    def opened(before: str, own: Column, still: Column) -> Column:
        return F.when(ended, F.lit(None)).when(~here, F.col(before)).when(same, still).otherwise(own)

    return sessions.join(now, _SESSION, "full_outer").select(
        *_SESSION,
        F.coalesce("first_commit", "c_first").alias("first_commit"),
        F.coalesce("c_last", "last_commit").alias("last_commit"),
        opened("open_lsn", tail["begin_lsn"], F.col("open_lsn")).alias("open_lsn"),
        opened("open_rows", tail["n"], F.col("open_rows") + tail["n"]).alias("open_rows"),
        opened("open_drop", F.lit(None).cast("bigint"), F.col("open_drop")).alias("open_drop"),
        F.when(goes_on, F.col("first_txn")).alias("old_txn"),
        F.when(goes_on, F.col("open_lsn")).alias("old_lsn"),
        F.when(goes_on, F.col("open_rows")).alias("old_rows"),
        F.when(goes_on, F.col("open_drop")).alias("old_drop"),
        here.alias("here"),
    )


def _with_begin(txns: DataFrame, after: DataFrame) -> DataFrame:
    """Transactions; one that goes on from the batch before has its real first position and the rows sent before."""
    old = after.filter("old_txn IS NOT NULL").select(*_SESSION, F.col("old_txn").alias("txn"), "old_lsn", "old_rows", "old_drop")
    return txns.join(old, [*_SESSION, "txn"], "left").withColumn("begin_lsn", F.coalesce("old_lsn", "begin_lsn")).drop("old_lsn")


def _completed_elsewhere(begun: DataFrame, after: DataFrame) -> DataFrame:
    """Open transactions that another session completes in this batch: the commit, and the first session that has it."""
    ended = begun.filter("commit_lsn IS NOT NULL").select("slot", F.col("begin_lsn").alias("open_lsn"), F.col("session").alias("by"), "commit_lsn")
    opened = after.filter("open_lsn IS NOT NULL").select("slot", "session", "open_lsn")
    both = opened.join(ended, ["slot", "open_lsn"]).filter(F.col("by") != F.col("session"))
    return both.groupBy(*_SESSION).agg(F.min("commit_lsn").alias("else_commit"), F.min("by").alias("closed_by"), F.max("by").alias("last_by"))


def _first_cover(points: DataFrame, intervals: DataFrame, name: str) -> DataFrame:
    """``points`` (``slot, at``, each once) with ``name``: the first session that has an interval ``low`` to ``high`` around it.

    An interval is a few blocks of 2^k positions, and a point lies in one block of
    each size, so equal blocks meet and no point is compared with every interval.
    """
    def halved(value: Column) -> Column:
        return F.call_function("shiftright", value, F.col("__k"))

    below = -halved(-F.col("low"))  # the first block of its size that begins in the interval
    above = halved(F.col("high") + 1)  # the one after the last that ends in it
    ends = F.array(
        F.when((below < above) & (below % 2 != 0), below),
        F.when((below < above) & (above % 2 != 0), above - 1),
    )
    sizes = F.explode(F.sequence(F.lit(0), F.lit(62))).alias("__k")
    blocks = (
        intervals.filter("low <= high")
        .select("slot", "session", "low", "high", sizes)
        .select("slot", "session", "__k", F.explode(F.filter(ends, F.isnotnull)).alias("__block"))
        .groupBy("slot", "__k", "__block")
        .agg(F.min("session").alias(name))
    )
    asked = points.select("slot", "at", sizes).withColumn("__block", halved(F.col("at")))
    covered = asked.join(blocks, ["slot", "__k", "__block"]).groupBy("slot", "at").agg(F.min(name).alias(name))
    return points.join(covered, ["slot", "at"], "left")


def _replayed(txns: DataFrame, sent: DataFrame) -> DataFrame:
    """Transactions (``slot, session, txn, commit``) whose commit lies in an earlier session's interval; ``spread`` is the first such session.

    Which session is the first changes only where an interval begins or ends.  It is
    found there, and carried on to the commits along the positions.
    """
    bounds = sent.select("slot", F.explode(F.array(F.col("low"), F.col("high") + 1)).alias("at")).distinct()
    steps = _first_cover(bounds, sent, "spread").select(
        "slot", (F.col("at") * 2).alias("at"), F.coalesce("spread", F.lit(ALL)).alias("spread")
    )
    placed = txns.select(*_SESSION, "txn", (F.col("commit") * 2 + 1).alias("at"))
    both = placed.unionByName(steps, allowMissingColumns=True)
    found = ordered_scan(both, ["slot"], "at", {"first": Running("last", F.col("spread"))}, POSITION_BITS)
    return found.filter("session > first").select(*_SESSION, "txn", F.col("first").alias("spread"))


def _sent_before(begun: DataFrame, known: DataFrame) -> DataFrame:
    """Of transactions that an earlier session has open: the rows it has ``sent_before``, and whether these are ``sure`` to be stored."""
    parts = known.filter("open_lsn IS NOT NULL").select(
        *_SESSION,
        F.col("open_lsn").alias("begin_lsn"),
        F.when(F.col("open_drop") == ALL, F.lit(ALL)).otherwise(F.col("open_rows")).alias("rows"),
        F.col("open_drop").isNotNull().alias("certain"),
        "closed_by",
    )
    asked = begun.select(*_SESSION, "txn", "begin_lsn").join(parts.select("slot", "begin_lsn").distinct(), ["slot", "begin_lsn"], "left_semi")
    same = Window.partitionBy("slot", "begin_lsn")
    earlier = same.orderBy("session").rangeBetween(Window.unboundedPreceding, -1)
    found = asked.unionByName(parts, allowMissingColumns=True).select(
        *_SESSION,
        "txn",
        F.max("rows").over(earlier).alias("sent_before"),
        F.bool_and("certain").over(earlier).alias("sure"),
        F.min("closed_by").over(same).alias("closed_by"),
    )
    still_open = F.col("closed_by").isNull() | (F.col("closed_by") >= F.col("session"))
    return found.filter(F.col("txn").isNotNull() & F.col("sent_before").isNotNull() & still_open).drop("closed_by")


def _judged(begun: DataFrame, after: DataFrame, elsewhere: DataFrame) -> DataFrame:
    """Transactions with ``drop``: how many of their first rows are replays; null where that is not known yet.

    ``spread`` names the interval of commits that a whole replayed one lies in, by its session.
    """
    known = after.join(elsewhere, _SESSION, "left")
    sent = known.filter("first_commit IS NOT NULL").select(*_SESSION, F.col("first_commit").alias("low"), F.col("last_commit").alias("high"))
    before = Window.partitionBy("slot").orderBy("session").rowsBetween(Window.unboundedPreceding, -1)
    facts = known.select(
        *_SESSION,
        "here",
        "else_commit",
        F.col("last_commit").alias("at"),
        F.max("last_commit").over(before).alias("last_seen"),
        F.max("first_commit").over(before).alias("last_first"),
    ).filter("here")
    # Only an open transaction asks whether the commit before it lies inside of an earlier session's.
    asked = facts.filter("at IS NOT NULL").select("slot", "at").distinct()
    around = _first_cover(asked, sent.withColumn("high", F.col("high") - 1), "around")
    facts = facts.join(around, ["slot", "at"], "left").withColumnRenamed("at", "c_prev")

    open_here = F.col("commit_lsn").isNull()
    commit = F.when(open_here, F.col("else_commit")).otherwise(F.col("commit_lsn"))
    told = begun.join(facts, _SESSION).withColumn("commit", commit).transform(materialized, "told")
    replayed = _replayed(told.filter("commit IS NOT NULL"), sent)
    full = told.join(replayed, [*_SESSION, "txn"], "left").join(_sent_before(begun, known), [*_SESSION, "txn"], "left")

    c_prev, last_seen = F.col("c_prev"), F.col("last_seen")
    sent_before, sure = F.coalesce("sent_before", F.lit(0)), F.coalesce("sure", F.lit(False))
    open_drop = (
        F.when(last_seen.isNull() | (F.col("begin_lsn") > last_seen), sent_before)
        .when(F.col("around") < F.col("session"), F.lit(ALL))
        .when(c_prev.isNotNull() & (F.col("last_first") <= c_prev), sent_before)
        .when(sure, sent_before)
    )
    known_drop = F.when(F.col("spread").isNotNull(), F.lit(ALL)).otherwise(sent_before)
    return full.select(
        *_SESSION,
        "txn",
        "last_seq",
        "n",
        open_here.alias("open"),
        F.coalesce("old_rows", F.lit(0)).alias("before"),
        F.when(F.col("old_drop").isNotNull(), F.col("old_drop")).when(F.col("commit").isNotNull(), known_drop).otherwise(open_drop).alias("drop"),
        F.when(~open_here & F.col("old_drop").isNull(), F.col("spread")).alias("spread"),
    )


def _ranges(judged: DataFrame, scanned: DataFrame) -> DataFrame:
    """Arrival numbers ``low`` to ``high`` of a slot whose rows are not new, or are held.

    Replayed transactions whose commits lie in one interval stand together in their
    session, so there is a range per session and interval, not one per transaction.
    """
    here = F.least(F.col("n"), F.greatest(F.col("drop") - F.col("before"), F.lit(0)))
    counted = judged.withColumn("here", here)
    whole = (
        counted.filter("here = n")
        .groupBy(*_SESSION, "spread", F.when(F.col("spread").isNull(), F.col("txn")).alias("__own"))
        .agg(F.min("txn").alias("low"), F.max("last_seq").alias("high"))
    )
    held = counted.filter("drop IS NULL").select("slot", F.col("txn").alias("low"), F.col("last_seq").alias("high"), F.lit(True).alias("hold"))
    out = whole.select("slot", "low", "high", F.lit(False).alias("hold")).unionByName(held)
    # A transaction of which an earlier session sent the first rows: where these end. Few, one per session left open.
    cut = counted.filter("here > 0 AND here < n").select(*_SESSION, "txn", "here")
    if not cut.isEmpty():
        ends = scanned.join(cut, [*_SESSION, "txn"]).filter(F.col("idx") - F.col("begin_idx") == F.col("here") - 1)
        out = out.unionByName(ends.select("slot", F.col("txn").alias("low"), F.col("seq").alias("high"), F.lit(False).alias("hold")))
    return out


def _outside(rows: DataFrame, ranges: DataFrame, number: int, chunk_bits: int, how: str) -> DataFrame:
    """Rows outside (``left_anti``) or inside (``left_semi``) of the ranges of their slot."""
    r = ranges.select(F.col("slot").alias("__slot"), "low", "high")
    inside = [rows["slot"] == F.col("__slot"), rows["seq"].between(F.col("low"), F.col("high"))]
    if number <= BROADCAST_RANGES:
        return rows.join(F.broadcast(r), reduce(Column.__and__, inside), how)
    pieces = r.withColumn("__chunk", F.explode(F.sequence(chunk_of(F.col("low"), chunk_bits), chunk_of(F.col("high"), chunk_bits))))
    return rows.join(pieces, reduce(Column.__and__, [*inside, chunk_of(rows["seq"], chunk_bits) == F.col("__chunk")]), how)


def _folded(after: DataFrame, judged: DataFrame, elsewhere: DataFrame) -> DataFrame:
    """The sessions to remember: verdicts on open transactions added, past ones without an open one merged.

    Intervals of past sessions that overlap are one; it has the number of the last of them.
    """
    verdicts = judged.filter("open").select(*_SESSION, F.col("drop").alias("__drop"))
    closed = elsewhere.filter("last_by > session").select(*_SESSION, F.lit(True).alias("__closed"))
    rows = after.join(verdicts, _SESSION, "left").join(closed, _SESSION, "left")

    def still(column: Column) -> Column:
        return F.when(F.col("__closed").isNull(), column)

    rows = rows.select(
        *_SESSION, "first_commit", "last_commit",
        still(F.col("open_lsn")).alias("open_lsn"), still(F.col("open_rows")).alias("open_rows"),
        still(F.coalesce("open_drop", "__drop")).alias("open_drop"),
        F.max("session").over(Window.partitionBy("slot")).alias("__newest"),
    )
    rows = materialized(rows, "sessions-after")
    past = (F.col("session") < F.col("__newest")) & F.col("open_lsn").isNull()
    by_first = Window.partitionBy("slot").orderBy("first_commit", "session")
    reached = F.max("last_commit").over(by_first.rowsBetween(Window.unboundedPreceding, -1))
    islands = (
        rows.filter(past & F.col("first_commit").isNotNull())
        .withColumn("__new", F.when(F.col("first_commit") <= reached, 0).otherwise(1))
        .withColumn("__island", F.sum("__new").over(by_first))
        .groupBy("slot", "__island")
        .agg(F.max("session").alias("session"), F.min("first_commit").alias("first_commit"), F.max("last_commit").alias("last_commit"))
        .select(*_SESSION, "first_commit", "last_commit")
    )
    nothing = F.lit(None).cast("bigint")
    merged = islands.select("*", *[nothing.alias(c) for c in ("open_lsn", "open_rows", "open_drop")])
    return rows.filter(~past).select(*SESSIONS.fieldNames()).unionByName(merged.select(*SESSIONS.fieldNames()))
