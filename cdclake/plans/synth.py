"""Messages and ledgers derived from the driver tables.

``events`` becomes the message stream of one slot, with transactions, sessions
that replay the end of the session before, relation messages, rollbacks and the
rarer message kinds.  The rules are simple functions of ``event_id``, so expected
results can be computed from ``events`` in SQL without decoding anything:

* transaction = ``event_id div 5``; every 97th (rest 13) is rolled back, so none
  of its messages is landed; transaction 0 is landed without its begin message;
* session ``s`` sends transactions ``100 s - 20`` to ``100 s + 99``, so the last 20
  transactions of each session are replayed by the next;
* relation = ``16384 + user_id % 12``; all but the last are described at the start
  of each session, and relation 16387 again with one more column before the
  session's transaction ``100 s + 40``;
* signup and purchase insert, click updates with the old key, view updates with
  the old row, error deletes with the old row;
* row position = ``16777216 + 120 * event_id``, but all rows of every tenth
  transaction (rest 3) share the position of its first row, as a bulk load does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions.positions import utc_timestamp
from cdclake.schema import MESSAGE

SLOT = "main"
ROWS_PER_TXN = 5
TXNS_PER_SESSION = 100
REPLAYED_TXNS = 20
SEQ_PER_TXN = 32  # begin at 0, relations 1-12, others 14, rows from 16, commit 31

#: Columns of every events relation, by position: name and source type id.
EVENT_COLUMNS = (
    ("id", 20),
    ("user_id", 23),
    ("event_type", 25),
    ("value", 1700),
    ("is_error", 16),
    ("score", 701),
    ("props", 3802),
    ("created_on", 1082),
    ("note", 25),
)
EXTRA_COLUMN = ("extra", 23)
EXTRA_RELATION = 16387
FIRST_RELATION = 16384
RELATIONS = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_cell(text: Column) -> Column:
    return cell(F.lit("t"), text)


def cell(kind: Column, text: Column | None = None, n_bytes: Column | None = None) -> Column:
    return F.struct(
        kind.alias("kind"),
        (F.lit(None).cast("string") if text is None else text.cast("string")).alias("text"),
        (F.lit(None).cast("int") if n_bytes is None else n_bytes.cast("int")).alias("n_bytes"),
    )


def column_list(columns) -> Column:
    return F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(oid).cast("bigint").alias("type_oid")) for n, oid in columns]
    )


def fields(**given: Column) -> list[Column]:
    """The columns of a message; those that are not given are null."""
    return [(given[f.name] if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in MESSAGE.fields]


def message(**given: Column) -> Column:
    """A message struct; fields that are not given are null."""
    return F.struct(*fields(**given))


def _event_cells() -> dict[str, Column]:
    e = F.col("event_id")
    digits = F.format_string("%09d", e)
    cents = F.col("value").cast("decimal(18,2)").cast("string")
    note = (
        F.when(e % 4 == 0, cell(F.lit("n")))
        .when(e % 4 == 1, cell(F.lit("u")))
        .when(e % 4 == 2, cell(F.lit("b"), n_bytes=e % 100))
        .otherwise(text_cell(F.concat(F.lit('n"'), e, F.lit("\\"))))
    )
    return {
        "id": text_cell(e),
        "user_id": text_cell(F.col("user_id")),
        "event_type": text_cell(F.col("event_type")),
        # More digits than a double holds, trailing zeros included.
        "value": text_cell(F.concat(F.lit("9007199254740"), digits, F.lit("."), F.substring_index(cents, ".", -1))),
        "is_error": text_cell(F.when(F.col("event_type") == "error", "t").otherwise("f")),
        "score": text_cell(F.when(e % 50 == 0, "NaN").otherwise(F.concat(e % 1000, F.lit(".5")))),
        "props": text_cell(F.col("props")),
        "created_on": text_cell(F.substring(F.col("ts").cast("string"), 1, 10)),
        "note": note,
        "extra": text_cell(e % 7),
    }


def rolled_back() -> Column:
    """Whether a transaction was rolled back."""
    return F.col("txn") % 97 == 13


def event_messages(spark: SparkSession, sf_dir: str, leak: bool = False) -> DataFrame:
    """The ``events`` table as landed messages.

    ``leak`` also lands what was rolled back, a fault the checks must find.

    Rows come straight from the events, without a shuffle; the messages around them
    come from a row per transaction.
    """
    e = F.col("event_id")
    txn = F.floor(e / ROWS_PER_TXN).cast("bigint")
    events = table(spark, sf_dir, "events").withColumn("txn", txn)
    per_txn = events.groupBy("txn").agg(
        F.max("ts").alias("commit_ts"),
        F.min("ts").alias("begin_ts"),
        F.max("event_id").alias("last_event"),
        F.min_by("user_id", "event_id").alias("first_user"),
        (F.min("event_id") % ROWS_PER_TXN == 0).alias("begins"),
    )
    home = F.floor(F.col("txn") / TXNS_PER_SESSION).cast("bigint")
    replayed = F.col("txn") % TXNS_PER_SESSION >= TXNS_PER_SESSION - REPLAYED_TXNS

    def sent(rows: DataFrame) -> DataFrame:
        sessions = F.explode(F.when(replayed, F.array(home, home + 1)).otherwise(F.array(home)))
        return rows.withColumn("session", sessions).withColumn("at", F.col("txn") - TXNS_PER_SESSION * F.col("session"))

    session, at = F.col("session"), F.col("at")
    base = (session * (TXNS_PER_SESSION + REPLAYED_TXNS) + at + REPLAYED_TXNS) * SEQ_PER_TXN
    delay = F.when(at < 0, F.expr("INTERVAL 65 SECONDS")).otherwise(F.expr("INTERVAL 5 SECONDS"))

    def received(ts: str) -> Column:
        return utc_timestamp(F.col(ts)) + delay

    def lsn(event: Column) -> Column:
        return F.lit(16777216) + event * 120

    def relation(user: str) -> Column:
        return F.lit(FIRST_RELATION) + F.col(user) % RELATIONS

    landed = F.lit(True) if leak else ~rolled_back()
    common = {"slot": F.lit(SLOT), "session": session}

    # The cells are a column of their own, so that they are made once a row.
    cells = _event_cells()
    names = [n for n, _ in EVENT_COLUMNS]
    null_cell = cell(F.lit("n"))
    full, note_at = F.col("full"), names.index("note")
    with_note = F.concat(
        F.transform(F.array(*[cells[n]["text"] for n in names[:note_at]]), text_cell),
        F.array(cells["note"]),
        F.transform(
            F.when(relation("user_id") == EXTRA_RELATION, F.array(cells["extra"]["text"])).otherwise(F.array().cast("array<string>")),
            text_cell,
        ),
    )
    old_full = F.concat(F.slice(full, 1, note_at), F.array(null_cell), F.slice(full, note_at + 2, 1))
    old_key = F.concat(F.slice(full, 1, 1), F.array_repeat(null_cell, len(names) - 1))
    kind_of = F.col("event_type")
    kind = F.when(kind_of.isin("signup", "purchase"), "I").when(kind_of == "error", "D").otherwise("U")
    old_type = F.when(kind_of == "click", "K").when(kind_of.isin("view", "error"), "O")

    rows = sent(events.filter(landed).withColumn("full", with_note)).select(
        *fields(
            **common,
            seq=base + 16 + e % ROWS_PER_TXN,
            wal_start=F.when(F.col("txn") % 10 == 3, lsn(F.col("txn") * ROWS_PER_TXN)).otherwise(lsn(e)),
            kind=kind,
            relation_id=relation("user_id"),
            old_type=old_type,
            old_tuple=F.when(old_type == "K", old_key).when(old_type == "O", old_full),
            new_tuple=F.when(kind != "D", full),
            received_at=received("ts"),
        )
    )

    transactions, commit_time = sent(per_txn), utc_timestamp(F.col("commit_ts"))
    first_lsn = lsn(F.col("txn") * ROWS_PER_TXN)
    around = transactions.filter(landed)
    begins = around.filter(F.col("begins") & (F.col("txn") > 0)).select(
        *fields(
            **common,
            seq=base,
            wal_start=first_lsn,
            kind=F.lit("B"),
            xid=F.col("txn"),
            commit_time=commit_time,
            received_at=received("begin_ts"),
        )
    )
    commits = around.select(
        *fields(
            **common,
            seq=base + SEQ_PER_TXN - 1,
            wal_start=lsn(F.col("last_event")),
            kind=F.lit("C"),
            commit_time=commit_time,
            end_lsn=lsn(F.col("last_event") + 1),
            received_at=received("commit_ts"),
        )
    )
    others = around.filter(F.col("begins") & (F.col("txn") % 50).isin(7, 9)).select(
        *fields(
            **common,
            seq=base + 14,
            wal_start=first_lsn,
            kind=F.when(F.col("txn") % 50 == 7, "T").otherwise("Y"),
            relation_id=relation("first_user"),
            received_at=received("begin_ts"),
        )
    )

    # Relation messages come between transactions' begin and rows, and also where
    # the transaction itself was rolled back.
    session_start = (at == -REPLAYED_TXNS) | ((session == 0) & (at == 0))
    number = F.when(session_start, F.sequence(F.lit(0), F.lit(RELATIONS - 2))).when(
        at == 40, F.array(F.lit(EXTRA_RELATION - FIRST_RELATION))
    )
    number_of = F.col("number")
    relations = (
        transactions.filter("begins")
        .withColumn("number", F.explode(number))
        .select(
            *fields(
                **common,
                seq=base + 1 + F.when(session_start, number_of).otherwise(0),
                wal_start=F.lit(0),
                kind=F.lit("R"),
                relation_id=F.lit(FIRST_RELATION) + number_of,
                namespace=F.lit("public"),
                relation_name=F.format_string("table_%02d", number_of),
                columns=F.when(session_start, column_list(EVENT_COLUMNS)).otherwise(
                    column_list((*EVENT_COLUMNS, EXTRA_COLUMN))
                ),
                received_at=received("begin_ts"),
            )
        )
    )
    return rows.unionByName(begins).unionByName(commits).unionByName(others).unionByName(relations)


#: Columns of the bulk-load relation built from ``lineitem``.
LINEITEM_COLUMNS = (
    ("orderkey", 20),
    ("partkey", 23),
    ("suppkey", 21),
    ("linenumber", 23),
    ("quantity", 700),
    ("extendedprice", 1700),
    ("discount", 701),
    ("tax", 1700),
    ("returnflag", 1042),
    ("is_open", 16),
    ("shipdate", 1082),
)


def lineitem_messages(spark: SparkSession, sf_dir: str, seq: Column | None = None) -> DataFrame:
    """``lineitem`` as one bulk load: a relation, a begin and one insert per row.

    All rows are in one transaction, so their order among each other does not
    matter; ``seq`` places them (by order and line number unless given).
    """
    money = "decimal(18,2)"
    cells = [
        text_cell(F.col("l_orderkey")),
        text_cell(F.concat(F.lit("+"), F.col("l_partkey"))),
        text_cell(F.format_string("%06d", F.col("l_suppkey"))),
        text_cell(F.col("l_linenumber")),
        text_cell(F.col("l_quantity").cast(money)),
        text_cell(F.col("l_extendedprice").cast(money)),
        text_cell(F.when(F.col("l_discount") == 0, "-Infinity").otherwise(F.col("l_discount").cast(money).cast("string"))),
        text_cell(F.when(F.col("l_tax") == 0, "NaN").otherwise(F.col("l_tax").cast(money).cast("string"))),
        text_cell(F.concat(F.col("l_returnflag"), F.lit("\t"))),
        text_cell(F.when(F.col("l_linestatus") == "O", "t").otherwise("f")),
        text_cell(F.substring(F.col("l_shipdate").cast("string"), 1, 10)),
    ]
    shipped = utc_timestamp(F.col("l_shipdate"))
    order_line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(
        message(
            slot=F.lit("bulk"),
            session=F.lit(1),
            seq=F.lit(2) + (order_line if seq is None else seq),
            wal_start=F.lit(16777216),
            kind=F.lit("I"),
            relation_id=F.lit(16500),
            new_tuple=F.array(*cells),
            received_at=shipped,
        ).alias("m")
    )
    loaded_at = F.lit("1999-12-31 23:59:59Z").cast("timestamp")
    head = spark.range(1).select(
        F.inline(
            F.array(
                message(
                    slot=F.lit("bulk"),
                    session=F.lit(1),
                    seq=F.lit(0),
                    wal_start=F.lit(16777216),
                    kind=F.lit("B"),
                    xid=F.lit(1),
                    commit_time=loaded_at,
                    received_at=loaded_at,
                ),
                message(
                    slot=F.lit("bulk"),
                    session=F.lit(1),
                    seq=F.lit(1),
                    wal_start=F.lit(0),
                    kind=F.lit("R"),
                    relation_id=F.lit(16500),
                    namespace=F.lit("public"),
                    relation_name=F.lit("lineitem"),
                    columns=column_list(LINEITEM_COLUMNS),
                    received_at=loaded_at,
                ),
            )
        )
    )
    return rows.select("m.*").unionByName(head)


def segment_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four slots' segments of ten events each, one per row of ``events``.

    Errors are unfinished from some position on, slot ``s2`` lost its first
    segment and slot ``s3`` its segment 150.
    """
    e = F.col("event_id")
    slot = e % 4
    index = F.floor(e / 4).cast("bigint")
    at = utc_timestamp(F.col("ts"))
    done = (F.col("event_type") != "error") | (index < 100 + 25 * slot)
    return (
        table(spark, sf_dir, "events")
        .filter(~((slot == 2) & (index == 0)) & ~((slot == 3) & (index == 150)))
        .select(
            F.concat(F.lit("s"), slot).alias("slot"),
            (index * 10).alias("start_idx"),
            (index * 10 + 10).alias("end_idx"),
            done.alias("done"),
            (F.lit(16777216) + (e * 7919) % 100_003).alias("last_lsn"),
            at.alias("cut_at"),
            F.when(done, at + F.expr("INTERVAL 2 SECONDS")).alias("done_at"),
        )
    )


def progress_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of twenty slots, one per row of ``events``; some positions go back."""
    e = F.col("event_id")
    slot = F.format_string("p%02d", F.col("user_id") % 20)
    at = utc_timestamp(F.col("ts"))
    blocked = F.timestamp_micros(F.unix_micros(at) - (F.col("user_id") % 120) * 1_000_000)
    return table(spark, sf_dir, "events").select(
        slot.alias("slot"),
        at.alias("at"),
        (F.col("event_type") != "error").alias("streaming"),
        F.when(F.col("event_type") == "click", blocked).alias("blocked_since"),
        (e * 3 + F.col("user_id")).alias("write_idx"),
        (e * 3).alias("read_idx"),
        (F.lit(16777216) + e * 120 - F.when(e % 50 == 0, 10_000).otherwise(0)).alias("acked_lsn"),
    )


def committed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the source committed, as ``operation, id, event_type, value``.

    Rows of the relation that is never described are left out: their images are
    empty, so nothing could be compared.
    """
    e, kind = F.col("event_id"), F.col("event_type")
    cells = _event_cells()
    return (
        table(spark, sf_dir, "events")
        .withColumn("txn", F.floor(e / ROWS_PER_TXN))
        .filter(~rolled_back() & (F.col("user_id") % RELATIONS < RELATIONS - 1))
        .select(
            F.when(kind.isin("signup", "purchase"), "insert")
            .when(kind == "error", "delete")
            .otherwise("update")
            .alias("operation"),
            e.alias("id"),
            "event_type",
            cells["value"]["text"].cast("decimal(38,2)").alias("value"),
        )
    )


def rolled_back_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that were only in rolled-back transactions."""
    e = F.col("event_id")
    return (
        table(spark, sf_dir, "events")
        .withColumn("txn", F.floor(e / ROWS_PER_TXN))
        .filter(rolled_back())
        .select(e.alias("id"))
    )
