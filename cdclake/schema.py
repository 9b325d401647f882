"""Schemas of the tables the jobs read and write."""

from pyspark.sql import types as T

#: One cell of a row tuple.  ``kind`` is ``n`` (null), ``u`` (unchanged TOAST),
#: ``t`` (text) or ``b`` (binary, of which only the size is landed).
CELL = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_bytes", T.IntegerType()),
    ]
)
TUPLE = T.ArrayType(CELL)

COLUMNS = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("type_oid", T.LongType()),
        ]
    )
)

#: A landed replication message; see README, "Landing contract".
MESSAGE = T.StructType(
    [
        T.StructField("slot", T.StringType()),
        T.StructField("session", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("wal_start", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("relation_id", T.LongType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("relation_name", T.StringType()),
        T.StructField("columns", COLUMNS),
        T.StructField("old_type", T.StringType()),
        T.StructField("old_tuple", TUPLE),
        T.StructField("new_tuple", TUPLE),
        T.StructField("xid", T.LongType()),
        T.StructField("commit_time", T.TimestampType()),
        T.StructField("end_lsn", T.LongType()),
        T.StructField("received_at", T.TimestampType()),
    ]
)

#: The seven file columns every reader of the lake may rely on, in order.
FILE_COLUMNS = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("operation", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("lsn", T.LongType(), False),
        T.StructField("before", T.StringType()),
        T.StructField("after", T.StringType()),
        T.StructField("commit_time", T.TimestampType(), False),
    ]
)

#: A change row: the file columns, then where the change came from.
CHANGE = T.StructType(
    FILE_COLUMNS.fields
    + [
        T.StructField("slot", T.StringType()),
        T.StructField("session", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("relation_id", T.LongType()),
        T.StructField("namespace", T.StringType()),
    ]
)

#: Partition columns of the lake.
PARTITIONS = T.StructType(
    [
        T.StructField("commit_date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

#: One half-open range of event positions that is written as one unit.
SEGMENT = T.StructType(
    [
        T.StructField("slot", T.StringType()),
        T.StructField("start_idx", T.LongType()),
        T.StructField("end_idx", T.LongType()),
        T.StructField("done", T.BooleanType()),
        T.StructField("last_lsn", T.LongType()),
        T.StructField("cut_at", T.TimestampType()),
        T.StructField("done_at", T.TimestampType()),
    ]
)

#: One sample of a slot's delivery state.
PROGRESS = T.StructType(
    [
        T.StructField("slot", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("streaming", T.BooleanType()),
        T.StructField("blocked_since", T.TimestampType()),
        T.StructField("write_idx", T.LongType()),
        T.StructField("read_idx", T.LongType()),
        T.StructField("acked_lsn", T.LongType()),
    ]
)
