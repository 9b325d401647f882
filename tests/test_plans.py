"""The physical plans keep the properties the jobs are designed for."""

import re

import pytest
from cdclake.operators import decode as decoding
from cdclake.operators import planning, progress, reconcile
from cdclake.operators.decode import decode
from cdclake.operators.filters import filter_changes, not_commit
from cdclake.operators.metrics import event_counts
from cdclake.plans import synth
from cdclake.plans.queries import QUERIES
from cdclake.schema import CHANGE, SEGMENT
from cdclake.sources.messages import read_messages
from tests import history, oracle


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing") / "m")
    history.frame(spark, history.random_history(1, txns=5)).write.parquet(path)
    return read_messages(spark, path)


def test_decode_shuffles_tuples_once_and_broadcasts_nothing(spark, messages):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(filter_changes(decode(messages), not_commit()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text and "Python" not in text and "Cartesian" not in text
    # Only the shuffle by slot and chunk sits above a scan that reads tuples.
    assert len(re.findall(r"ReadSchema: struct<[^\n]*old_tuple", text)) == 1
    assert not re.search(r"Exchange (SinglePartition|rangepartitioning)", text)


def test_counts_do_not_read_tuples(spark, messages):
    text = plan(event_counts(decode(messages)))
    assert "tuple" not in text


def test_kind_filter_reaches_the_files(spark, messages):
    assert "PushedFilters: [In(kind" in plan(decode(messages))


#: Keys that may hold any share of the rows.
COARSE = {"slot", "session", "relation_id", "commit", "file", "namespace"}


def coarse(line):
    """Whether a plan's line is a shuffle by coarse keys alone."""
    m = re.search(r"Exchange hashpartitioning\((.*?), \d+\)", line)
    return bool(m) and {re.sub(r"#\d+L?$", "", k.strip()) for k in m[1].split(",")} <= COARSE


def gathered(text):
    """What feeds each shuffle by coarse keys: the first scan, aggregation or finer shuffle below it."""
    lines = text.splitlines()
    source = re.compile(r"Aggregate\(keys|Scan|Exchange")
    return [
        next(x for x in lines[i + 1 :] if source.search(x) and not coarse(x)) for i, line in enumerate(lines) if coarse(line)
    ]


@pytest.mark.parametrize("name", ["decode", "manifest", "runs", "ticks", "restart", "restart_per_slot", "prefix", "history", "replays", "order"])
def test_only_rows_of_blocks_are_gathered_by_slot(spark, messages, joins_shuffle, name):
    changes, ledger = decode(messages), spark.createDataFrame([], SEGMENT)
    acked = spark.createDataFrame([("s", 1)], "slot string, acked_lsn bigint")
    df = {
        "decode": lambda: changes,
        "manifest": lambda: planning.file_manifest(changes, "ns", 100),
        "runs": lambda: planning.day_runs(changes, 100),
        "ticks": lambda: planning.segments_by_interval(changes),
        "restart": lambda: progress.safe_restart(messages, 5),
        "restart_per_slot": lambda: progress.safe_restart(messages, acked),
        "prefix": lambda: progress.contiguous_prefix(ledger),
        "history": lambda: progress.acked_history(ledger, "last_lsn"),
        "replays": lambda: reconcile.dedup_replays(changes),
        "order": lambda: reconcile.order_breaks(messages.withColumn("timestamp", messages.received_at).withColumn("lsn", messages.wal_start)),
    }[name]()
    text = plan(df)
    assert "SinglePartition" not in text and "Python" not in text
    for feeding in gathered(text):
        # The constants of a slot are a table of one row per slot.
        assert "__block" in feeding or "__chunk" in feeding or "LocalTableScan" in feeding or "ExistingRDD" in feeding or "keys=[slot" in feeding, feeding


def test_a_description_joins_the_chunk_it_stands_in(spark, messages, joins_shuffle):
    # No join is keyed on a description that many chunks share: the key is its own position.
    text = plan(decode(messages))
    joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[(.*?)\], \[", text)
    assert joins and all("described_at" not in keys for keys in joins)
    assert any("last_relation" in keys for keys in joins)


def wide_shuffles(df, column):
    """Number of shuffles that carry a column."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return sum(f"{column}#" in inputs for inputs in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\n", text))


@pytest.fixture
def joins_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_wide_rows_are_shuffled_once(spark, messages, joins_shuffle):
    assert wide_shuffles(decode(messages), "new_tuple") == 1
    assert wide_shuffles(progress.safe_restart(messages, 5), "new_tuple") == 1
    stored = spark.createDataFrame([], CHANGE)
    assert wide_shuffles(reconcile.dedup_replays(stored), "after") == 1


def test_rows_land_without_a_shuffle(spark, joins_shuffle):
    assert wide_shuffles(synth.event_messages(spark, str(oracle.DATA)), "props") == 0


def test_missing_changes_makes_images_once(spark):
    assert "new_tuple" not in plan(QUERIES["missing_changes"](spark, str(oracle.DATA)))


def test_partitions_of_decode_follow_the_messages(spark, messages, monkeypatch):
    # A fixed number of them lets the memory of a task grow with the input.
    rows = sorted(map(str, decode(messages).collect()))
    monkeypatch.setattr(decoding, "TASK_MESSAGES", 5)
    changes, tasks = decode(messages, chunk_bits=2), -(-messages.count() // 5)
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = [x for x in plan(changes).splitlines() if "Exchange hashpartitioning(slot" in x and "__chunk" in x and f", {tasks})" in x]
    assert len(wide) == 1 and sorted(map(str, changes.collect())) == rows


def test_days_are_sorted_without_their_images(spark, monkeypatch):
    # Each day is sorted by one task, whose memory grows with the day.
    seen = []
    monkeypatch.setattr(reconcile, "order_breaks", lambda rows: seen.append(rows.columns) or rows.limit(0))
    QUERIES["order_breaks"](spark, str(oracle.DATA))
    assert seen and not {"before", "after"} & set(seen[0])


def test_compacted_days_decodes_once(spark, monkeypatch):
    class Written(Exception):
        pass

    def write(changes, *args, **options):
        assert "new_tuple" not in plan(changes)
        raise Written

    monkeypatch.setattr("cdclake.sources.lake.write_changes", write)
    with pytest.raises(Written):
        QUERIES["compacted_days"](spark, str(oracle.DATA))
