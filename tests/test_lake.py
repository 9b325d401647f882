import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.operators import metrics, reconcile
from cdclake.operators.decode import decode
from cdclake.operators.filters import filter_changes, not_commit
from cdclake.schema import CHANGE, FILE_COLUMNS
from cdclake.sources import lake
from tests import history

UTC = dt.timezone.utc
BASE = dt.datetime(2026, 5, 9, 10, tzinfo=UTC)


def mixed_changes(spark, n, days=1):
    """Changes over twelve tables; commit time unset in every tenth."""
    rows = []
    for i in range(n):
        op = ("insert", "update", "delete")[i % 3]
        full = f'{{"id":{i},"note":"n{i}","status":"ok"}}'
        before = {"insert": None, "update": f'{{"id":{i},"status":"new"}}', "delete": full}[op]
        at = BASE + dt.timedelta(milliseconds=i, days=i * days // n)
        rows.append(
            (f"table_{i % 12:02d}", op, at, 0x1000000 + 120 * i, before, None if op == "delete" else full,
             None if i % 10 == 0 else at, "s", 1, i, 7, "public")
        )
    return spark.createDataFrame(rows, T.StructType([T.StructField(f.name, f.dataType) for f in CHANGE.fields]))


def rows_of(df):
    """Comparable rows; times as microseconds, since an unset one is before Python's."""
    times = [F.unix_micros(c).alias(c) if c in ("timestamp", "commit_time") else c for c in CHANGE.fieldNames()]
    return sorted((tuple(r) for r in df.select(*times).collect()), key=repr)


def files(root):
    return sorted(str(p) for p in Path(root).rglob("*.parquet") if "_commits" not in p.parts)


def test_round_trip(spark, tmp_path):
    changes = mixed_changes(spark, 1000, days=3)
    lake.write_changes(changes, str(tmp_path), "ns", load=1)
    back = lake.read_changes(spark, str(tmp_path), "ns")
    stored = changes.withColumn("commit_time", F.coalesce("commit_time", F.timestamp_micros(F.lit(-62135596800000000))))
    assert rows_of(back) == rows_of(stored)
    assert reconcile.misplaced_rows(back).count() == 0
    assert reconcile.mixed_day_files(back).count() == 0
    assert reconcile.order_breaks(back).count() == 0
    assert reconcile.conservation(changes, back).count() == 0
    assert back.filter("operation = 'delete' AND after IS NOT NULL").count() == 0
    stats = metrics.file_stats(back).collect()
    assert sum(r.rows for r in stats) == 1000
    assert all(r.bytes > 0 and r.bytes_per_row > 0 and r.ratio > 0 for r in stats)


def test_file_format(spark, tmp_path):
    lake.write_changes(mixed_changes(spark, 3000).coalesce(1), str(tmp_path), "ns", load=1, max_records_per_file=1000)
    written = files(tmp_path)
    assert len(written) == 3 and all(".zstd.parquet" in f for f in written)
    meta = pq.ParquetFile(written[0]).metadata
    assert meta.schema.names[:7] == FILE_COLUMNS.fieldNames()
    columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(7)}
    for name, column in columns.items():
        assert column.compression == "ZSTD"
        assert column.has_dictionary_page == (name in ("table", "operation"))
        assert column.is_stats_set == (name not in ("before", "after"))
    for name in ("timestamp", "lsn", "commit_time"):
        assert "DELTA_BINARY_PACKED" in columns[name].encodings
    kinds = {c.name: c for c in pq.ParquetFile(written[0]).schema}
    assert str(kinds["timestamp"].logical_type).startswith("Timestamp(isAdjustedToUTC=true, timeUnit=microseconds")


def test_writing_a_batch_again_replaces_only_that_batch(spark, tmp_path):
    first, second = mixed_changes(spark, 30), mixed_changes(spark, 60).filter("seq >= 30")
    lake.write_changes(first, str(tmp_path), "ns", load=1)
    lake.write_changes(second, str(tmp_path), "ns", load=2)
    lake.write_changes(second, str(tmp_path), "ns", load=2, replace=True)
    back = lake.read_changes(spark, str(tmp_path), "ns")
    assert sorted(r.seq for r in back.select("seq").collect()) == list(range(60))


def test_nothing_to_write_gives_no_file(spark, tmp_path):
    lake.write_changes(mixed_changes(spark, 10).filter("seq < 0"), str(tmp_path), "ns", load=1)
    assert files(tmp_path) == []


def test_unset_commit_time_is_filed_by_decode_day(spark, tmp_path):
    lake.write_changes(mixed_changes(spark, 1), str(tmp_path), "ns", load=1)
    (row,) = lake.read_changes(spark, str(tmp_path), "ns").withColumn(
        "us", F.unix_micros("commit_time")
    ).drop("commit_time").collect()
    assert str(row.commit_date) == "2026-05-09"
    assert row.us == -62135596800000000


def test_day_range_reads_only_its_folders(spark, tmp_path):
    lake.write_changes(mixed_changes(spark, 300, days=3), str(tmp_path), "ns", load=1)
    middle = lake.read_changes(spark, str(tmp_path), "ns", "2026-05-10", "2026-05-10")
    assert {str(r[0]) for r in middle.select("commit_date").distinct().collect()} == {"2026-05-10"}
    assert all("commit_date=2026-05-10" in f for f in middle.inputFiles())
    open_end = lake.read_changes(spark, str(tmp_path), "ns", first_day="2026-05-11")
    assert open_end.count() == 100
    plan = open_end._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(commit_date" in plan
    assert lake.read_changes(spark, str(tmp_path), "ns", "2030-01-01", "2030-01-02").count() == 0
    with pytest.raises(FileNotFoundError):
        lake.read_changes(spark, str(tmp_path), "other", "2026-05-10", "2026-05-10")


def test_row_filters_reach_the_files(spark, tmp_path):
    lake.write_changes(mixed_changes(spark, 30), str(tmp_path), "ns", load=1)
    df = lake.read_changes(spark, str(tmp_path), "ns").filter("`table` = 'table_01' AND lsn > 5").select("lsn")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(table,table_01)" in plan and "GreaterThan(lsn,5)" in plan
    assert "ReadSchema: struct<table:string,lsn:bigint>" in plan


def test_a_load_is_never_replaced_by_chance(spark, tmp_path):
    lake.write_changes(mixed_changes(spark, 30), str(tmp_path), "ns", load=1)
    with pytest.raises(ValueError, match="already"):
        lake.write_changes(mixed_changes(spark, 5), str(tmp_path), "ns", load=1)
    with pytest.raises(ValueError, match="from 1"):
        lake.write_changes(mixed_changes(spark, 5), str(tmp_path), "ns", load=0)
    lake.write_changes(mixed_changes(spark, 30), str(tmp_path), "other", load=1)
    assert lake.read_changes(spark, str(tmp_path), "ns").count() == 30


def test_a_load_with_fewer_days_leaves_no_old_day(spark, tmp_path):
    lake.write_changes(mixed_changes(spark, 300, days=3), str(tmp_path), "ns", load=1)
    lake.write_changes(mixed_changes(spark, 90, days=3), str(tmp_path), "ns", load=2)
    lake.write_changes(mixed_changes(spark, 300, days=3).filter("seq < 50"), str(tmp_path), "ns", load=1, replace=True)
    assert lake.read_changes(spark, str(tmp_path), "ns").filter("batch_id = -1").count() == 50
    lake.write_changes(mixed_changes(spark, 1).filter("seq < 0"), str(tmp_path), "ns", load=1, replace=True)
    back = lake.read_changes(spark, str(tmp_path), "ns")
    assert [r.batch_id for r in back.select("batch_id").distinct().collect()] == [-2] and back.count() == 90


def test_compacted_days_are_one_load(spark, tmp_path):
    changes = mixed_changes(spark, 300, days=3)
    for load in range(1, 5):
        lake.write_changes(changes.filter(f"seq % 4 = {load - 1} OR seq < 20"), str(tmp_path), "ns", load=load)
    lake.compact_days(spark, str(tmp_path), "ns", "2026-05-09", "2026-05-10", load=9)
    back = lake.read_changes(spark, str(tmp_path), "ns")
    early = back.filter("commit_date <= '2026-05-10'")
    assert {r.batch_id for r in early.select("batch_id").distinct().collect()} == {-9}
    assert early.count() == 200 and early.select("seq").distinct().count() == 200
    late = back.filter("commit_date > '2026-05-10'")
    assert {r.batch_id for r in late.select("batch_id").distinct().collect()} == {-1, -2, -3, -4} and late.count() == 100


def test_the_number_of_files_follows_days_and_amount(spark, tmp_path):
    # Rows in no order of time, in many partitions: still about a file per day.
    lake.write_changes(mixed_changes(spark, 600, days=6).repartition(16), str(tmp_path / "a"), "ns", load=1)
    assert 6 <= len(files(tmp_path / "a")) <= 12
    # A day that is far larger than a task's share is written by many tasks.
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = mixed_changes(spark, 20_000).repartition(16)
        lake.write_changes(hot, str(tmp_path / "b"), "ns", load=1)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(files(tmp_path / "b")) >= 4
    assert lake.read_changes(spark, str(tmp_path / "b"), "ns").count() == 20_000


def test_dated_folders(spark, tmp_path):
    lake.write_changes(mixed_changes(spark, 300, days=3), str(tmp_path / "lake"), "ns", load=1)
    for _ in range(2):
        folders = lake.export_dated(spark, str(tmp_path / "lake"), str(tmp_path / "out"), "ns")
    assert [f.split("/ns/")[1] for f in folders] == ["2026/05/09", "2026/05/10", "2026/05/11"]
    back = lake.read_dated(spark, str(tmp_path / "out"), "ns", "2026-05-09", "2026-05-10")
    assert back.count() == 200
    assert back.columns == [*FILE_COLUMNS.fieldNames(), "commit_date"]
    assert reconcile.misplaced_rows(back).count() == 0
    with pytest.raises(FileNotFoundError):
        lake.read_dated(spark, str(tmp_path / "out"), "ns", "2020-01-01", "2020-01-02")


def test_checks_find_planted_faults(spark, tmp_path):
    changes = mixed_changes(spark, 40, days=2)
    wrong = lake.to_lake_rows(changes).withColumn("commit_date", F.lit(dt.date(2026, 5, 9))).withColumn("batch_id", F.lit(0))
    backwards = wrong.repartition(1).sortWithinPartitions(F.desc("seq"))
    backwards.write.partitionBy("commit_date", "batch_id").parquet(f"{tmp_path}/ns")
    back = lake.read_changes(spark, str(tmp_path), "ns")
    assert reconcile.misplaced_rows(back).count() == 20
    assert reconcile.mixed_day_files(back).count() == 1
    assert reconcile.order_breaks(back).count() == 39


def test_decoded_history_survives_the_lake(spark, tmp_path):
    messages = history.random_history(5)
    changes = filter_changes(decode(history.frame(spark, messages), chunk_bits=4), not_commit())
    lake.write_changes(changes, str(tmp_path), "ns", load=1)
    back = lake.read_changes(spark, str(tmp_path), "ns").withColumn(
        "commit_time", F.nullif("commit_time", F.timestamp_micros(F.lit(-62135596800000000)))
    )
    expected = {k: v for k, v in history.expected_rows(messages).items() if v[1] != "commit"}
    assert history.decoded_rows(back) == expected
