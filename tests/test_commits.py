"""What readers see of a lake between any two steps of a writer, and which files they open."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cdclake.sources import commits, lake
from cdclake.sources.files import delete, file_names, put_if_absent, read_text
from tests.test_replays import as_changes

DAY = 86_400


def load(spark, seqs, table="t", days=1):
    """Changes with positions 10 times their seq, dealt over days from 1970-01-01 on."""
    rows = as_changes(spark, [("a", 1, s, 10 * s, False) for s in seqs])
    at = F.timestamp_seconds((F.col("seq") % days) * DAY + F.col("seq"))
    return rows.withColumns({"table": F.lit(table), "timestamp": at, "commit_time": at})


def seqs(spark, root, **options):
    return sorted(r.seq for r in lake.read_changes(spark, root, "ns", **options).collect())


class Watch:
    """Reads the lake before and after every step that a writer takes."""

    def __init__(self, spark, root, monkeypatch):
        self.seen, self.steps = [], 0
        for module, name in ((commits, "put_if_absent"), (commits, "put"), (commits, "_write_manifest"), (lake, "_written"), (commits, "delete")):
            monkeypatch.setattr(module, name, self.watched(spark, root, getattr(module, name)))

    def watched(self, spark, root, step):
        def run(*args, **kwargs):
            self.seen.append(seqs(spark, root))
            out = step(*args, **kwargs)
            self.seen.append(seqs(spark, root))
            self.steps += 1
            return out

        return run


def test_readers_see_the_old_state_or_the_new_one(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    lake.write_batch(load(spark, range(0, 20), days=3), root, "ns", 0)
    lake.write_batch(load(spark, range(20, 30), days=3), root, "ns", 1)
    with monkeypatch.context() as patched:
        watch = Watch(spark, root, patched)
        lake.write_batch(load(spark, range(15, 40), days=2), root, "ns", 1)
        assert watch.steps >= 3
        assert {tuple(s) for s in watch.seen} == {tuple(range(30)), tuple(sorted([*range(20), *range(15, 40)]))}
    assert seqs(spark, root) == sorted([*range(20), *range(15, 40)])
    with monkeypatch.context() as patched:
        watch = Watch(spark, root, patched)
        lake.compact_days(spark, root, "ns", "1970-01-01", "1970-01-02", load=1)
        # One of each event, and never an event missing.
        assert {tuple(sorted(set(s))) for s in watch.seen} == {tuple(range(40))}
        assert {len(s) for s in watch.seen} == {45, len(seqs(spark, root))}
    assert len(seqs(spark, root)) < 45


def test_a_writer_that_fails_leaves_the_old_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    lake.write_batch(load(spark, range(10)), root, "ns", 0)

    def fail(*_):
        raise RuntimeError("store is down")

    for step in ("_write_manifest", "put_if_absent"):
        with monkeypatch.context() as patched:
            patched.setattr(commits, step, fail)
            with pytest.raises(RuntimeError):
                lake.write_batch(load(spark, range(5, 20)), root, "ns", 0)
        assert seqs(spark, root) == list(range(10))
    lake.write_batch(load(spark, range(5, 20)), root, "ns", 0)
    assert seqs(spark, root) == list(range(5, 20))
    assert lake.vacuum(spark, root, "ns") == 0  # all of it is new
    assert lake.vacuum(spark, root, "ns", dt.timedelta(0)) == 3
    assert seqs(spark, root) == list(range(5, 20))
    assert lake.stored_files(spark, root, "ns") == len(list((tmp_path / "ns").glob("commit_date=*/*/*.parquet")))


def test_writers_at_the_same_time_take_different_versions(spark, tmp_path, monkeypatch):
    root, base = str(tmp_path), f"{tmp_path}/ns"
    lake.write_batch(load(spark, range(10)), root, "ns", 0)
    newest, calls = commits.newest_version, []

    def overtaken(spark, base):
        version = newest(spark, base)
        calls.append(version)
        if len(calls) == 1:  # another writer commits after this one has looked
            with monkeypatch.context() as patched:
                patched.setattr(commits, "newest_version", newest)
                lake.write_batch(load(spark, range(10, 20)), root, "ns", 1)
        return version

    with monkeypatch.context() as patched:
        patched.setattr(commits, "newest_version", overtaken)
        lake.write_batch(load(spark, range(20, 30)), root, "ns", 2)
    assert seqs(spark, root) == list(range(30))
    assert len(calls) == 2 and newest(spark, base) == 3
    manifests = {json.loads(read_text(spark, f"{base}/_commits/{n}"))["manifest"] for n in file_names(spark, f"{base}/_commits") if n.endswith(".json")}
    assert {p.name for p in (tmp_path / "ns" / "_commits").glob("files-*")} == manifests


def test_put_if_absent(spark, tmp_path):
    path = f"{tmp_path}/deep/x.json"
    assert put_if_absent(spark, path, "ä1") and not put_if_absent(spark, path, "2")
    assert read_text(spark, path) == "ä1"
    assert file_names(spark, f"{tmp_path}/deep") == ["x.json"]


def test_compaction_beside_a_batch_keeps_the_batch(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    lake.write_batch(load(spark, range(10)), root, "ns", 0)
    lake.write_batch(load(spark, range(10, 20)), root, "ns", 1)
    written = lake._written

    def meanwhile(*args):
        out = written(*args)
        with monkeypatch.context() as patched:
            patched.setattr(lake, "_written", written)
            lake.write_batch(load(spark, range(20, 30)), root, "ns", 2)
        return out

    with monkeypatch.context() as patched:
        patched.setattr(lake, "_written", meanwhile)
        lake.compact_days(spark, root, "ns", "1970-01-01", "1970-01-01", load=4)
    assert seqs(spark, root) == list(range(30))
    with pytest.raises(ValueError, match="load number"):
        lake.compact_days(spark, root, "ns", "1970-01-01", "1970-01-01", load=4)


def test_snapshots_versions_and_a_lost_hint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 3)
    root, base, states = str(tmp_path), f"{tmp_path}/ns", {}
    for k in range(7):
        lake.write_batch(load(spark, range(k, k + 5)), root, "ns", k % 3)
        states[commits.newest_version(spark, base)] = seqs(spark, root)
    assert len(commits._log(spark, base, None)) <= 3
    for version, state in states.items():
        assert seqs(spark, root, version=version) == state
    delete(spark, f"{base}/_commits/last_snapshot")
    assert seqs(spark, root) == states[max(states)]


def test_only_files_that_can_hold_the_rows_are_opened(spark, tmp_path):
    root = str(tmp_path)
    for k, table in enumerate(("orders", "items", "users")):
        lake.write_batch(load(spark, range(100 * k, 100 * k + 100), table, days=2), root, "ns", k)
    assert lake.stored_files(spark, root, "ns") == 6

    def opened(**options):
        df = lake.read_changes(spark, root, "ns", **options)
        return df, len(df.inputFiles())

    df, files = opened(lsn_range=(1500, 1999))
    assert files == 2 and sorted(r.seq for r in df.collect()) == list(range(150, 200))
    df, files = opened(tables=["items"])
    assert files == 2 and sorted(r.seq for r in df.collect()) == list(range(100, 200))
    df, files = opened(tables=["items", "users"], first_day="1970-01-02", lsn_range=(None, 2050))
    assert files == 2 and sorted(r.seq for r in df.collect()) == [s for s in range(100, 206) if s % 2]
    df, files = opened(tables=["nothing"])
    assert files == 0 and df.collect() == []
    second = dt.datetime(1970, 1, 2, tzinfo=dt.timezone.utc)
    df, files = opened(time_range=(second, None))
    assert files == 3 and all(r.seq % 2 for r in df.collect())
    df, _ = opened(lsn_range=(10, 10))
    assert [r.lsn for r in df.collect()] == [10]
    # Pruned by row as well: the filters reach the scan.
    plan = lake.read_changes(spark, root, "ns", lsn_range=(10, 20), tables=["orders"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lsn), IsNotNull(table), GreaterThan" in plan


def test_many_tables_in_one_file(spark, tmp_path):
    root = str(tmp_path)
    rows = load(spark, range(3000)).withColumn("table", F.concat(F.lit("t"), F.col("seq")))
    lake.write_batch(rows, root, "ns", 0)
    assert [r.seq for r in lake.read_changes(spark, root, "ns", tables=["t17"]).collect()] == [17]
    assert lake.live_files(spark, root, "ns").filter(F.size("table_bits") > commits.TABLE_BITS).count() == 0


def test_a_lake_without_rows(spark, tmp_path):
    root = str(tmp_path)
    lake.write_batch(load(spark, []), root, "ns", 0)
    assert seqs(spark, root) == []
    lake.write_batch(load(spark, range(3)), root, "ns", 0)
    lake.write_batch(load(spark, []), root, "ns", 0)  # the batch is run again and has no rows now
    assert seqs(spark, root) == []
    with pytest.raises(FileNotFoundError):
        lake.read_changes(spark, f"{root}/none", "ns")
