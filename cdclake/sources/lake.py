"""The lake: change rows as Parquet, partitioned by UTC commit day and batch.

Which files count is in the lake's commit log (:mod:`cdclake.sources.commits`).
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.positions import commit_date, unset_time
from cdclake.schema import CHANGE, FILE_COLUMNS, PARTITIONS
from cdclake.sources import commits
from cdclake.sources.files import exists, folders, micros_in_files

#: Row order inside a file.
FILE_ORDER = ("timestamp", "lsn", "seq")

DEFAULT_NAMESPACE = "default"

#: Rows per file.  Each file is one task's share of a day, so this is an upper
#: bound; the default keeps files near 100-200 MB.
MAX_RECORDS_PER_FILE = 1_000_000

# How the files are encoded.
WRITER_OPTIONS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "3",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#table": "true",
    "parquet.enable.dictionary#operation": "true",
    "parquet.column.statistics.enabled#before": "false",
    "parquet.column.statistics.enabled#after": "false",
}


def to_lake_rows(changes: DataFrame) -> DataFrame:
    """Change rows as they are stored: the file columns first, days added."""
    day = commit_date(F.col("commit_time"), F.col("timestamp"))
    stored = {"commit_time": F.coalesce("commit_time", unset_time())}
    return changes.select(
        *[stored.get(c, F.col(c)).alias(c) for c in CHANGE.fieldNames()],
        day.alias("commit_date"),
    )


def write_changes(
    changes: DataFrame,
    root: str,
    namespace: str = DEFAULT_NAMESPACE,
    *,
    load: int,
    replace: bool = False,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Write a batch load under ``root/namespace/commit_date=.../batch_id=...``.

    Loads are numbered from 1 by the caller and kept apart from the batches of a
    stream, so that either may follow the other into one lake.  A load that is
    there already is an error; with ``replace`` it is written anew, and days that
    it no longer has are removed.  A load without rows writes no file.
    """
    if load < 1:
        raise ValueError("loads are numbered from 1")
    if not replace and not live_files(changes.sparkSession, root, namespace).filter(F.col("batch_id") == -load).isEmpty():
        raise ValueError(f"load {load} is in {root}/{namespace} already; take another number, or replace it")
    write_batch(changes, root, namespace, -load, max_records_per_file)


def _folders_of(root: str, namespace: str, batch: int | str) -> str:
    return f"{root}/{namespace}/commit_date=*/batch_id={batch}"


def live_files(spark: SparkSession, root: str, namespace: str = DEFAULT_NAMESPACE, version: int | None = None) -> DataFrame:
    """The files of the lake that count: path, day, batch, rows, bytes, and ranges of positions and times."""
    return commits.live_files(spark, f"{root}/{namespace}", version)


def stored_files(spark: SparkSession, root: str, namespace: str = DEFAULT_NAMESPACE) -> int:
    """Number of data files of the lake."""
    return live_files(spark, root, namespace).count()


def has_stream_batches(spark: SparkSession, root: str, namespace: str) -> bool:
    """Whether a stream has written to the lake."""
    return bool(folders(spark, _folders_of(root, namespace, "[0-9]*")))


def write_batch(
    changes: DataFrame, root: str, namespace: str, batch_id: int, max_records_per_file: int = MAX_RECORDS_PER_FILE
) -> None:
    """Write a batch under its id (negative for loads, else a stream's), in place of what it had.

    Readers see it as a whole from its commit on, and until then what it had before.
    """
    facts = _written(changes, root, namespace, batch_id, max_records_per_file)
    had = live_files(changes.sparkSession, root, namespace).filter(F.col("batch_id") == batch_id)
    if facts is not None or not had.isEmpty():
        commits.commit(changes.sparkSession, f"{root}/{namespace}", facts, replaces=batch_id)


def _begin_log(spark: SparkSession, root: str, namespace: str) -> None:
    """A lake that was written without a log gets one, in which all of its files count."""
    base = f"{root}/{namespace}"

    def files_there() -> DataFrame | None:
        there = [f"{f}/{n}" for f, names in folders(spark, _folders_of(root, namespace, "*")).items() for n in names if n.endswith(".parquet")]
        return commits.file_facts(_read_files(spark, base, sorted(there))) if there else None

    commits.begin_log(spark, base, files_there)


def _written(changes: DataFrame, root: str, namespace: str, batch_id: int, max_records_per_file: int) -> DataFrame | None:
    """Write a batch's files, which don't count yet; their manifest rows, or None without rows.

    Rows are rebalanced by day: adaptive execution gives a hot day many tasks and
    puts small days together, so that the number of files follows the amount of
    data and the number of days, not the number of tasks times that of days.
    """
    spark, base = changes.sparkSession, f"{root}/{namespace}"
    rows = to_lake_rows(changes).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    # Partition columns first: the writer then needs no sort of its own.
    ordered = rows.hint("rebalance", "commit_date").sortWithinPartitions(*PARTITIONS.fieldNames(), *FILE_ORDER)
    writer = (
        ordered.write.mode("append")
        .partitionBy(*PARTITIONS.fieldNames())
        .option("maxRecordsPerFile", max_records_per_file)
        .options(**WRITER_OPTIONS)
    )
    micros_in_files(spark)
    _begin_log(spark, root, namespace)
    before = folders(spark, _folders_of(root, namespace, batch_id))
    writer.parquet(base)
    # Spark gives every file it writes a new name.
    after = folders(spark, _folders_of(root, namespace, batch_id))
    new = sorted(f"{f}/{n}" for f, names in after.items() for n in names - before.get(f, set()) if n.endswith(".parquet"))
    return commits.file_facts(_read_files(spark, base, new)) if new else None


def compact_days(
    spark: SparkSession,
    root: str,
    namespace: str,
    first_day: str | dt.date,
    last_day: str | dt.date,
    *,
    load: int,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Put all batches of some days together into one load of a new number.

    The new files take the place of the old ones in one commit: readers see the one
    or the other.  Batches that come meanwhile stay as they are.  ``vacuum`` removes
    the old files.
    """
    first, last = _day(first_day), _day(last_day)
    base = f"{root}/{namespace}"
    version = commits.newest_version(spark, base)
    if load < 1 or not live_files(spark, root, namespace, version).filter(F.col("batch_id") == -load).isEmpty():
        raise ValueError(f"take a load number above 0 that {base} does not have yet")
    rows = read_changes(spark, root, namespace, first, last, version=version).dropDuplicates(["slot", "session", "seq"])
    facts = _written(rows, root, namespace, -load, max_records_per_file)
    commits.commit(spark, base, facts, days=(first, last), up_to=version)


def vacuum(spark: SparkSession, root: str, namespace: str = DEFAULT_NAMESPACE, older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
    """Remove files that do not count and are older than any reader or batch that is at work; returns how many."""
    return commits.vacuum(spark, f"{root}/{namespace}", older_than)


def _day(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def _day_range(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def read_changes(
    spark: SparkSession,
    root: str,
    namespace: str = DEFAULT_NAMESPACE,
    first_day: str | dt.date | None = None,
    last_day: str | dt.date | None = None,
    *,
    lsn_range: tuple[int | None, int | None] | None = None,
    time_range: tuple[dt.datetime | None, dt.datetime | None] | None = None,
    tables: list[str] | None = None,
    version: int | None = None,
) -> DataFrame:
    """Change rows of the lake, for a range of commit days (both ends included).

    The rows are also those of ``lsn_range`` and ``time_range`` (of ``timestamp``; both
    ends included, either may be None) and of ``tables``.  Files that can hold none of
    them, by their ranges and filters in the commit log, are not opened; the rest is
    filtered by row.  ``version`` reads the lake as an earlier commit left it, while
    its files are there.  In a lake without a commit log every file counts.
    """
    base = f"{root}/{namespace}"
    if not exists(spark, base):
        raise FileNotFoundError(f"no lake at {base}")

    def in_days(rows: DataFrame) -> DataFrame:
        if first_day is not None:
            rows = rows.filter(F.col("commit_date") >= F.lit(_day(first_day)))
        return rows if last_day is None else rows.filter(F.col("commit_date") <= F.lit(_day(last_day)))

    if commits.has_log(spark, base):
        files = in_days(commits.live_files(spark, base, version)).filter(commits.may_hold(lsn_range, time_range, tables))
        # A list of files is what a Spark scan is planned from, on the driver, in any case.
        changes = _read_files(spark, base, sorted(f"{base}/{r.path}" for r in files.select("path").collect()))
    else:  # written by other means: every file counts
        changes = spark.read.schema(_LAKE).parquet(base)
    changes = in_days(changes)
    for column, bounds in (("lsn", lsn_range), ("timestamp", time_range)):
        low, high = bounds or (None, None)
        if low is not None:
            changes = changes.filter(F.col(column) >= F.lit(low))
        if high is not None:
            changes = changes.filter(F.col(column) <= F.lit(high))
    return changes if tables is None else changes.filter(F.col("table").isin(*tables))


_LAKE = type(CHANGE)(CHANGE.fields + PARTITIONS.fields)


def _read_files(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], _LAKE)
    return spark.read.schema(_LAKE).option("basePath", base).parquet(*paths)


def file_path() -> Column:
    """Path of the file a lake row was read from."""
    return F.col("_metadata.file_path")


def export_dated(
    spark: SparkSession,
    root: str,
    target: str,
    namespace: str = DEFAULT_NAMESPACE,
    first_day: str | dt.date | None = None,
    last_day: str | dt.date | None = None,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    at_once: int = 8,
) -> list[str]:
    """Copy days of the lake to ``target/namespace/YYYY/MM/DD/`` folders.

    The files hold the seven file columns only, for readers that expect dated
    folders.  Each day is a job over that day's partitions, and ``at_once`` of them
    run side by side; an exported day is replaced.  Returns the folders written.
    """
    days = read_changes(spark, root, namespace, first_day, last_day).select("commit_date").distinct()
    micros_in_files(spark)

    def export(day: dt.date) -> str:
        folder = f"{target}/{namespace}/{day:%Y/%m/%d}"
        (
            read_changes(spark, root, namespace, day, day)
            .sortWithinPartitions(*FILE_ORDER)
            .select(*FILE_COLUMNS.fieldNames())
            .write.mode("overwrite")
            .option("maxRecordsPerFile", max_records_per_file)
            .options(**WRITER_OPTIONS)
            .parquet(folder)
        )
        return folder

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(export, sorted(day for (day,) in days.collect())))  # one row per day


def read_dated(
    spark: SparkSession,
    target: str,
    namespace: str,
    first_day: str | dt.date,
    last_day: str | dt.date,
) -> DataFrame:
    """Rows of dated folders, with the day each folder stands for."""
    base = f"{target}/{namespace}"
    folders = [f"{base}/{d:%Y/%m/%d}" for d in _day_range(_day(first_day), _day(last_day))]
    present = [f for f in folders if exists(spark, f)]
    if not present:
        raise FileNotFoundError(f"no day from {first_day} to {last_day} under {base}")
    day = F.regexp_extract(file_path(), r"/(\d{4}/\d{2}/\d{2})/[^/]+\z", 1)
    return (
        spark.read.schema(FILE_COLUMNS)
        .parquet(*present)
        .withColumn("commit_date", F.to_date(day, "yyyy/MM/dd"))
    )
