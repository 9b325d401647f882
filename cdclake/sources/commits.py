"""The commit log of a lake: which of its files count, and what each can hold.

A batch writes its files first, under new names, and nobody counts them.  Then a
manifest lists them, and one small record named by the next version makes them count
and what they replace no longer.  The record is put if absent, in one step, so a reader
sees all of a batch or nothing, before a replacement or after it, never half of it or
both.  Readers resolve the log first and open just the files it gives them:

* ``<lake>/_commits/<version>.json``: the batch, its manifest, and what it replaces;
* ``<lake>/_commits/files-<id>/``: a manifest as Parquet, one row per file with its day,
  ranges of positions and times, and a Bloom filter of its tables;
* every :data:`SNAPSHOT_EVERY` versions one record whose manifest lists all files that
  count, so that a reader goes through few records however many there have been;
  ``last_snapshot`` says which was the last (a hint: without it all records are read).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.sources.files import delete, exists, file_names, modified_before, put, put_if_absent, read_text

SNAPSHOT_EVERY = 50

#: Bits of a file's Bloom filter of tables, and bits a table sets.
TABLE_BITS = 4096
TABLE_HASHES = 4

MANIFEST = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()),  # below the lake's folder
        T.StructField("commit_date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("min_lsn", T.LongType()),
        T.StructField("max_lsn", T.LongType()),
        T.StructField("min_time", T.TimestampType()),
        T.StructField("max_time", T.TimestampType()),
        T.StructField("table_bits", T.ArrayType(T.IntegerType())),
    ]
)


@dataclass(frozen=True)
class Commit:
    """One record of the log.

    ``replaces`` is a batch whose earlier files no longer count; with ``first_day`` and
    ``last_day`` no earlier file of these days does, of versions up to ``up_to``.  A
    snapshot stands for all records before it.
    """

    version: int
    manifest: str | None
    replaces: int | None = None
    first_day: str | None = None
    last_day: str | None = None
    up_to: int | None = None
    snapshot: bool = False


def log_folder(base: str) -> str:
    return f"{base}/_commits"


def has_log(spark: SparkSession, base: str) -> bool:
    """Whether the lake at ``base`` has a log, be it without a commit yet."""
    return exists(spark, f"{log_folder(base)}/begun")


def begin_log(spark: SparkSession, base: str, adopt: Callable[[], DataFrame | None]) -> None:
    """Give the lake a log unless it has one; the manifest rows of ``adopt`` are what counts from then on."""
    if not has_log(spark, base):
        facts = adopt()
        if facts is not None and not _versions(spark, base):
            commit(spark, base, facts)
        put_if_absent(spark, f"{log_folder(base)}/begun", "")


def _versions(spark: SparkSession, base: str) -> dict[int, str]:
    names = file_names(spark, log_folder(base))
    return {int(n.removesuffix(".json")): n for n in names if n.endswith(".json") and n[0].isdigit()}


def _log(spark: SparkSession, base: str, version: int | None) -> list[Commit]:
    """The records that decide what counts at ``version`` (the newest unless given), from the last snapshot on."""
    names = {v: n for v, n in _versions(spark, base).items() if version is None or v <= version}
    hint = (read_text(spark, f"{log_folder(base)}/last_snapshot") or "").strip()
    start = int(hint) if hint.isdigit() and int(hint) in names else 0
    log = [Commit(**json.loads(read_text(spark, f"{log_folder(base)}/{names[v]}"))) for v in sorted(names) if v >= start]
    last = max((i for i, c in enumerate(log) if c.snapshot), default=0)
    return log[last:]


def live_files(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The manifest rows of the files that count, at the newest version or an earlier one."""
    log = _log(spark, base, version)
    folders = [f"{log_folder(base)}/{c.manifest}" for c in log if c.manifest is not None]
    if not folders:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(*folders).filter(_counts(log))


def _counts(log: list[Commit]) -> Column:
    counts = F.lit(True)
    for c in log:
        if c.replaces is not None:
            counts &= ~((F.col("batch_id") == c.replaces) & (F.col("version") < c.version))
        if c.first_day is not None:
            days = F.col("commit_date").between(F.lit(dt.date.fromisoformat(c.first_day)), F.lit(dt.date.fromisoformat(c.last_day)))
            counts &= ~(days & (F.col("version") <= c.up_to))
    return counts


def newest_version(spark: SparkSession, base: str) -> int:
    """The lake's newest version; 0 before the first."""
    return max(_versions(spark, base), default=0)


# ------------------------------------------------------------------ file skipping


def _table_positions(table: Column) -> Column:
    return F.array([F.pmod(F.xxhash64(table, F.lit(k)), F.lit(TABLE_BITS)).cast("int") for k in range(TABLE_HASHES)])


def file_facts(rows: DataFrame) -> DataFrame:
    """Manifest rows, but for the version, of the files that lake ``rows`` were read from.

    Only positions, times and tables are read.  A file's filter holds at most
    ``TABLE_BITS`` numbers, however many tables its rows are of.
    """
    below = F.regexp_extract("_metadata.file_path", r"(commit_date=[^/]*/batch_id=[^/]*/[^/]+)\z", 1)
    seen = rows.select(
        below.alias("path"), "commit_date", "batch_id", "lsn", "timestamp", F.col("_metadata.file_size").alias("bytes"), "table"
    )
    # Counted by file and table first, so that the filters are made of few rows.
    per_table = seen.groupBy("path", "table").agg(
        F.min("commit_date").alias("commit_date"), F.min("batch_id").alias("batch_id"), F.count(F.lit(1)).alias("rows"), F.min("bytes").alias("bytes"),
        F.min("lsn").alias("min_lsn"), F.max("lsn").alias("max_lsn"), F.min("timestamp").alias("min_time"), F.max("timestamp").alias("max_time"),
    )
    return per_table.groupBy("path").agg(
        F.min("commit_date").alias("commit_date"), F.min("batch_id").alias("batch_id"), F.sum("rows").alias("rows"), F.min("bytes").alias("bytes"),
        F.min("min_lsn").alias("min_lsn"), F.max("max_lsn").alias("max_lsn"), F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(_table_positions(F.col("table")))))).alias("table_bits"),
    )


def may_hold(
    lsn_range: tuple[int | None, int | None] | None = None,
    time_range: tuple[dt.datetime | None, dt.datetime | None] | None = None,
    tables: list[str] | None = None,
) -> Column:
    """Whether a file can hold rows of the ranges (both ends included) and of one of the tables."""
    able = F.lit(True)
    for bounds, low_column, high_column in ((lsn_range, "min_lsn", "max_lsn"), (time_range, "min_time", "max_time")):
        low, high = bounds or (None, None)
        if low is not None:
            able &= F.col(high_column) >= F.lit(low)
        if high is not None:
            able &= F.col(low_column) <= F.lit(high)
    if tables is not None:
        named = F.lit(False)
        for table in tables:
            positions = _table_positions(F.lit(table))
            named |= F.size(F.array_except(positions, "table_bits")) == 0
        able &= named
    return able


# ------------------------------------------------------------------------ writing


def commit(
    spark: SparkSession,
    base: str,
    facts: DataFrame | None,
    replaces: int | None = None,
    days: tuple[dt.date, dt.date] | None = None,
    up_to: int | None = None,
) -> int:
    """Make the files of ``facts`` count, and what they replace no longer; returns the version.

    If another writer takes the version first, the next one is tried.
    """
    while True:
        version = newest_version(spark, base) + 1
        manifest = None if facts is None else _write_manifest(facts.withColumn("version", F.lit(version).cast("bigint")), base)
        first, last = (None, None) if days is None else (str(days[0]), str(days[1]))
        if _put(spark, base, Commit(version, manifest, replaces, first, last, up_to if days else None)):
            if version % SNAPSHOT_EVERY == 0:
                snapshot(spark, base)
            return version
        if manifest is not None:
            delete(spark, f"{log_folder(base)}/{manifest}")


def _write_manifest(rows: DataFrame, base: str) -> str:
    name = f"files-{uuid.uuid4().hex}"
    rows.select(*MANIFEST.fieldNames()).write.parquet(f"{log_folder(base)}/{name}")
    return name


def _put(spark: SparkSession, base: str, record: Commit) -> bool:
    return put_if_absent(spark, f"{log_folder(base)}/{record.version:020d}.json", json.dumps(asdict(record)))


def snapshot(spark: SparkSession, base: str) -> int | None:
    """Add a record that lists all files that count, for readers to start from; None if another writer was faster."""
    version = newest_version(spark, base) + 1
    manifest = _write_manifest(live_files(spark, base, version - 1), base)
    if _put(spark, base, Commit(version, manifest, snapshot=True)):
        put(spark, f"{log_folder(base)}/last_snapshot", str(version))
        return version
    delete(spark, f"{log_folder(base)}/{manifest}")
    return None


def vacuum(spark: SparkSession, base: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
    """Remove data files that do not count and have not changed for a while; returns how many.

    These are files that were replaced, and those of batches that failed before their
    commit.  Readers that resolved an earlier version and batches being written must be
    done with them by then: take a time longer than either lasts.
    """
    counted = {r["path"] for r in live_files(spark, base).select("path").toLocalIterator()}
    gone = 0
    for path in modified_before(spark, f"{base}/commit_date=*/batch_id=*/*.parquet", older_than):
        if "/".join(path.rsplit("/", 3)[1:]) not in counted:
            delete(spark, path)
            gone += 1
    return gone
