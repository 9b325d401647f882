"""Session helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from cdclake.sources.files import delete


def local_session(cores: int | str = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A session for tests and the local benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cdclake")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Folders that this process has named for intermediate tables.
_NAMED: list[str] = []

#: Of these, those that the work of this thread has named since it asked for their removal.
_OWN = threading.local()


@cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="cdclake-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for a job's intermediate tables.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``,
    so that every executor can reach it and a lost executor loses nothing.  Where
    that is unset, a local folder serves a local master, as in tests; anywhere
    else it is an error, since executors would write to disks of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local_root()
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _NAMED.append(path)
    if (own := getattr(_OWN, "names", None)) is not None:
        own.append(path)
    return path


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables that this thread writes inside, at the end; for work that goes on for ever."""
    before, _OWN.names = getattr(_OWN, "names", None), []
    try:
        yield
    finally:
        for path in _OWN.names:
            delete(spark, path)
            _NAMED.remove(path)
        _OWN.names = before


def clear_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of all jobs of this process so far.

    Results that are not computed or written yet may read them: call it when the
    work is done.
    """
    while _NAMED:
        delete(spark, _NAMED.pop())


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    For small intermediate tables that are used more than once: it cuts the
    lineage, and a lost executor costs no recomputation.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
