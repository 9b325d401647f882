"""Small helpers around Spark's file systems and session settings."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system ``path`` names."""
    system, target = _at(spark, path)
    return system.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    system, target = _at(spark, path)
    system.delete(target, True)


def folders(spark: SparkSession, pattern: str) -> dict[str, set[str]]:
    """The folders that match a glob, with the names of the files in each."""
    system, target = _at(spark, pattern)
    found = system.globStatus(target)
    return {
        str(folder.getPath()): {file.getPath().getName() for file in system.listStatus(folder.getPath())}
        for folder in found or ()
        if folder.isDirectory()
    }


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none if it is not there."""
    system, target = _at(spark, folder)
    if not system.exists(target):
        return []
    return [f.getPath().getName() for f in system.listStatus(target) if f.isFile()]


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if it is not there."""
    system, target = _at(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _written_aside(spark: SparkSession, path: str, text: str) -> str:
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/.{name}.{uuid.uuid4().hex}"
    system, target = _at(spark, aside)
    stream = system.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    return aside


def _renamed(spark: SparkSession, source: str, path: str, overwrite: bool) -> None:
    jvm = spark._jvm
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE if overwrite else kinds.NONE
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    files.rename(jvm.org.apache.hadoop.fs.Path(source), target, options)


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of what is there."""
    _renamed(spark, _written_aside(spark, path, text), path, overwrite=True)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file in one step unless it is there; whether it was written.

    The content is written aside and renamed, and the file system refuses to rename
    onto a file that exists: HDFS decides that in one step.
    """
    if exists(spark, path):
        return False
    aside = _written_aside(spark, path, text)
    try:
        _renamed(spark, aside, path, overwrite=False)
        return True
    except Py4JJavaError as refused:
        delete(spark, aside)
        if not exists(spark, path):
            raise refused
        return False


def modified_before(spark: SparkSession, pattern: str, age: dt.timedelta) -> list[str]:
    """Paths of the files matching a glob that have not changed for ``age``."""
    system, target = _at(spark, pattern)
    limit = (time.time() - age.total_seconds()) * 1000
    return [str(f.getPath()) for f in system.globStatus(target) or () if f.isFile() and f.getModificationTime() <= limit]


def replace_folders(spark: SparkSession, pattern: str, write: Callable[[], None]) -> None:
    """Run ``write``, then remove the folders matching ``pattern`` that it left as they were.

    Spark gives every file it writes a new name, so a folder whose files are all old
    holds what an earlier run of the same batch wrote and this one did not.
    """
    before = folders(spark, pattern)
    write()
    for folder, names in folders(spark, pattern).items():
        if folder in before and names <= before[folder]:
            delete(spark, folder)


def require_setting(spark: SparkSession, name: str, value: str) -> None:
    """Give the session a setting that the jobs rely on; it stays set.

    Putting an old value back after each job would change it under another job of
    the session that runs at the same time.
    """
    if spark.conf.get(name, None) != value:
        spark.conf.set(name, value)


def micros_in_files(spark: SparkSession) -> None:
    """Have Parquet files hold timestamps as microseconds, as every reader of the lake expects."""
    require_setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
