"""Files next to tables, by way of Hadoop's file systems: wherever Spark reads and writes, these do."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def expanded(path: str) -> str:
    """path with ~ and $VARIABLES of the driver put in; URLs stay as they are."""
    return path if "://" in path else os.path.expanduser(os.path.expandvars(path))


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Names of what a folder holds, in order; none if it isn't there."""
    fs, where = _at(spark, folder)
    found = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(x for x in found if x.endswith(suffix))


def read_text(spark: SparkSession, path: str) -> str | None:
    """None if it isn't there."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write(spark: SparkSession, path: str, data: str | bytes) -> None:
    """Under another name first, so that it is never half there."""
    fs, where = _at(spark, path)
    _, part = _at(spark, f"{path}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(data.encode() if isinstance(data, str) else data))
    finally:
        stream.close()
    fs.delete(where, False)
    if not fs.rename(part, where):
        raise OSError(f"can't write {path}")


def move(spark: SparkSession, path: str, to: str) -> None:
    """Within one file system; the folder is made."""
    fs, where = _at(spark, path)
    _, there = _at(spark, to)
    fs.mkdirs(there.getParent())
    if not fs.rename(where, there):
        raise OSError(f"can't move {path} to {to}")


def delete(spark: SparkSession, path: str) -> bool:
    """Whether there was something to delete."""
    fs, where = _at(spark, path)
    return fs.delete(where, True)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset and all runs in this process (tests), a folder of our own; on a cluster, where executors wouldn't see it, an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="signmine-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df, written as Parquet in the shared folder and read again: its lineage ends there, and a lost executor costs no more than one read.

    The files are deleted by drop(), or when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/signmine-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._signmine_path = path
    return out


def drop(df: DataFrame) -> None:
    """Deletes what cut() has written for df, which nothing may read from then on."""
    path = df._signmine_path
    _written[:] = [x for x in _written if x[1] != path]
    delete(df.sparkSession, path)


@atexit.register
def clean() -> None:
    """Deletes what cut() has written, if the session is still there."""
    while _written:
        with contextlib.suppress(Exception):  # the session may have ended
            delete(*_written.pop())
