"""Versioned Parquet tables: a folder per version, published by a rename.

A writer reads the newest version, writes its rows to a folder of its own and publishes that
folder under the next number. The rename does not replace a folder that is there, so of two
writers of one number the first wins; the other computes its rows again from the version the
first one published. Readers take the highest number and see whole versions only.

The rename has to be atomic, as on HDFS and local disks. An object store renames by copying;
keep versioned tables on a file system there.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

VERSION = "version"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path as an object of it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    found = (re.fullmatch(rf"{VERSION}=([0-9]+)", s.getPath().getName()) for s in fs.listStatus(folder))
    return sorted(int(m[1]) for m in found if m)


def newest(spark: SparkSession, path: str) -> int | None:
    return max(versions(spark, path), default=None)


def read_version(spark: SparkSession, path: str, number: int) -> DataFrame:
    return spark.read.parquet(f"{path}/{VERSION}={number}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; one that is not there is no error."""
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def publish(spark: SparkSession, staged: str, target: str) -> bool:
    """Rename ``staged`` to ``target``; False where ``target`` is there already."""
    jvm = spark.sparkContext._jvm
    fs, to = _file_system(spark, target)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    # Made absolute, so that the file context (unlike the file system) needs no default scheme.
    source, to = (fs.makeQualified(jvm.org.apache.hadoop.fs.Path(p)) for p in (staged, target))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(source, to, options)
    except Py4JJavaError:
        if fs.exists(to):
            return False
        raise
    return True


def write_version(spark: SparkSession, path: str, rows_of: Callable[[int | None], DataFrame]) -> int:
    """Publish ``rows_of(newest version or None)`` as the next version; returns its number.
    ``rows_of`` is called again when another writer has published in the meantime."""
    while True:
        base = newest(spark, path)
        number = 0 if base is None else base + 1
        staged = f"{path}/_writing-{uuid.uuid4().hex}"
        rows_of(base).write.parquet(staged)
        if publish(spark, staged, f"{path}/{VERSION}={number}"):
            return number
        remove(spark, staged)


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the ``keep`` newest versions (a reader of an older one fails); returns
    the numbers deleted."""
    if keep < 1:
        raise ValueError("at least the newest version stays")
    old = versions(spark, path)[:-keep]
    for number in old:
        remove(spark, f"{path}/{VERSION}={number}")
    return old
