"""Folders with a commit list: the one mechanism behind LAND loads, RAW's ledger and table replaces.

A folder's entries (LAND loads, RAW batches, table versions) are sub-folders; an entry counts once an empty file
of its name lies in ``_commits``. Creating that file is one atomic call on local disks, HDFS and
object stores, so a reader sees an entry whole or not at all, and a killed write leaves an entry that nobody reads.
Everything here is metadata on the driver: one call per listing or entry, none per file.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMITS = "_commits"
KEEP_VERSIONS = 2            # the current version and the one that running readers may still hold
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _at(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; a missing folder is empty."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def matching(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths in a folder that a glob pattern matches (the folder's own name is taken literally)."""
    fs, target = _at(spark, re.sub(r"([\\\[\]{}*?])", r"\\\1", folder) + f"/{pattern}")
    return [status.getPath().toString() for status in fs.globStatus(target) or []]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, whatever it holds, in one call."""
    fs, target = _at(spark, path)
    fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file (and its folders)."""
    fs, target = _at(spark, path)
    fs.create(target, True).close()


def commit(spark: SparkSession, path: str, entry: str) -> None:
    touch(spark, f"{path}/{COMMITS}/{entry}")


def commits(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed entries, in order."""
    return [n for n in names(spark, f"{path}/{COMMITS}") if not n.startswith((".", "_"))]


def drop_commit(spark: SparkSession, path: str, entry: str) -> None:
    remove(spark, f"{path}/{COMMITS}/{entry}")


def replace(df: DataFrame, path: str, partition: str | None = None) -> str:
    """Full replace of the table at ``path``: a new version folder, then its commit; returns the folder.

    Readers (``read``) see the old rows until the commit and the new ones after it. A partitioned
    version without rows gets one empty file, so that it can be read back.
    """
    spark, version = df.sparkSession, f"v-{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:8]}"
    target = f"{path}/{version}"
    writer = df.write
    (writer.partitionBy(partition) if partition else writer).parquet(target)
    if partition and not any(n.startswith(f"{partition}=") for n in names(spark, target)):
        empty = spark.createDataFrame([], T.StructType([f for f in df.schema if f.name != partition]))
        empty.write.parquet(f"{target}/{partition}={NULL_PARTITION}")
    commit(spark, path, version)
    done = commits(spark, path)
    kept = set(done[-KEEP_VERSIONS:])
    for old in names(spark, path):          # superseded versions, and what killed writes left before this one
        if old.startswith("v-") and old < version and old not in kept:
            drop_commit(spark, path, old)
            remove(spark, f"{path}/{old}")
    return target


def current(spark: SparkSession, path: str) -> str:
    """Folder of the version that readers see now."""
    done = commits(spark, path)
    if not done:
        raise FileNotFoundError(f"no committed version of the table {path}")
    return f"{path}/{done[-1]}"


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table's current version."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(current(spark, path))
