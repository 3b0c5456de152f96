"""Shared scratch storage.

Executors can be lost at any time, so anything that must be computed once is
written where every executor can read it again: the folder the cluster names
in ``spark.checkpoint.dir``. Only a local session without that setting falls
back to a temporary folder of its own.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# Removed when the Python process ends.
_local_roots: dict[str, tempfile.TemporaryDirectory] = {}


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop_path(spark, path)
    return fs.exists(jpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when it does not exist."""
    jpath, fs = _hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def remove_path(spark: SparkSession, path: str) -> None:
    jpath, fs = _hadoop_path(spark, path)
    fs.delete(jpath, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system; the parent of the target is made."""
    old, fs = _hadoop_path(spark, source)
    new, _ = _hadoop_path(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    jpath, fs = _hadoop_path(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    jpath, fs = _hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application in the shared scratch storage."""
    context = spark.sparkContext
    app = context.applicationId
    configured = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if configured:
        return f"{configured.rstrip('/')}/farebox/{app}"
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    if app not in _local_roots:
        _local_roots[app] = tempfile.TemporaryDirectory(prefix="farebox-", ignore_cleanup_errors=True)
    return _local_roots[app].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application wrote to scratch."""
    remove_path(spark, scratch_root(spark))


def _read_back(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to scratch and read it back.

    Besides cutting the lineage this gives the planner the true size of the
    data, so that automatic broadcast decides on a measured size rather than
    on an estimate.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return _read_back(df, path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stage`` for the length of a block; the copy is removed afterwards."""
    path = scratch_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield _read_back(df, path)
    finally:
        remove_path(df.sparkSession, path)
