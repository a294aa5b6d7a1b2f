"""Small file-system helpers over the session's Hadoop configuration."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

SUCCESS_MARKER = "_SUCCESS"


def _locate(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def matches(spark: SparkSession, pattern: str) -> int:
    """Number of files a glob pattern matches."""
    fs, target = _locate(spark, pattern)
    return len(fs.globStatus(target) or [])


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _locate(spark, path)
    return fs.getContentSummary(target).getLength()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it doesn't exist."""
    fs, target = _locate(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, or a file."""
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def set_modified(spark: SparkSession, path: str, milliseconds: int) -> None:
    fs, target = _locate(spark, path)
    fs.setTimes(target, milliseconds, -1)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file, such as a completion marker."""
    fs, target = _locate(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="laborscope-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path for ``name`` below the shared folder in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def is_file(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isFile()
