"""Scratch space and folder housekeeping on the file system Spark uses.

Intermediate results that several jobs read are written as parquet below the
shared folder the cluster names in ``spark.checkpoint.dir``.  Compared with
``DataFrame.checkpoint`` a parquet copy keeps column pruning, filter push-down
and exact file sizes, which is what Catalyst needs to choose a join strategy.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; local sessions without one get a temporary folder."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):  # one process, so its machine's folder is shared
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="stratalake-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that nothing else uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def create_new_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file holding ``text``; false when it exists already."""
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    try:
        stream = fs.create(hadoop_path, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or fs.exists(hadoop_path):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; ``None`` when it is not there."""
    fs, hadoop_path = _file_system(spark, path)
    try:
        stream = fs.open(hadoop_path)
    except Py4JJavaError:
        return None
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_folders(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of the direct subfolders, each with its modification time in milliseconds.

    One listing call on the driver: the cost is the number of entries directly
    below ``path``, not the number of files underneath.
    """
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return {}
    return {
        entry.getPath().getName(): entry.getModificationTime()
        for entry in fs.listStatus(hadoop_path)
        if entry.isDirectory()
    }


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


@contextmanager
def staged_files(df: DataFrame, label: str = "stage") -> Iterator[tuple[DataFrame, int]]:
    """Write ``df`` once, hand out the written copy and its bytes, delete it afterwards.

    Use it when a result feeds several jobs or must not change between them.
    The copy is only valid inside the ``with`` block.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path), folder_bytes(spark, path)
    finally:
        delete_folder(spark, path)


@contextmanager
def staged(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """The written copy of :func:`staged_files` alone."""
    with staged_files(df, label) as (copy, _):
        yield copy


def written_copy(df: DataFrame, label: str = "copy") -> DataFrame:
    """Like ``DataFrame.checkpoint`` but stored as parquet: the lineage is cut, and the
    files stay in the checkpoint folder for as long as that folder is kept."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
