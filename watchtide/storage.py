"""Folders a run may write to, on whatever file system the cluster shares."""

from __future__ import annotations

import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or else a folder in the warehouse.

    Never a folder of one machine: other executors would not see its files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    return base.rstrip("/") if base else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, which cuts its lineage.

    The files outlive lost executors. They stay until the shared folder is cleaned or ``remove_folder`` is called.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def rows_on_disk(df: DataFrame) -> Iterator[DataFrame]:
    """``df``, computed once for several uses inside. Its rows are kept as one column of structs: columns of their own
    would be encoded one by one, at a third of the cost of making them, for rows that are read whole."""
    kept = df.select(F.struct(*df.columns).alias("row"))
    kept.persist(StorageLevel.DISK_ONLY)
    try:
        yield kept.select("row.*")
    finally:
        kept.unpersist()


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def numbered_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers ``n`` of the sub-folders ``prefix + n`` whose write has completed, ascending."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if status.isDirectory() and name.startswith(prefix) and name[len(prefix) :].isdigit() and fs.exists(done):
            found.append(int(name[len(prefix) :]))
    return sorted(found)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, sorted; nothing where there is no such folder."""
    fs, root = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern matches, sorted."""
    fs, target = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(target) or [])


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Makes a small file that is either whole or not there, in place of an older one of that name."""
    fs, target = _file_system(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(aside, target):
        fs.delete(target, False)
        if not fs.rename(aside, target):
            raise OSError(f"cannot write {path}")


def get_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
