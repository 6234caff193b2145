"""Where intermediate rows live between the passes of a job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def runs_in_one_process(spark: SparkSession) -> bool:
    """True for ``local`` and ``local[n]``, where driver and executors are one JVM."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def work_dir(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach.

    It lies below ``spark.checkpoint.dir``. Only a session that is a single
    process may do without that setting and gets a temporary folder. What is
    still there when the application ends is deleted then.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not runs_in_one_process(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="clusterloom-")
    name = f"{shared.rstrip('/')}/clusterloom-{uuid.uuid4().hex}"
    files, folder = _file_system(spark, name)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return name


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once as Parquet and continue from the files.

    Later passes neither ask the source again nor depend on cached blocks, so
    they give the same rows after an executor was lost.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_snapshot(spark: SparkSession, path: str) -> None:
    """Delete a snapshot folder."""
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Has a job that writes this folder come to its end?"""
    files, mark = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(mark)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it does not exist."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return []
    return sorted(found.getPath().getName() for found in files.listStatus(folder) if found.isDirectory())


def put_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file at once: readers see the earlier text or the new one."""
    files, target = _file_system(spark, path)
    files.mkdirs(target.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    names = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    names.rename(files.makeQualified(draft), files.makeQualified(target), options)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; nothing where there is none."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def _file_system(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path in its terms."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def is_persisted(df: DataFrame) -> bool:
    return df.storageLevel.useMemory or df.storageLevel.useDisk


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` on the executors for the passes inside the block, then release it.

    A frame that its owner has persisted stays as it is.
    """
    if is_persisted(df):
        yield df
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
