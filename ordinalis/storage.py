"""Shared working folder, and cutting a lineage by writing a table into it."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a folder of its own; on a cluster a
    machine-local folder would lose data with its executor, so that is an error. Whether a
    ``file:`` path is a mount that all machines share can't be seen from here.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(path)
        return path
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ordinalis-"))
    return context.getCheckpointDir()


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/ordinalis/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete every table this application cut; call it when no result is read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Later stages start from files, so a lost executor costs a re-read and not the whole
    history, and a table used by several branches is computed once. With ``partition_by``,
    filters on that column (of few values) read only the matching folders.
    """
    path = fresh_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_complete(spark: SparkSession, path: str) -> bool:
    """True when a Spark job finished writing ``path`` (its ``_SUCCESS`` marker exists)."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def _file(spark: SparkSession, path: str):
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def mark_complete(spark: SparkSession, path: str) -> None:
    """For what is written in several jobs: say that all of them are done."""
    system, name = _file(spark, f"{path.rstrip('/')}/_COMPLETE")
    system.create(name, True).close()


def marked_complete(spark: SparkSession, path: str) -> bool:
    system, name = _file(spark, f"{path.rstrip('/')}/_COMPLETE")
    return system.exists(name)


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Publish a small text file: it is there whole or not at all. False if it was there before."""
    system, name = _file(spark, path)
    draft = name.suffix(f".{uuid.uuid4().hex}.draft")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if not system.exists(name) and system.rename(draft, name):
        return True
    system.delete(draft, False)
    return False


def create(spark: SparkSession, path: str, content: bytes) -> None:
    """A small new file; an error if it is there already."""
    system, name = _file(spark, path)
    stream = system.create(name, False)
    stream.write(bytearray(content))
    stream.close()


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    system, name = _file(spark, path)
    if not system.exists(name):
        return None
    stream = system.open(name)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders at ``path``; none if there is no such folder."""
    system, name = _file(spark, path)
    if not system.exists(name):
        return []
    return [entry.getPath().getName() for entry in system.listStatus(name)]


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``."""
    system, name = _file(spark, path)
    return system.getContentSummary(name).getLength()


def modified(spark: SparkSession, path: str) -> float:
    """Hours since ``path`` itself was last changed."""
    system, name = _file(spark, path)
    return (time.time() * 1000 - system.getFileStatus(name).getModificationTime()) / 3_600_000


def delete(spark: SparkSession, path: str) -> None:
    system, name = _file(spark, path)
    system.delete(name, True)
