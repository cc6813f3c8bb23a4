"""Where jobs keep intermediate tables.

Loops and streams cut their lineage by writing tables, never by holding data in
executors, so a lost executor costs at most the running stage. The folder must be
visible to the whole cluster: it is the one named by ``spark.checkpoint.dir``. Where the
session names none, a local master gets a local folder (unit tests) and any other master an error.
Results may be read from a run's folder until the caller drops it with ``drop_run``.
"""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
SHUFFLE_SETTING = "spark.sql.shuffle.partitions"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that the whole cluster can see")
    return tempfile.gettempdir().rstrip("/") + "/fieldtally-checkpoints"


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; created by the first write to it."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get(SHUFFLE_SETTING))


def drop_run(spark: SparkSession, path: str) -> None:
    """Deletes a finished run's folder; only folders below the shared one are accepted."""
    if not path.startswith(f"{shared_dir(spark)}/") or ".." in path:
        raise ValueError(f"{path} is not a run folder")
    files, target = _files(spark, path)
    files.delete(target, True)


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def drop_older(spark: SparkSession, path: str, column: str, least: int) -> None:
    """Deletes the partitions of a table's whole-number ``column`` below ``least``."""
    files, target = _files(spark, path)
    for status in files.listStatus(target):
        name, _, value = status.getPath().getName().partition("=")
        if name == column and int(value) < least:
            files.delete(status.getPath(), True)


def in_name_order(spark: SparkSession, path: str) -> int:
    """Gives the files below ``path`` modification times, a second apart and all in the past, in the order of their paths, for streams that take
    files by these times. Only metadata of files is touched; where a store keeps its own times they stay. Returns the number of files."""
    files, target = _files(spark, path)
    found, names = files.listFiles(target, True), []
    while found.hasNext():
        names.append(found.next().getPath())
    names = sorted((x for x in names if not x.getName().startswith(("_", "."))), key=str)
    now = int(time.time() * 1000)
    for n, name in enumerate(names):
        files.setTimes(name, now - 1000 * (len(names) - n), -1)
    return len(names)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    files, target = _files(spark, path)
    return files.getContentSummary(target).getLength()


def sized_session(spark: SparkSession, partitions: int, **changes: str) -> SparkSession:
    """A session on the same cluster and catalog, with the settings of ``spark`` except for
    its number of shuffle partitions and the other ``changes`` (dots written as ``__``). Loops
    over tables and streams keep them for their whole life; the caller's session stays as it is."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set(SHUFFLE_SETTING, str(partitions))
    for name, value in changes.items():
        session.conf.set(name.replace("__", "."), value)
    return session
