"""Helpers around the cluster's shared folder: tables written once and read back."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from fieldtally.workspace import new_run_dir

_HOME = str(Path(__file__).resolve().parents[2])


def let_workers_import(spark: SparkSession) -> None:
    """Adds this library's folder to the module path of Python workers, for runs from a checkout. Where the
    library is installed on the cluster this changes nothing."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _HOME not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (path, _HOME) if x)


class Scratch:
    """A folder for the intermediate tables of one job, below ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self._n = spark, new_run_dir(spark, label), 0
        let_workers_import(spark)

    def folder(self, name: str) -> str:
        self._n += 1
        return f"{self.path}/{self._n:03d}-{name}"

    def written(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` written and read back: lineage ends here, and a lost executor loses no part."""
        path = self.folder(name)
        rows.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of each query inside when the query ends, instead of whenever the driver's garbage is collected.
    For jobs that write every intermediate table once and read it from there."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def as_structs(docs: DataFrame, name: str = "doc") -> DataFrame:
    """Each row as one struct column, so that no column of the input meets one of ours."""
    from pyspark.sql import functions as F

    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name))
