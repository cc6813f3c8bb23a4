"""Writers for result tables and for streaming results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldtally.functions import cost_text, path_text
from fieldtally.workspace import exists, new_run_dir


def write_table(
    df: DataFrame,
    path: str,
    sep: str = "|",
    mode: str = "errorifexists",
    header: bool = False,
    order_by: Sequence[str] | None = None,
    as_text: bool = True,
) -> None:
    """Delimited text, quoted where needed, so the table can be read back as it was.

    ``order_by`` range-partitions and sorts the rows; ``as_text`` compares the columns as
    text (10 before 9), the order in which text keys leave a shuffle sort. The other columns
    break ties, so that rows of one frequent key can be spread over several files. An
    existing folder is an error unless ``mode`` says otherwise.
    """
    if order_by:
        first = [F.col(name).cast("string") if as_text else F.col(name) for name in order_by]
        df = df.orderBy(*first, *[name for name in df.columns if name not in order_by])
    df.write.csv(path, sep=sep, mode=mode, header=header, escape='"', dateFormat="yyyy-MM-dd")


def format_paths(paths: DataFrame, source: int, separator: str = ", ") -> DataFrame:
    """Report rows: source, destination, path as text, cost as text (``Inf`` if unreachable)."""
    return paths.select(
        F.lit(source).cast("long").alias("source"),
        F.col("id").alias("dest"),
        path_text(F.col("path"), separator).alias("path"),
        cost_text(F.col("hops")).alias("cost"),
    )


def write_paths_report(paths: DataFrame, source: int, path: str, sep: str = "|", mode: str = "overwrite") -> None:
    """Path report as delimited text; an earlier report is replaced."""
    format_paths(paths, source).write.csv(path, sep=sep, mode=mode, emptyValue="")


def write_stream(
    result: DataFrame,
    path: str,
    checkpoint: str | None = None,
    fmt: str = "parquet",
    available_now: bool = True,
    replace: bool = False,
    **options: str,
) -> StreamingQuery:
    """Starts a streaming query that keeps its result in files below ``path``.

    Finished windows are appended through the transactional file sink. With ``replace`` what lies below
    ``path`` is cleared once, when the query starts for the first time (its checkpoint is new);
    a query that goes on from its checkpoint keeps what it has written.
    """
    spark = result.sparkSession
    checkpoint = checkpoint or new_run_dir(spark, "stream")
    if replace and not exists(spark, f"{checkpoint}/metadata"):
        spark.createDataFrame([], result.schema).write.format(fmt).options(**options).mode("overwrite").save(path)
    writer = result.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.format(fmt).options(**options).option("path", path).start()

