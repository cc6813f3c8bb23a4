"""Running a stream over input that has an end.

A window closes when the watermark passes its end, so after the last row the newest windows
stay open. An end marker, one row far in the future, closes them. It has no entity, opens a
window that never closes and therefore never shows in a result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldtally.sinks import write_stream
from fieldtally.sources.delimited import POSITIONS_SCHEMA
from fieldtally.workspace import new_run_dir

# The end marker's event time, as a timestamp and in picoseconds.
END_OF_INPUT = "9999-01-01 00:00:00"
END_OF_INPUT_PS = "253370764800000000000000"


def _marker(spark: SparkSession, schema, present: bool) -> DataFrame:
    time = F.lit(END_OF_INPUT).cast("timestamp")
    columns = [(time if f.name == "ts" else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    return spark.range(1 if present else 0).select(*columns)


def finish_positions(spark: SparkSession, path: str) -> None:
    """Adds the end marker as the newest file of a folder of position files."""
    columns = [
        F.lit(END_OF_INPUT_PS if f.name == "ts_ps" else None).cast(f.dataType).alias(f.name) for f in POSITIONS_SCHEMA.fields
    ]
    spark.range(1).select(*columns).coalesce(1).write.mode("append").csv(path)


def marked_stream(positions: DataFrame, folder: str) -> tuple[DataFrame, Callable[[], None]]:
    """``positions`` with a second source below ``folder`` that is empty yet, and a function that puts the end marker there."""
    spark, markers = positions.sparkSession, f"{folder}/marker"
    _marker(spark, positions.schema, present=False).write.parquet(markers)
    marked = positions.unionByName(spark.readStream.schema(positions.schema).parquet(markers))
    return marked, lambda: _marker(spark, positions.schema, present=True).write.mode("append").parquet(markers)


def run_to_the_end(positions: DataFrame, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Runs the query that ``start`` starts over everything ``positions`` has now, then over the end marker alone.

    Both runs must go on from one checkpoint, and may be interrupted and repeated.
    """
    marked, end = marked_stream(positions, new_run_dir(positions.sparkSession, "stream"))
    start(marked).awaitTermination()
    end()
    start(marked).awaitTermination()


def finish_stream(
    positions: DataFrame,
    question: Callable[[DataFrame], DataFrame],
    path: str | None = None,
    checkpoint: str | None = None,
    reader: SparkSession | None = None,
) -> DataFrame:
    """Runs ``question`` over everything ``positions`` has now and closes every window.

    The query runs twice on one checkpoint: first over the available input, in as many
    micro-batches as the source makes of it, then over the end marker alone, so that the
    marker cannot overtake a row. Both runs may be interrupted and repeated. Returns the
    finished windows as a batch table of the session ``reader`` (by default the stream's).
    """
    spark = positions.sparkSession
    folder = new_run_dir(spark, "stream")
    path = path or f"{folder}/result"
    checkpoint = checkpoint or f"{folder}/progress"
    marked, end = marked_stream(positions, folder)
    result = question(marked)
    write_stream(result, path, checkpoint).awaitTermination()
    end()
    write_stream(result, path, checkpoint).awaitTermination()
    return (reader or spark).read.schema(result.schema).parquet(path)
