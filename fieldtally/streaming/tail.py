"""Ordered questions on a stream, answered by the batch operators over whole slices of event time.

A stream has no "previous row": rows of one micro-batch are followed by rows before them in the next. So each micro-batch
only files its rows, once, in a tail table in the shared folder, by slice of event time. When the newest event time passes a slice by
the allowed delay, the slice is closed: its rows are complete, the batch operators answer for them with their range
partitioning (a slice of any size, even of one entity and one instant, is spread over all tasks), and it is dropped from the table. No
group of rows is ever gathered in one value, and the state between micro-batches is one small record.

A row is late if its slice was closed by an earlier micro-batch. Late rows, and lines that could not be read, are kept in tables of
their own, and each micro-batch records how many rows it was given, kept, late and unreadable.

Everything a micro-batch writes lies under its number, and it reads only what earlier ones have written. So a
micro-batch that is repeated after a failure replaces its own rows and changes nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fieldtally.functions import Zone
from fieldtally.operators.motion import combine_panes, pane_summaries, rollup_exits, running_best, zone_exits
from fieldtally.operators.ordered import micros, slice_of
from fieldtally.sources.delimited import CORRUPT
from fieldtally.streaming.runner import END_OF_INPUT
from fieldtally.workspace import drop_older, exists, new_run_dir

KEPT, LATE, BAD = "kept", "late", "bad"
ACCOUNT_SCHEMA = "closed_to LONG, newest LONG, given LONG, kept LONG, late LONG, bad LONG"
NEVER = -(1 << 62)
Handler = Callable[[DataFrame, "Tail", int, int, int], None]


class Tail:
    """The tables of one stream below ``path``: rows by kind, slice and micro-batch, results by micro-batch, and the account."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def table(self, name: str, schema: T.StructType | str) -> DataFrame | None:
        """What has been written to a table, with its ``batch``; None before the first write."""
        folder = f"{self.path}/{name}"
        if not exists(self.spark, folder):
            return None
        whole = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        return self.spark.read.schema(T.StructType([*whole.fields, T.StructField("batch", T.LongType())])).parquet(folder)

    def put(self, rows: DataFrame, name: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch}")

    def before(self, batch: int) -> dict:
        """The newest record of the micro-batches before this one."""
        found = self.table("account", ACCOUNT_SCHEMA)
        row = found.where(F.col("batch") < batch).orderBy(F.desc("batch")).first() if found is not None else None
        return row.asDict() if row else {"closed_to": NEVER, "newest": NEVER, "batch": -1}

    def file_rows(self, rows: DataFrame, batch: int, width: int, closed_to: int) -> DataFrame:
        """Files the rows of a micro-batch, in one pass over them, and returns them as they were filed."""
        unreadable = F.col(CORRUPT).isNotNull() if CORRUPT in rows.columns else F.lit(False)
        slice_start = F.coalesce(slice_of(F.col("ts"), width), F.lit(NEVER))
        kind = F.when(unreadable | F.col("ts").isNull(), BAD).when(slice_start < closed_to, LATE).otherwise(KEPT)
        filed = rows.withColumns({"kind": kind, "slice": F.when(kind == KEPT, slice_start).otherwise(0), "batch": F.lit(batch).cast("long")})
        writer = filed.write.partitionBy("kind", "slice", "batch").mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.parquet(f"{self.path}/rows")
        return self.filed().where(F.col("batch") == batch)

    def filed(self) -> DataFrame:
        own = [("kind", T.StringType()), ("slice", T.LongType()), ("batch", T.LongType())]
        return self.spark.read.schema(T.StructType([*self.schema.fields, *[T.StructField(n, t) for n, t in own]])).parquet(f"{self.path}/rows")

    def closed(self, start: int, end: int, batch: int) -> DataFrame:
        """The rows of the slices from ``start`` up to ``end``. Only their folders are read."""
        rows = self.filed().where((F.col("kind") == KEPT) & (F.col("slice") >= start) & (F.col("slice") < end) & (F.col("batch") <= batch))
        return rows.select(*self.schema.names)


def by_slices(
    positions: DataFrame, path: str, width: str, handle: Handler, delay: str = "0 seconds", checkpoint: str | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Starts a query that hands the rows of ``positions`` to ``handle`` in whole slices of ``width``, each exactly once.

    ``handle(rows, tail, batch, start, end)`` gets the complete rows from ``start`` up to ``end`` (microseconds) and writes its results with
    ``tail.put(..., batch)``. Slices close when the newest row is ``delay`` past their end; a row of a closed slice is late. Rows
    without event time, and those with a corrupt-line column that is set, are unreadable. ``account`` has the numbers of each.
    """
    size, wait = micros(width), micros(delay)
    schema = positions.schema

    def run(batch: DataFrame, number: int) -> None:
        tail = Tail(batch.sparkSession, path, schema)
        before = tail.before(number)
        filed = tail.file_rows(batch, number, size, before["closed_to"])
        counts = {r["kind"]: r for r in filed.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max(F.unix_micros("ts")).alias("newest")).collect()}
        n = {kind: counts[kind]["n"] if kind in counts else 0 for kind in (KEPT, LATE, BAD)}
        newest = max(before["newest"], counts[KEPT]["newest"] if KEPT in counts else NEVER)
        closed_to = before["closed_to"]
        if newest > NEVER:
            closed_to = max(closed_to, (newest - wait) // size * size)
        if closed_to > before["closed_to"]:
            handle(tail.closed(before["closed_to"], closed_to, number), tail, number, before["closed_to"], closed_to)
        record = tail.spark.createDataFrame([(closed_to, newest, sum(n.values()), n[KEPT], n[LATE], n[BAD])], ACCOUNT_SCHEMA)
        tail.put(record, "account", number)
        if exists(tail.spark, f"{path}/rows/kind={KEPT}"):  # what the micro-batch before has closed; this one may be repeated
            drop_older(tail.spark, f"{path}/rows/kind={KEPT}", "slice", before["closed_to"])

    writer = positions.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint or new_run_dir(positions.sparkSession, "tail"))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def wanted(positions: DataFrame, entities: Sequence | None) -> DataFrame:
    """The listed entities, and always unreadable lines and the end marker, which have none."""
    if entities is None:
        return positions
    marker = F.col("entity").isNull() & (F.col("ts") >= F.lit(END_OF_INPUT).cast("timestamp"))
    # not a plain null test: a parser that is handed that one skips lines before it knows that they are malformed
    unreadable = F.length(F.coalesce(CORRUPT, F.lit(""))) > 0 if CORRUPT in positions.columns else F.lit(False)
    return positions.where(F.col("entity").isin(list(entities)) | marker | unreadable)


def account(spark: SparkSession, path: str) -> DataFrame:
    """(batch, given, kept, late, bad) of each micro-batch."""
    return Tail(spark, path, T.StructType()).table("account", ACCOUNT_SCHEMA).select("batch", "given", KEPT, LATE, BAD)


def set_aside(spark: SparkSession, path: str, schema: T.StructType, kind: str) -> DataFrame:
    """The late or unreadable rows of a stream with the columns of ``schema``, and their micro-batch."""
    return Tail(spark, path, schema).filed().where(F.col("kind") == kind).drop("kind", "slice")


def results(spark: SparkSession, path: str, name: str, schema: T.StructType | str) -> DataFrame:
    """What a stream has put into a table so far."""
    found = Tail(spark, path, T.StructType()).table(name, schema)
    return spark.createDataFrame([], schema) if found is None else found.drop("batch")


EXITS = "window_start TIMESTAMP, window_end TIMESTAMP, zone STRING, exits LONG"


def closed_zone_exits(
    positions: DataFrame, zones: Sequence[Zone], path: str, width: str = "1 minute", rollup: str | None = "10 hours", scope: str = "per_entity",
    entities: Sequence | None = None, delay: str = "0 seconds", checkpoint: str | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Zone exits per ``rollup`` window (per ``width`` window without a roll-up) in the table ``exits``: the rows of ``zone_exits`` and
    ``rollup_exits``. Read it with ``results(spark, path, "exits", EXITS)``. State is the rows of the open windows, and a row per
    closed window and zone of an open roll-up."""
    large = micros(rollup) if rollup else 0

    def handle(rows: DataFrame, tail: Tail, batch: int, start: int, end: int) -> None:
        found = zone_exits(rows, zones, width, scope)
        if not rollup:
            tail.put(found, "exits", batch)
            return
        until = F.unix_micros("window_end") - 1
        found.withColumns({"out": until - F.pmod(until, F.lit(large)), "batch": F.lit(batch).cast("long")}).write.partitionBy("out", "batch").mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").parquet(f"{tail.path}/windows")
        first, last = start // large * large, end // large * large
        windows = tail.spark.read.schema(f"{EXITS}, out LONG, batch LONG").parquet(f"{tail.path}/windows")
        windows = windows.where((F.col("out") >= first) & (F.col("out") < last) & (F.col("batch") <= batch))
        tail.put(rollup_exits(windows, rollup), "exits", batch)
        drop_older(tail.spark, f"{tail.path}/windows", "out", first)

    return by_slices(wanted(positions, entities), path, width, handle, delay, checkpoint, available_now)


STEPS = "window_start TIMESTAMP, window_end TIMESTAMP, avg_step DOUBLE"
BESTS = "window_start TIMESTAMP, window_end TIMESTAMP, best_start TIMESTAMP, best_end TIMESTAMP, best_avg DOUBLE"


def closed_avg_step(
    positions: DataFrame, path: str, size: str = "5 minutes", slide: str = "1 minute", keys: Sequence[str] = (), entities: Sequence | None = None,
    delay: str = "0 seconds", checkpoint: str | None = None, available_now: bool = True, then: Handler | None = None,
) -> StreamingQuery:
    """Mean step length per sliding window in the table ``steps``: the rows of ``avg_step``. Read it with
    ``results(spark, path, "steps", STEPS)`` (with ``keys``, put their columns first). State is the rows of the open panes, and a row per
    closed pane of an open window. ``then`` is handed the windows that each micro-batch has finished."""
    keys, length, step = list(keys), micros(size), micros(slide)
    pane = f"{gcd(length, step)} microseconds"

    def handle(rows: DataFrame, tail: Tail, batch: int, start: int, end: int) -> None:
        found = pane_summaries(rows, keys, size, slide)
        span = F.col("_slice") - F.pmod("_slice", F.lit(length))
        found.withColumns({"span": span, "batch": F.lit(batch).cast("long")}).write.partitionBy("span", "batch").mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(f"{tail.path}/panes")
        first = (start - length) // length * length
        panes = tail.spark.read.schema(T.StructType([*found.schema.fields, T.StructField("span", T.LongType()), T.StructField("batch", T.LongType())]))
        panes = panes.parquet(f"{tail.path}/panes").where((F.col("span") >= first) & (F.col("batch") <= batch)).drop("span", "batch")
        ended = F.unix_micros("window_end")
        windows = combine_panes(panes, keys, size, slide).where((ended > start) & (ended <= end))
        tail.put(windows, "steps", batch)
        if then is not None:
            written = tail.spark.read.schema(windows.schema).parquet(f"{tail.path}/steps/batch={batch}")
            then(written, tail, batch, start, end)
        drop_older(tail.spark, f"{tail.path}/panes", "span", first)

    return by_slices(wanted(positions, entities), path, pane, handle, delay, checkpoint, available_now)


def live_running_best(
    positions: DataFrame, path: str, size: str = "5 minutes", slide: str = "1 minute", emit_from: Column | None = None, block: str = "1 day", **options,
) -> StreamingQuery:
    """Per finished window the best window so far, in the table ``bests``: the rows of ``running_best`` over ``avg_step``, while the stream runs.

    Windows finish in the order of their ends, so each micro-batch takes the running maximum of its own windows and carries the best of
    all before it from the record that the micro-batch before has left. ``emit_from`` keeps the windows that end at or after that time, each with
    the best over *all* earlier ones. Options are those of ``closed_avg_step``; read with ``results(spark, path, "bests", BESTS)``.
    """

    def then(windows: DataFrame, tail: Tail, batch: int, start: int, end: int) -> None:
        known = tail.table("best", STEPS)
        known = None if known is None else known.where(F.col("batch") < batch)
        newest = None if known is None else known.agg(F.max("batch")).first()[0]
        carried = [] if newest is None else [known.where(F.col("batch") == newest).drop("batch")]
        together = windows.select("window_start", "window_end", "avg_step")
        for row in carried:
            together = together.unionByName(row)
        bests = running_best(together, emit_from, block)
        # the carried window has its own row from an earlier micro-batch
        tail.put(bests.where(F.unix_micros("window_end") > start), "bests", batch)
        rank = F.struct("avg_step", -F.unix_micros("window_start"))
        best = together.agg(F.max_by(F.struct("window_start", "window_end", "avg_step"), rank).alias("w")).where("w is not null").select("w.*")
        tail.put(best.coalesce(1), "best", batch)
        if newest is not None:
            drop_older(tail.spark, f"{tail.path}/best", "batch", newest)

    return closed_avg_step(positions, path, size, slide, then=then, **options)
