"""The motion questions on a stream.

A position stream has the columns of ``fieldtally.operators.motion``. Streams cannot look at
"the previous row" directly, so rows are gathered per short slice of time, put in order and
reduced to one small row; slices then combine into windows and windows into roll-ups, all as
chained event-time windows in append mode. State is bounded by the rows of the slices still
open, not of the windows; shorten ``slice_width`` for denser streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldtally.functions import Zone, bit, distance, left_zones, zone_mask
from fieldtally.operators.motion import SLICES_PER_WINDOW, best_window, zone_rows
from fieldtally.operators.ordered import micros
from fieldtally.streaming.runner import END_OF_INPUT
from fieldtally.workspace import drop_older, exists, new_run_dir


def span(length: int) -> str:
    return f"{length} microseconds"


def chosen(positions: DataFrame, entities: Sequence | None) -> DataFrame:
    """The listed entities, and always the end marker.

    Catalyst moves this filter below the watermark, so a filter without the marker would
    hide the end of the input from the watermark and keep the last windows open.
    """
    if entities is None:
        return positions
    marker = F.col("entity").isNull() & (F.col("ts") >= F.lit(END_OF_INPUT).cast("timestamp"))
    return positions.where(F.col("entity").isin(list(entities)) | marker)


def in_order(*columns: Column | str) -> Column:
    """The group's rows as an array sorted by the first columns."""
    return F.array_sort(F.collect_list(F.struct(*columns)))


def pairs(rows: Column, combine) -> Column:
    """``combine(before, now)`` for each two neighbours of an ordered array."""
    count = F.size(rows) - 1
    return F.zip_with(F.slice(rows, F.lit(1), count), F.slice(rows, F.lit(2), count), combine)


def total(values: Column, zero: Column) -> Column:
    return F.aggregate(values, zero, lambda so_far, value: so_far + value)


def zone_total(masks: Column | str, n: int) -> Column:
    """How many of the masks have the bit of zone ``n``."""
    return total(F.transform(masks, lambda mask: bit(mask, n)), F.lit(0).cast("long"))


def field_total(rows: Column | str, name: str, zero: Column) -> Column:
    return total(F.transform(rows, lambda row: row[name]), zero)


def stream_zone_exits(
    positions: DataFrame,
    zones: Sequence[Zone],
    width: str = "1 minute",
    rollup: str | None = "10 hours",
    scope: str = "per_entity",
    entities: Sequence | None = None,
    slice_width: str | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """Zone exits per ``rollup`` window, or per ``width`` window without a roll-up.

    Same rows as ``zone_exits`` followed by ``rollup_exits``. Rows more than ``delay`` behind
    the newest one may be dropped, from the second micro-batch after it on.
    """
    if scope not in ("per_entity", "interleaved"):
        raise ValueError(f"unknown scope {scope!r}")
    keys = ["entity"] if scope == "per_entity" else []
    piece = micros(slice_width) if slice_width else max(1, micros(width) // SLICES_PER_WINDOW)
    piece = gcd(piece, micros(width))
    zero = F.lit(0).cast("long")
    names = [f"exits_{n}" for n in range(len(zones))]
    rows = (
        chosen(positions, entities)
        .select("ts", "seq", *keys, zone_mask(zones, F.col("x"), F.col("y")).alias("mask"))
        .withWatermark("ts", delay)
    )
    slices = rows.groupBy(F.window("ts", span(piece)).alias("slice"), *keys).agg(in_order("ts", "seq", "mask").alias("rows"))
    left = pairs(F.col("rows"), lambda before, now: left_zones(before["mask"], now["mask"]))
    slices = slices.select("slice", *keys, "rows", left.alias("left")).select(
        "slice",
        *keys,
        F.col("slice.start").alias("at"),
        F.col("rows")[0]["mask"].alias("first_mask"),
        F.element_at("rows", -1)["mask"].alias("last_mask"),
        *[zone_total("left", n).alias(name) for n, name in enumerate(names)],
    )
    windows = slices.groupBy(F.window("slice", span(micros(width))).alias("win"), *keys).agg(
        in_order("at", "first_mask", "last_mask", *names).alias("pieces")
    )
    border = pairs(F.col("pieces"), lambda before, now: left_zones(before["last_mask"], now["first_mask"]))
    windows = windows.select("win", "pieces", border.alias("border")).select(
        "win",
        *[(field_total("pieces", name, zero) + zone_total("border", n)).alias(name) for n, name in enumerate(names)],
    )
    counts = (
        windows.groupBy(F.window("win", span(micros(rollup or width))).alias("out"))
        .agg(*[F.sum(name).alias(name) for name in names])
        .select(F.col("out.start").alias("window_start"), F.col("out.end").alias("window_end"), *names)
    )
    return zone_rows(counts, zones)


def stream_avg_step(
    positions: DataFrame,
    size: str = "5 minutes",
    slide: str = "1 minute",
    keys: Sequence[str] = (),
    entities: Sequence | None = None,
    slice_width: str | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """Mean step length per sliding window; same rows as ``avg_step``.

    Slices combine into panes (the common divisor of size and slide), and only panes are copied into
    overlapping windows. One array holds the rows of a key in one slice: choose ``slice_width`` for the rate.
    """
    pane = gcd(micros(size), micros(slide))
    piece = gcd(pane, micros(slice_width) if slice_width else max(1, pane // SLICES_PER_WINDOW))
    keys, zero = list(keys), F.lit(0.0)
    rows = (
        chosen(positions, entities)
        .select(*keys, "ts", "seq", F.col("x").cast("double"), F.col("y").cast("double"))
        .withWatermark("ts", delay)
    )
    slices = rows.groupBy(F.window("ts", span(piece)).alias("slice"), *keys).agg(in_order("ts", "seq", "x", "y").alias("rows"))
    steps = pairs(F.col("rows"), lambda a, b: distance(a["x"], a["y"], b["x"], b["y"]))
    slices = slices.select(
        "slice",
        *keys,
        F.struct(
            F.col("slice.start").alias("at"),
            F.size("rows").cast("long").alias("n"),
            total(steps, zero).alias("inner"),
            F.col("rows")[0].alias("first"),
            F.element_at("rows", -1).alias("last"),
        ).alias("piece"),
    )
    panes = _joined(slices.groupBy(F.window("slice", span(pane)).alias("pane"), *keys)).select(
        "pane",
        *keys,
        F.struct(
            F.col("pane.start").alias("at"), "n", "inner", F.col("pieces")[0]["first"].alias("first"),
            F.element_at("pieces", -1)["last"].alias("last"),
        ).alias("piece"),
    )
    windows = _joined(panes.groupBy(F.window("pane", span(micros(size)), span(micros(slide))).alias("win"), *keys))
    return windows.select(
        *keys, F.col("win.start").alias("window_start"), F.col("win.end").alias("window_end"), (F.col("inner") / F.col("n")).alias("avg_step")
    )


def _joined(grouped) -> DataFrame:
    """Adds to each group its pieces in order, their rows ``n`` and the length ``inner`` of the way through them."""
    rows = grouped.agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    bridges = pairs(F.col("pieces"), lambda a, b: distance(a["last"]["x"], a["last"]["y"], b["first"]["x"], b["first"]["y"]))
    walked = field_total("pieces", "inner", F.lit(0.0)) + total(bridges, F.lit(0.0))
    return rows.withColumn("inner", walked).withColumn("n", field_total("pieces", "n", F.lit(0).cast("long")))


BEST_SCHEMA = "window_start TIMESTAMP, window_end TIMESTAMP, avg_step DOUBLE"


def best_so_far(batch: DataFrame, known: DataFrame | None) -> DataFrame:
    """Best window of a finished batch and of what was known before."""
    windows = batch.select("window_start", "window_end", "avg_step")
    return best_window(windows if known is None else windows.unionByName(known))


def read_best(spark: SparkSession, path: str) -> DataFrame:
    """The best window that ``track_best`` has recorded below ``path``."""
    return best_window(spark.read.schema(f"{BEST_SCHEMA}, batch LONG").parquet(path).drop("batch"))


def track_best(
    windows: DataFrame, path: str, checkpoint: str | None = None, available_now: bool = True
) -> StreamingQuery:
    """Starts a query that keeps the best of all windows a stream has finished.

    Each micro-batch records the best so far under its own batch number, so a repeated batch
    replaces its own record and changes nothing else. It needs only the newest record before its own,
    and older ones are dropped, so there are never more than three. Read it with ``read_best``.
    """
    spark = windows.sparkSession
    checkpoint = checkpoint or new_run_dir(spark, "best")

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if not exists(session, path):
            session.createDataFrame([], BEST_SCHEMA).write.mode("overwrite").parquet(f"{path}/batch=-1")
        earlier = session.read.schema(f"{BEST_SCHEMA}, batch LONG").parquet(path).where(F.col("batch") < number)
        newest = earlier.agg(F.max("batch")).first()[0]
        known = earlier.where(F.col("batch") == (-1 if newest is None else newest)).drop("batch")
        best_so_far(batch, known).write.mode("overwrite").parquet(f"{path}/batch={number}")
        if newest is not None:
            drop_older(session, path, "batch", newest)

    writer = windows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(merge)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
