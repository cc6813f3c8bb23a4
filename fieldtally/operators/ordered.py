"""Time order at scale: cutting ordered groups into pieces that fit one task.

"The previous row" needs sorted rows, and a plain window function sorts a whole group in one
task: a window, or an entity, with a third of all rows would stop the job. Here all rows, whatever
their number, are range-partitioned once on the full order, which splits groups of any size, even rows of
one and the same instant, into even parts. A piece is what one part has of one group (and of one slice
of time, where slices matter). What crosses the border between pieces is repaired afterwards from one
row per piece.

The borders of the parts come from a sample, so two evaluations may cut differently. Pieces that are used
once may stay in the plan; for a second use they are written to the shared folder first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldtally.workspace import new_run_dir, shuffle_partitions

PIECE = ("_slice", "_part")


def micros(interval: str) -> int:
    """Length of an interval such as ``"5 minutes"`` in microseconds."""
    amount, unit = interval.split()
    lengths = {
        "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
        "hour": 3_600_000_000, "day": 86_400_000_000,
    }
    return int(amount) * lengths[unit.lower().removesuffix("s")]


def slice_of(ts: Column, width: int) -> Column:
    """Start of the epoch-aligned slice of ``width`` microseconds, in microseconds.

    Whole-number arithmetic: exact at any distance from the epoch, on both sides of it.
    """
    instant = F.unix_micros(ts)
    return instant - F.pmod(instant, F.lit(width).cast("long"))


def cut(rows: DataFrame, keys: Sequence[str], order: Sequence[str], slice_column: Column) -> DataFrame:
    """Adds the piece columns ``_slice`` and ``_part`` to ``rows``, for one use of the result.

    Within one combination of ``keys`` the pieces are contiguous in ``order`` and sorted by
    (``_slice``, ``_part``). ``slice_column`` must not decrease along ``order``.
    """
    rows = rows.withColumn("_slice", slice_column)
    parts = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys, "_slice", *order)
    return parts.withColumn("_part", F.spark_partition_id())


def in_piece(keys: Sequence[str], order: Sequence[str]) -> W:
    return W.partitionBy(*keys, *PIECE).orderBy(*order)


def across_pieces(keys: Sequence[str]) -> W:
    """Pieces of a group in order. Only for tables with one row per piece."""
    return W.partitionBy(*keys).orderBy(*PIECE)


def with_previous(rows: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Every row with the ``carry`` columns of the row before it in its group.

    The earlier values are named ``previous_<column>`` and are NULL in the first row. Each
    piece gets a copy of the last row of the piece before it, so that one pass over the piece
    is enough; the copies are dropped again. They are found with partial aggregates. The pieces are
    written below the shared folder when called, because both uses need the same ones.
    """
    spark = rows.sparkSession
    pieces = cut(rows, keys, order, F.lit(0).cast("long"))
    folder = new_run_dir(spark, "pieces")
    pieces.write.parquet(folder)
    pieces = spark.read.schema(pieces.schema).parquet(folder)
    kept = [name for name in pieces.columns if name not in PIECE]
    needed = list(dict.fromkeys([*order, *carry]))
    last = pieces.groupBy(*keys, *PIECE).agg(F.max(F.struct(*needed)).alias("_last"))
    following = across_pieces(keys)
    copies = (
        last.select(
            *keys, "_last", *[F.lead(name).over(following).alias(f"_next{name}") for name in PIECE]
        )
        .where(F.col("_next_slice").isNotNull())
        .select(
            *keys,
            *[F.col("_last")[name].alias(name) for name in needed if name not in keys],
            *[F.col(f"_next{name}").alias(name) for name in PIECE],
            F.lit(True).alias("_copy"),
        )
    )
    together = pieces.withColumn("_copy", F.lit(False)).unionByName(copies, allowMissingColumns=True)
    window = in_piece(keys, order)
    return (
        together.select("*", *[F.lag(name).over(window).alias(f"previous_{name}") for name in carry])
        .where(~F.col("_copy"))
        .select(*kept, *[f"previous_{name}" for name in carry])
    )


def ranked(rows: DataFrame, order_by: Sequence[str], as_text: bool = True, rank: str = "rank") -> DataFrame:
    """``rows`` with their place in the whole table's order, gapless from 1; the order that ``write_table(order_by=...)`` writes.

    Columns are compared as text (10 before 9) unless ``as_text`` is off, NULL first; the other columns break ties, and rows alike in all
    columns get the places in any order among themselves. A rank over everything would sort all rows in one task. Here rows are
    range-partitioned, ranked inside their part, and moved on by the rows of the parts before, of which only the numbers
    meet. The parts are written below the shared folder when called, because both uses need the same ones.
    """
    spark = rows.sparkSession
    first = [F.col(f"`{c}`").cast("string") if as_text else F.col(f"`{c}`") for c in order_by]
    order = [*first, *[F.col(f"`{c}`") for c in rows.columns if c not in order_by]]
    keys = [c.alias(f"_key_{n}") for n, c in enumerate(order)]
    names = [f"_key_{n}" for n in range(len(order))]
    parts = rows.select("*", *keys).repartitionByRange(shuffle_partitions(spark), *names).withColumn("_part", F.spark_partition_id())
    folder = new_run_dir(spark, "ranked")
    parts.write.parquet(folder)
    parts = spark.read.schema(parts.schema).parquet(folder)
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per part
    counts = counts.select(F.col("_part").alias("_p"), F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(*names))
    placed = parts.withColumn("_inside", inside).join(counts, F.col("_part") == F.col("_p"))
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_before") + F.col("_inside")).alias(rank))
