"""Motion analytics on position tables: zone exits and mean step length.

A position table has ``ts`` (TIMESTAMP), ``seq`` (orders rows of one instant), ``x`` and
``y``; for per-entity questions also ``entity``. The streaming forms in
``fieldtally.streaming.motion`` use the same columns and give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldtally.functions import Zone, bit, distance, in_zone, left_zones, zone_mask
from fieldtally.operators.ordered import PIECE, across_pieces, cut, in_piece, micros, slice_of, with_previous

ORDER = ("ts", "seq")
SLICES_PER_WINDOW = 16
FEW_COPIES = 16  #: windows that hold a pane, up to which panes are copied


def only_entities(positions: DataFrame, entities: Sequence, column: str = "entity") -> DataFrame:
    """Positions of the listed entities; the list reaches the scan as an IN filter."""
    return positions.where(F.col(column).isin(list(entities)))


def zone_flags(positions: DataFrame, zones: Sequence[Zone]) -> DataFrame:
    """One BOOLEAN ``in_<zone>`` per zone."""
    return positions.select("*", *[in_zone(zone, F.col("x"), F.col("y")).alias(f"in_{zone.name}") for zone in zones])


def window_bounds(ts: Column, width: str) -> list[Column]:
    """Start and end of the epoch-aligned window of ``width`` that holds ``ts``."""
    size = micros(width)
    start = slice_of(ts, size)
    return [F.timestamp_micros(start).alias("window_start"), F.timestamp_micros(start + F.lit(size)).alias("window_end")]


def zone_rows(counts: DataFrame, zones: Sequence[Zone]) -> DataFrame:
    """One row per window and zone from one ``exits_<n>`` column per zone; zeros stay."""
    per_zone = [F.struct(F.lit(zone.name).alias("zone"), F.col(f"exits_{n}").alias("exits")) for n, zone in enumerate(zones)]
    return counts.select("window_start", "window_end", F.inline(F.array(*per_zone)))


def zone_exits(
    positions: DataFrame,
    zones: Sequence[Zone],
    width: str = "1 minute",
    scope: str = "per_entity",
) -> DataFrame:
    """How often an object leaves each zone, per tumbling window.

    An exit is a row outside a zone whose previous row of the same window was inside. With
    ``scope="per_entity"`` the previous row is that of the same entity; ``"interleaved"``
    takes the previous row of any entity. Each window starts anew. Every window with a row
    gives one row per zone, zeros included.
    """
    if scope not in ("per_entity", "interleaved"):
        raise ValueError(f"unknown scope {scope!r}")
    keys = ["window_start", "entity"] if scope == "per_entity" else ["window_start"]
    size = micros(width)
    start = window_bounds(F.col("ts"), width)[0]
    rows = positions.select(
        start, *keys[1:], *ORDER, zone_mask(zones, F.col("x"), F.col("y")).alias("mask")
    ).where(F.col("ts").isNotNull())
    slices = slice_of(F.col("ts"), max(1, size // SLICES_PER_WINDOW))
    pieces = cut(rows, keys, ORDER, slices)
    inside = in_piece(keys, ORDER)
    steps = pieces.select(
        *keys, *PIECE, "mask", F.lag("mask").over(inside).alias("before"), F.lead("mask").over(inside).alias("after")
    ).withColumn("left", left_zones(F.col("before"), F.col("mask")))
    summary = steps.groupBy(*keys, *PIECE).agg(
        *[F.sum(bit(F.col("left"), n)).alias(f"exits_{n}") for n in range(len(zones))],
        F.max(F.when(F.col("before").isNull(), F.col("mask"))).alias("first_mask"),
        F.max(F.when(F.col("after").isNull(), F.col("mask"))).alias("last_mask"),
    )
    border = left_zones(F.lag("last_mask").over(across_pieces(keys)), F.col("first_mask"))
    counts = (
        summary.withColumn("border", border)
        .groupBy("window_start")
        .agg(*[F.sum(F.col(f"exits_{n}") + bit(F.col("border"), n)).alias(f"exits_{n}") for n in range(len(zones))])
        .withColumn("window_end", F.timestamp_micros(F.unix_micros("window_start") + F.lit(size)))
    )
    return zone_rows(counts, zones)


def rollup_exits(exits: DataFrame, width: str = "10 hours") -> DataFrame:
    """Exits per zone over larger tumbling windows. A window counts where it ends."""
    inside_end = F.timestamp_micros(F.unix_micros("window_end") - F.lit(1))
    start, end = window_bounds(inside_end, width)
    return (
        exits.select(start, end, "zone", "exits")
        .groupBy("window_start", "window_end", "zone")
        .agg(F.sum("exits").alias("exits"))
    )


def step_distances(positions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every position with the distance to the one before it as ``step`` (0 for the first)."""
    before = with_previous(positions, keys, ORDER, ["x", "y"])
    step = distance(F.col("previous_x"), F.col("previous_y"), F.col("x"), F.col("y"))
    return before.withColumn("step", step).drop("previous_x", "previous_y")


def avg_step(
    positions: DataFrame,
    size: str = "5 minutes",
    slide: str = "1 minute",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Mean step length per sliding window.

    The divisor is the number of rows, and the first row of a window has step 0. Rows are
    summed once per pane (the common divisor of size and slide) and never copied into
    overlapping windows; ``combine_panes`` puts windows together from panes.
    """
    return combine_panes(pane_summaries(positions, keys, size, slide), keys, size, slide)


def pane_summaries(positions: DataFrame, keys: Sequence[str], size: str, slide: str) -> DataFrame:
    """Per pane (the common divisor of size and slide) and key the rows ``n``, the length ``inner`` of the way through
    them, and the first and last place; a pane may have several pieces, in the order of (``_slice``, ``_part``)."""
    keys = list(keys)
    pane = gcd(micros(size), micros(slide))
    rows = positions.select(*keys, *ORDER, F.col("x").cast("double"), F.col("y").cast("double")).where(
        F.col("ts").isNotNull()
    )
    pieces = cut(rows, keys, ORDER, slice_of(F.col("ts"), pane))
    inside = in_piece(keys, ORDER)
    steps = pieces.select(
        *keys,
        *PIECE,
        "x",
        "y",
        F.lag("x").over(inside).alias("x0"),
        F.lag("y").over(inside).alias("y0"),
        (F.row_number().over(inside) == 1).alias("is_first"),
        F.lead("_part").over(inside).isNull().alias("is_last"),
    )
    return steps.groupBy(*keys, *PIECE).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(distance(F.col("x0"), F.col("y0"), F.col("x"), F.col("y"))).alias("inner"),
        *[F.max(F.when(F.col("is_first"), F.col(c))).alias(f"first_{c}") for c in ("x", "y")],
        *[F.max(F.when(F.col("is_last"), F.col(c))).alias(f"last_{c}") for c in ("x", "y")],
    )


def combine_panes(summary: DataFrame, keys: Sequence[str], size: str, slide: str) -> DataFrame:
    """Windows from pane summaries: steps inside panes plus steps from pane to pane.

    A window that slides by more than a ``FEW_COPIES``th of its size gets copies of its panes, so that one shuffle brings them together. Beyond that
    copies are what costs, and windows are put together from blocks (``windows_by_blocks``). The rows are the same.
    """
    if micros(size) <= FEW_COPIES * micros(slide):
        return windows_by_copies(summary, keys, size, slide)
    return windows_by_blocks(summary, keys, size, slide)


def windows_by_copies(summary: DataFrame, keys: Sequence[str], size: str, slide: str) -> DataFrame:
    """Windows from a copy of each pane per window that holds it."""
    pane, length, step = F.col("_slice"), F.lit(micros(size)), F.lit(micros(slide))
    earliest = pane - length - F.pmod(pane - length, step) + step
    latest = pane - F.pmod(pane, step)
    # NULL, hence no row, for a pane in the gap between windows that slide further than they are long
    starts = F.when(earliest <= latest, F.sequence(earliest, latest, step))
    panes = summary.withColumn("start", F.explode(starts))
    window = across_pieces([*keys, "start"])
    bridge = distance(
        F.lag("last_x").over(window), F.lag("last_y").over(window), F.col("first_x"), F.col("first_y")
    )
    return (
        panes.withColumn("bridge", bridge)
        .groupBy(*keys, "start")
        .agg(((F.sum("inner") + F.sum("bridge")) / F.sum("n")).alias("avg_step"))
        .select(
            *keys,
            F.timestamp_micros("start").alias("window_start"),
            F.timestamp_micros(F.col("start") + length).alias("window_end"),
            "avg_step",
        )
    )


def windows_by_blocks(summary: DataFrame, keys: Sequence[str], size: str, slide: str) -> DataFrame:
    """Windows from sums over blocks, without copies of panes.

    Time is cut into blocks as long as a window, so a window is the end of one block and the beginning of the next. Sums
    from each pane to the end of its block, and from the block's beginning to each pane, are taken once; a window gets the one of its first pane
    and the other of its last pane. So there are two rows per window and none per pane of a window, however many panes a window has,
    and no sum is longer than a window.
    """
    keys, length, step = list(keys), F.lit(micros(size)), F.lit(micros(slide))
    at = F.col("_slice")
    panes = summary.withColumn("_block", at - F.pmod(at, length))
    block = [*keys, "_block"]
    onward = W.partitionBy(*block).orderBy(*PIECE)
    back = W.partitionBy(*block).orderBy(*[F.desc(c) for c in PIECE])
    bridge = distance(F.lag("last_x").over(onward), F.lag("last_y").over(onward), F.col("first_x"), F.col("first_y"))
    panes = panes.withColumn("_before", F.lag(at).over(onward)).withColumn("_after", F.lead(at).over(onward)).withColumn("bridge", bridge)
    panes = panes.withColumn("to_here", F.struct(F.sum("n").over(onward).alias("n"), F.sum(F.col("inner") + F.col("bridge")).over(onward).alias("walked")))
    following = F.coalesce(F.lag("bridge").over(back), F.lit(0.0))
    panes = panes.withColumn("following", following).withColumn(
        "from_here", F.struct(F.sum("n").over(back).alias("n"), F.sum(F.col("inner") + F.col("following")).over(back).alias("walked"))
    )
    # a row per key and block: its ends, and the pane beside each end
    ends = [F.struct(at.alias("at"), F.col("_part"), F.col(f"{end}_x").alias("x"), F.col(f"{end}_y").alias("y")) for end in ("first", "last")]
    blocks = panes.groupBy(*block).agg(F.min(ends[0]).alias("_first"), F.max(ends[1]).alias("_last"))
    over = W.partitionBy(*keys).orderBy("_block")
    blocks = blocks.select(*block, "_first", "_last", F.lag("_last.at").over(over).alias("_earlier"), F.lead("_first.at").over(over).alias("_later"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"b.{c}")) for c in block]  # a NULL key is a key
    panes = panes.alias("p").join(blocks.alias("b"), same).select(
        *[F.col(f"p.{c}").alias(c) for c in block], "_slice", "to_here", "from_here", "_first", "_last",
        F.coalesce("_before", "_earlier").alias("_before"), F.coalesce("_after", "_later").alias("_after"),
    )

    def starts(low: Column, high: Column) -> Column:
        """Window starts above ``low`` and up to ``high``; NULL, hence no row, if there is none."""
        least, most = low - F.pmod(low, step) + step, high - F.pmod(high, step)
        return F.when(least <= most, F.sequence(least, most, step))

    since = F.greatest("_before", at - length)  # windows whose first pane this is
    until = F.least(at, F.col("_after") - length)  # windows whose last pane this is
    empty = F.lit(None)
    heads = panes.select(*keys, F.explode(starts(since, at)).alias("start"), F.struct("_block", "_last", "from_here").alias("head"), empty.alias("tail"))
    tails = panes.select(*keys, F.explode(starts(at - length, until)).alias("start"), empty.alias("head"), F.struct("_block", "_first", "to_here").alias("tail"))
    windows = heads.union(tails).groupBy(*keys, "start").agg(F.max("head").alias("h"), F.max("tail").alias("t"))
    apart = F.col("h._block") != F.col("t._block")
    whole = F.col("t._block") >= F.col("start")  # the only block begins in the window
    between = distance(F.col("h._last.x"), F.col("h._last.y"), F.col("t._first.x"), F.col("t._first.y"))
    joined = {c: F.col(f"h.from_here.{c}") + F.col(f"t.to_here.{c}") for c in ("n", "walked")}
    alone = {c: F.when(whole, F.col(f"t.to_here.{c}")).otherwise(F.col(f"h.from_here.{c}")) for c in ("n", "walked")}
    mean = F.when(apart, (joined["walked"] + between) / joined["n"]).otherwise(alone["walked"] / alone["n"])
    return windows.select(
        *keys,
        F.timestamp_micros("start").alias("window_start"),
        F.timestamp_micros(F.col("start") + length).alias("window_end"),
        mean.alias("avg_step"),
    )


def running_best(windows: DataFrame, emit_from: Column | None = None, block: str = "1 day") -> DataFrame:
    """Per window the best window so far in end order; of equals the earliest.

    ``emit_from`` keeps the windows that end at or after that time, each with the best over
    *all* earlier windows. A running maximum over everything would need one task, so it is
    taken inside blocks of time and over the blocks' maxima: only one row per ``block`` of
    recorded time meets in one task.
    """
    rank = F.struct(F.col("avg_step"), (-F.unix_micros("window_start")).alias("start"), F.col("window_end").alias("end"))
    in_block = slice_of(F.col("window_end"), micros(block)).alias("_block")
    ranked = windows.select("window_start", "window_end", rank.alias("rank"), in_block)
    blocks = ranked.groupBy("_block").agg(F.max("rank").alias("top"))
    earlier = blocks.select(
        F.col("_block").alias("_b"),
        F.max("top").over(W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)).alias("earlier"),
    )
    so_far = F.max("rank").over(W.partitionBy("_block").orderBy("window_end").rowsBetween(W.unboundedPreceding, 0))
    # null-safe, because a plain equality lets Catalyst add a filter to each side, and the two
    # uses of ``windows`` would then no longer share their shuffles
    best = (
        ranked.withColumn("so_far", so_far)
        .join(earlier, F.col("_block").eqNullSafe(F.col("_b")))
        .withColumn("best", F.greatest("so_far", "earlier"))
    )
    if emit_from is not None:
        best = best.where(F.col("window_end") >= emit_from)
    return best.select(
        "window_start",
        "window_end",
        F.timestamp_micros(-F.col("best.start")).alias("best_start"),
        F.col("best.end").alias("best_end"),
        F.col("best.avg_step").alias("best_avg"),
    )


def best_window(windows: DataFrame) -> DataFrame:
    """The one window with the highest mean step; of equals the earliest. Partial maxima."""
    rank = F.struct(F.col("avg_step"), (-F.unix_micros("window_start")).alias("start"), F.col("window_end").alias("end"))
    return (
        windows.agg(F.max(rank).alias("best"))
        .where(F.col("best").isNotNull())
        .select(
            F.timestamp_micros(-F.col("best.start")).alias("window_start"),
            F.col("best.end").alias("window_end"),
            F.col("best.avg_step").alias("avg_step"),
        )
    )
