"""Questions about many zones that lie in a table, by a grid index.

Zones (``zone``, ``x_low``, ``x_high``, ``y_low``, ``y_high``; all bounds exclusive) are filed under the grid cells that they touch, one row per
cell with its candidates. A point looks up its own cell by an equi-join and tests the few candidates exactly, so no point
meets all zones and no zone all points. A point carries the names of the zones it is in, not a flag per zone. Catalyst sends the
grid to the points while it is small and shuffles both by cell beyond that, where AQE splits a cell that holds many points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.motion import ORDER, window_bounds
from fieldtally.operators.ordered import micros, with_previous

BOUNDS = ("x_low", "x_high", "y_low", "y_high")


def cell_size(zones: DataFrame) -> tuple[float, float]:
    """Width and height of a grid cell: the zones' means, so that a zone touches a few cells."""
    usable = zones.where((F.col("x_low") < F.col("x_high")) & (F.col("y_low") < F.col("y_high")))
    found = usable.agg(F.avg(F.col("x_high") - F.col("x_low")), F.avg(F.col("y_high") - F.col("y_low"))).first()
    return (found[0] or 1.0, found[1] or 1.0)


def _cell(at: Column, size: float) -> Column:
    return F.floor(at / F.lit(size))


def zone_grid(zones: DataFrame, cell: tuple[float, float]) -> DataFrame:
    """(cell_x, cell_y, candidates): each touched cell with its zones. A zone without inside, or with a NULL bound, touches none; repeated
    rows of one zone are one, and rows of one name with other bounds make it a zone of several parts."""
    usable = zones.select(F.col("zone").cast("string").alias("zone"), *[F.col(c).cast("double").alias(c) for c in BOUNDS]).distinct()
    usable = usable.where((F.col("x_low") < F.col("x_high")) & (F.col("y_low") < F.col("y_high")))
    cells = usable
    for axis, size in zip("xy", cell, strict=True):
        touched = F.sequence(_cell(F.col(f"{axis}_low"), size), _cell(F.col(f"{axis}_high"), size))
        cells = cells.withColumn(f"cell_{axis}", F.explode(touched))
    return cells.groupBy("cell_x", "cell_y").agg(F.collect_list(F.struct("zone", *BOUNDS)).alias("candidates"))  # zones that share a cell


def with_zones(positions: DataFrame, zones: DataFrame, cell: tuple[float, float] | None = None) -> DataFrame:
    """Positions with ``zones``, the sorted names of the zones that they are in; empty where ``x`` or ``y`` is NULL or in no zone.

    ``cell`` is the size of the grid's cells, by default that of a mean zone; it decides how much work there is, never the result.
    """
    cell = cell or cell_size(zones)
    grid = zone_grid(zones, cell).select(F.col("cell_x").alias("_cell_x"), F.col("cell_y").alias("_cell_y"), F.col("candidates").alias("_candidates"))
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    joined = positions.join(grid, (_cell(x, cell[0]) == F.col("_cell_x")) & (_cell(y, cell[1]) == F.col("_cell_y")), "left")

    def inside(zone: Column) -> Column:
        return (x > zone["x_low"]) & (x < zone["x_high"]) & (y > zone["y_low"]) & (y < zone["y_high"])

    names = F.array_sort(F.array_distinct(F.transform(F.filter("_candidates", inside), lambda zone: zone["zone"])))
    return joined.withColumn("zones", F.coalesce(names, F.array().cast("array<string>"))).drop("_cell_x", "_cell_y", "_candidates")


def zone_table_exits(
    positions: DataFrame, zones: DataFrame, width: str = "1 minute", scope: str = "per_entity", cell: tuple[float, float] | None = None,
) -> DataFrame:
    """(window_start, window_end, zone, exits): how often an object leaves each zone of a table, per tumbling window.

    An exit is as in ``zone_exits``. With many zones nearly all counts are zero, so only windows and zones with an exit
    give a row. A window of any size is spread over tasks by ``with_previous``.
    """
    if scope not in ("per_entity", "interleaved"):
        raise ValueError(f"unknown scope {scope!r}")
    keys = ["window_start", "entity"] if scope == "per_entity" else ["window_start"]
    start = window_bounds(F.col("ts"), width)[0]
    rows = with_zones(positions, zones, cell).where(F.col("ts").isNotNull()).select(start, *keys[1:], *ORDER, "zones")
    left = F.array_except("previous_zones", "zones")
    exits = with_previous(rows, keys, ORDER, ["zones"]).select("window_start", F.explode(left).alias("zone"))
    end = F.timestamp_micros(F.unix_micros("window_start") + F.lit(micros(width)))
    return exits.groupBy("window_start", "zone").agg(F.count(F.lit(1)).alias("exits")).select("window_start", end.alias("window_end"), "zone", "exits")
