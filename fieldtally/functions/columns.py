"""Column expressions shared by the batch and the streaming operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

PICOS_PER_MILLI = 1_000_000_000


@dataclass(frozen=True)
class Zone:
    """A named open rectangle: every bound is exclusive."""

    name: str
    x_low: float
    x_high: float
    y_low: float
    y_high: float


# The two penalty areas, the ball sensors and the watched player of the
# football recording, in the coordinates and ids of that recording.
PENALTY_AREAS = (
    Zone("TeamA", 6300, 46183, 15940, 33940),
    Zone("TeamB", 6300, 46183, -33968, -15965),
)
BALL_SENSORS = (4, 8, 10, 12)
PLAYER_SENSOR = 47
EMIT_FROM_MS = 15_180_000


def pico_to_timestamp(picos: Column) -> Column:
    """Event time of a picosecond counter, cut to whole milliseconds."""
    whole = picos.cast("decimal(38,0)")
    return F.timestamp_millis(F.call_function("div", whole, F.lit(PICOS_PER_MILLI).cast("decimal(38,0)")))


def in_zone(zone: Zone, x: Column, y: Column) -> Column:
    inside = (x > zone.x_low) & (x < zone.x_high) & (y > zone.y_low) & (y < zone.y_high)
    return F.coalesce(inside, F.lit(False))


def zone_mask(zones: Sequence[Zone], x: Column, y: Column) -> Column:
    """One flag per zone, for any number of zones."""
    return F.array(*[in_zone(zone, x, y) for zone in zones])


def left_zones(before: Column, now: Column) -> Column:
    """Flags of the zones the object was in ``before`` and is not in ``now``; none without a ``before``."""
    return F.coalesce(F.zip_with(before, now, lambda was, is_in: was & ~is_in), F.transform(now, lambda _: F.lit(False)))


def bit(mask: Column, position: int) -> Column:
    """1 where the flag at ``position`` is set, else 0."""
    return F.coalesce(F.get(mask, F.lit(position)).cast("long"), F.lit(0).cast("long"))


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Length of one step in the plane; 0 where there is no earlier position."""
    return F.coalesce(F.sqrt(F.pow(x1 - x0, 2) + F.pow(y1 - y0, 2)), F.lit(0.0))


def bounded_below(column: Column, bound: Column, inclusive: bool) -> Column:
    return column >= bound if inclusive else column > bound


def path_text(path: Column, separator: str = ", ") -> Column:
    """Path as text; empty for a vertex that cannot be reached."""
    return F.coalesce(F.array_join(path, separator), F.lit(""))


def cost_text(hops: Column) -> Column:
    return F.coalesce(hops.cast("string"), F.lit("Inf"))
