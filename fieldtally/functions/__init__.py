from fieldtally.functions.columns import (
    BALL_SENSORS,
    EMIT_FROM_MS,
    PENALTY_AREAS,
    PLAYER_SENSOR,
    Zone,
    bit,
    bounded_below,
    cost_text,
    distance,
    in_zone,
    left_zones,
    path_text,
    pico_to_timestamp,
    zone_mask,
)

__all__ = [
    "BALL_SENSORS",
    "EMIT_FROM_MS",
    "PENALTY_AREAS",
    "PLAYER_SENSOR",
    "Zone",
    "bit",
    "bounded_below",
    "cost_text",
    "distance",
    "in_zone",
    "left_zones",
    "path_text",
    "pico_to_timestamp",
    "zone_mask",
]
