"""Hand-made inputs of FIXTURES.md."""

TOY_EDGES = [
    (17274, 2), (17274, 3), (17274, 4), (17274, 7), (2, 4), (3, 6), (3, 5),
    (3, 2), (2, 5), (4, 7), (6, 7), (5, 7), (5, 4),
]

ZONE_EVENTS = [
    (4, 0, 20000, 20000),
    (8, 1000, 0, 0),
    (4, 2000, 0, 0),
    (8, 3000, 20000, -20000),
    (4, 61000, 20000, 20000),
    (8, 62000, 0, 0),
    (10, 62500, 6300, 20000),
    (10, 63000, 20000, 20000),
    (10, 63500, 20000, 33940),
]

STEP_EVENTS = [(47, 0, 0, 0), (47, 30000, 3, 4), (47, 90000, 3, 4), (47, 150000, 6, 8)]
STEP_WINDOWS = [
    (-240000, 2.5), (-180000, 5 / 3), (-120000, 2.5), (-60000, 2.5), (0, 2.5), (60000, 2.5), (120000, 0.0),
]


def position_line(event) -> str:
    sensor, ms, x, y = event[:4]
    return ",".join(str(v) for v in (sensor, ms * 10**9, x, y, *[0] * 9))
