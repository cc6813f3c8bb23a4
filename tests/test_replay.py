"""Replays published shortest-path results: their paths give the edges, their costs the expectation.

REPLAY_RESULTS names the folders of result files (``source|destination|path|cost`` lines), separated like PATH.
"""

import os
from collections import Counter
from pathlib import Path

import pytest

from fieldtally.operators import graph

FOLDERS = [Path(p) for p in os.environ.get("REPLAY_RESULTS", "").split(os.pathsep) if p]
# Vertices at 0, 1, 2 ... hops of the published results.
HISTOGRAM = [1, 2, 18, 95, 531, 1287, 1408, 574, 168, 53, 14, 7]


@pytest.mark.skipif(not FOLDERS, reason="REPLAY_RESULTS is not set")
def test_published_paths_are_found_again(spark):
    edges, costs = set(), {}
    for folder in FOLDERS:
        for file in sorted(f for f in folder.iterdir() if f.is_file() and not f.name.startswith((".", "_"))):
            for line in file.read_text().splitlines():
                source, dest, path, cost = line.split("|")
                stops = [int(x) for x in path.split(",") if x.strip()]
                if source != "17274" or not stops:
                    continue
                edges |= set(zip(stops, stops[1:]))
                assert costs.setdefault(int(dest), int(cost)) == int(cost) == len(stops) - 1
    frame = spark.createDataFrame(sorted(edges), "src LONG, dst LONG")
    found = {r["id"]: r for r in graph.shortest_paths(frame, 17274).where("hops is not null").collect()}
    assert {i: r["hops"] for i, r in found.items()} == costs | {17274: 0}
    counts = Counter(r["hops"] for r in found.values())
    assert [counts[n] for n in range(12)] == HISTOGRAM and sum(counts.values()) == 4158
    assert all(set(zip(r["path"], r["path"][1:])) <= edges for r in found.values())
