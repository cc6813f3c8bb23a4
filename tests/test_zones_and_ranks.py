"""Zones from a table against testing every point with every zone; global ranks against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from fieldtally.functions import PENALTY_AREAS, Zone
from fieldtally.operators import motion, ranked, with_zones, zone_table_exits
from fieldtally.sinks import write_table
from fixtures import ZONE_EVENTS

ZONES = "zone STRING, x_low DOUBLE, x_high DOUBLE, y_low DOUBLE, y_high DOUBLE"


def zone_rows(rng, n=40):
    out = []
    for k in range(n):
        x, y = rng.randrange(-50, 50), rng.randrange(-50, 50)
        out.append((f"z{k}", x, x + rng.choice([1, 5, 20]), y, y + rng.choice([2, 7, 30])))
    out += [("huge", -1000, 1000, -1000, 1000), ("flat", 0, 0, 0, 10), ("turned", 9, 3, 0, 10), ("open", None, 5, 0, 9)]
    out += [("two", -40, -30, 0, 9), ("two", 30, 40, 0, 9), out[0], out[0]]  # of two parts; repeated rows
    return [(z, *[None if b is None else float(b) for b in bounds]) for z, *bounds in out]


def inside(zones, x, y):
    if x is None or y is None:
        return []
    return sorted({z for z, a, b, c, d in zones if None not in (a, b, c, d) and a < x < b and c < y < d})


@pytest.mark.parametrize("cell", [None, (1.0, 1.0), (7.5, 100.0), (10_000.0, 10_000.0)])
def test_points_in_zones(spark, cell):
    rng = random.Random(5)
    zones = zone_rows(rng)
    points = [(n, rng.choice([rng.uniform(-60, 60), float(rng.randrange(-60, 60))]), float(rng.randrange(-60, 60)), "own") for n in range(400)]
    points += [(500, None, 1.0, "own"), (501, 1.0, None, "own"), (502, 5000.0, 0.0, "own")]
    frame = spark.createDataFrame(points, "seq INT, x DOUBLE, y DOUBLE, zone STRING").repartition(3)
    found = with_zones(frame, spark.createDataFrame(zones, ZONES), cell)
    assert found.columns == ["seq", "x", "y", "zone", "zones"]
    assert {r.seq: r.zones for r in found.collect()} == {n: inside(zones, x, y) for n, x, y, _ in points}


def test_no_zones_and_no_points(spark):
    points = spark.createDataFrame([(1, 2.0, 3.0)], "seq INT, x DOUBLE, y DOUBLE")
    assert with_zones(points, spark.createDataFrame([], ZONES)).first().zones == []
    assert with_zones(points.limit(0), spark.createDataFrame([("a", 0.0, 1.0, 0.0, 1.0)], ZONES)).count() == 0


def test_the_grid_is_an_equality_join(spark):
    zones = spark.createDataFrame([("a", 0.0, 1.0, 0.0, 1.0)], ZONES)
    plan = with_zones(spark.createDataFrame([(1.0, 1.0)], "x DOUBLE, y DOUBLE"), zones)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


@pytest.mark.parametrize("scope", ["per_entity", "interleaved"])
def test_exits_equal_those_of_zones_in_the_plan(positions, rows, spark, scope):
    zones = spark.createDataFrame([(z.name, *map(float, (z.x_low, z.x_high, z.y_low, z.y_high))) for z in PENALTY_AREAS], ZONES)
    plain = [r for r in rows(motion.zone_exits(positions(ZONE_EVENTS), PENALTY_AREAS, scope=scope)) if r[3]]
    assert rows(zone_table_exits(positions(ZONE_EVENTS), zones, scope=scope)) == plain and plain


@pytest.mark.parametrize("scope", ["per_entity", "interleaved"])
def test_exits_from_many_zones(positions, rows, spark, scope):
    """A hot window with a zone of many cells, many points in one cell, and zones that lie over each other."""
    rng = random.Random(6)
    events = [(rng.randrange(3), rng.choice([rng.randrange(60_000), rng.randrange(400_000)]), rng.randrange(-4, 4), rng.randrange(-4, 4), n) for n in range(900)]
    zones = [(f"z{k}", rng.randrange(-5, 3), rng.randrange(1, 6), rng.randrange(-5, 3), rng.randrange(1, 6)) for k in range(30)] + [("wide", -500, 500, -1, 3)]
    plain = [Zone(z, *bounds) for z, *bounds in zones]
    expected = [r for r in rows(motion.zone_exits(positions(events), plain, scope=scope)) if r[3]]
    table = spark.createDataFrame([(z, *map(float, bounds)) for z, *bounds in zones], ZONES)
    assert sorted(rows(zone_table_exits(positions(events), table, scope=scope, cell=(1.0, 1.0)))) == sorted(expected)
    with pytest.raises(ValueError, match="unknown scope"):
        zone_table_exits(positions(events), table, scope="x")


@pytest.mark.parametrize("as_text", [True, False])
def test_ranks(spark, as_text):
    rng = random.Random(7)
    data = [(rng.choice([3, 20, 100, 9, None]), n % 50, "ß" if n % 3 else "a") for n in range(700)] + [(3, 3, "a")] * 5
    frame = spark.createDataFrame(data, "key INT, other INT, rank STRING").repartition(5)
    found = ranked(frame, ["key"], as_text, rank="place")
    assert found.columns == ["key", "other", "rank", "place"]
    rows = sorted((tuple(r) for r in found.collect()), key=lambda r: r[3])
    assert [r[3] for r in rows] == list(range(1, len(data) + 1))
    text = (lambda v: (v is not None, str(v))) if as_text else (lambda v: (v is not None, v or 0))
    assert [r[:3] for r in rows] == sorted(data, key=lambda r: (text(r[0]), r[1], r[2].encode()))
    assert ranked(frame.limit(0), ["key"]).count() == 0


def test_a_hot_key_is_ranked_by_many_tasks(spark):
    """All rows but one share the key; no task ranks more than its part of them."""
    frame = spark.range(20_000).select(F.when(F.col("id") == 7, 1).otherwise(0).alias("key"), "id")
    found = ranked(frame, ["key"])
    assert found.where("rank != id + 1 - cast(id > 7 as int)").where("id != 7").isEmpty() and found.where("id = 7").first().rank == 20_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) <= 2 and all("_n" in plan for _ in single)


def test_ranks_are_the_order_of_the_written_text(spark, tmp_path):
    rows = [(n * 37 % 101, n) for n in range(300)]
    frame = spark.createDataFrame(rows, "key LONG, n LONG").repartition(4)
    write_table(frame, str(tmp_path / "out"), order_by=["key"])
    lines = [line for f in sorted((tmp_path / "out").glob("part-*")) for line in f.read_text().split()]
    placed = sorted(ranked(frame, ["key"]).collect(), key=lambda r: r.rank)
    assert lines == [f"{r.key}|{r.n}" for r in placed]
