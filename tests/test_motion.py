import math
import random
import re
from datetime import timezone

import pytest
from pyspark.sql import functions as F

from fieldtally.functions import PENALTY_AREAS, Zone, pico_to_timestamp
from fieldtally.operators import motion
from fixtures import STEP_EVENTS, STEP_WINDOWS, ZONE_EVENTS

MINUTE = 60_000


def counts(rows, exits):
    return {(row[0], row[2]): row[3] for row in rows(exits)}


@pytest.mark.parametrize(
    ("scope", "expected"),
    [
        ("interleaved", {(0, "TeamA"): 1, (0, "TeamB"): 0, (MINUTE, "TeamA"): 2, (MINUTE, "TeamB"): 0}),
        ("per_entity", {(0, "TeamA"): 1, (0, "TeamB"): 0, (MINUTE, "TeamA"): 1, (MINUTE, "TeamB"): 0}),
    ],
)
def test_zone_exits(positions, rows, scope, expected):
    exits = motion.zone_exits(positions(ZONE_EVENTS), PENALTY_AREAS, scope=scope)
    assert counts(rows, exits) == expected
    total = rows(motion.rollup_exits(exits), "zone", "exits")
    assert total == [("TeamA", sum(v for (_, z), v in expected.items() if z == "TeamA")), ("TeamB", 0)]


def test_unknown_scope(positions):
    with pytest.raises(ValueError, match="scope"):
        motion.zone_exits(positions(ZONE_EVENTS), PENALTY_AREAS, scope="team")


def test_rollup_takes_windows_by_their_end(positions, rows):
    events = [(4, 36_000_000 - MINUTE, 20000, 20000), (4, 36_000_000 - 1, 0, 0), (4, 36_000_000, 20000, 20000), (4, 36_000_001, 0, 0)]
    total = rows(motion.rollup_exits(motion.zone_exits(positions(events), PENALTY_AREAS)), "window_start", "zone", "exits")
    assert total == [(0, "TeamA", 1), (0, "TeamB", 0), (36_000_000, "TeamA", 1), (36_000_000, "TeamB", 0)]


def test_zone_flags_have_open_bounds(positions, rows):
    flags = motion.zone_flags(positions([(4, 0, 6300, 20000), (4, 1, 6301, 15941), (4, 2, 46182, -15966)]), PENALTY_AREAS)
    assert rows(flags, "seq", "in_TeamA", "in_TeamB") == [(0, False, False), (1, True, False), (2, False, True)]


def test_entity_list(positions, rows):
    assert rows(motion.only_entities(positions(ZONE_EVENTS), [8, 12]), "seq") == [(1,), (3,), (5,)]


def test_avg_step(positions, rows):
    found = rows(motion.avg_step(positions(STEP_EVENTS)))
    assert [(start, end - start) for start, end, _ in found] == [(start, 5 * MINUTE) for start, _ in STEP_WINDOWS]
    assert [value for *_, value in found] == pytest.approx([value for _, value in STEP_WINDOWS], abs=1e-12)


def test_best_window_and_running_best(positions, rows):
    windows = motion.avg_step(positions(STEP_EVENTS))
    assert rows(motion.best_window(windows)) == [(-240000, 60000, 2.5)]
    late = motion.running_best(windows, F.timestamp_millis(F.lit(360000)))
    assert rows(late) == [(60000, 360000, -240000, 60000, 2.5), (120000, 420000, -240000, 60000, 2.5)]
    assert rows(motion.running_best(windows, block="1 minute")) == rows(motion.running_best(windows))


def test_best_window_of_nothing(positions, rows):
    assert rows(motion.best_window(motion.avg_step(positions([])))) == []


def recording(n=400, seed=3):
    """A third of all rows share one instant, and one entity has half of the rows."""
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        ms = 125_000 if rng.random() < 0.34 else rng.randrange(-200_000, 900_000)
        entity = 4 if rng.random() < 0.5 else rng.choice([8, 10, 12])
        out.append((entity, ms, rng.randrange(0, 100), rng.randrange(0, 100), seq))
    rng.shuffle(out)
    return out


ZONES = (Zone("P", 20, 80, 50, 90), Zone("Q", 20, 80, 5, 45), Zone("R", 0, 30, -1, 200))


def brute_exits(events, scope):
    result = {}
    groups = {}
    for event in sorted(events, key=lambda e: (e[1], e[4])):
        start = event[1] // MINUTE * MINUTE
        for zone in ZONES:
            result.setdefault((start, zone.name), 0)
        groups.setdefault((start, event[0] if scope == "per_entity" else None), []).append(event)
    for (start, _), group in groups.items():
        for before, now in zip(group, group[1:]):
            for zone in ZONES:
                inside = [zone.x_low < e[2] < zone.x_high and zone.y_low < e[3] < zone.y_high for e in (before, now)]
                result[start, zone.name] += inside == [True, False]
    return result


@pytest.mark.parametrize("scope", ["interleaved", "per_entity"])
def test_hot_windows_against_brute_force(positions, rows, scope):
    events = recording()
    exits = motion.zone_exits(positions(events), ZONES, scope=scope)
    assert counts(rows, exits) == brute_exits(events, scope)


def brute_steps(events):
    ordered = sorted(events, key=lambda e: (e[1], e[4]))
    steps = {ordered[0][4]: 0.0} if ordered else {}
    for a, b in zip(ordered, ordered[1:]):
        steps[b[4]] = math.hypot(b[2] - a[2], b[3] - a[3])
    return steps


def test_steps_against_brute_force(positions, rows):
    events = recording()
    steps = motion.step_distances(positions(events))
    assert dict(rows(steps, "seq", "step")) == pytest.approx(brute_steps(events))
    by_entity = motion.step_distances(positions(events), keys=["entity"])
    expected = {}
    for entity in {e[0] for e in events}:
        expected.update(brute_steps([e for e in events if e[0] == entity]))
    assert dict(rows(by_entity, "seq", "step")) == pytest.approx(expected)


@pytest.mark.parametrize(("size", "slide"), [(5, 1), (4, 2), (3, 2), (2, 3), (1, 1)])
def test_sliding_mean_against_brute_force(positions, rows, size, slide):
    events = recording(300)
    expected = {}
    first = min(e[1] for e in events) // MINUTE - size - slide
    for start in range(first - first % slide, 16, slide):
        inside = [e for e in events if start * MINUTE <= e[1] < (start + size) * MINUTE]
        if inside:
            expected[start * MINUTE] = sum(brute_steps(inside).values()) / len(inside)
    windows = motion.avg_step(positions(events), f"{size} minutes", f"{slide} minutes")
    assert {row[0]: row[2] for row in rows(windows)} == pytest.approx(expected)
    best = rows(motion.best_window(windows))[0]
    top = max(expected.values())
    assert best[2] == pytest.approx(top)
    so_far, running = 0.0, {}
    for start in sorted(expected):
        so_far = max(so_far, expected[start])
        running[start] = so_far
    assert {row[0]: row[4] for row in rows(motion.running_best(windows, block="3 minutes"))} == pytest.approx(running)


def test_hot_slice_is_spread_over_tasks(positions):
    """Rows of one instant end up in several pieces, and no piece holds most of them."""
    from fieldtally.operators.ordered import cut, slice_of

    events = [(4, 1000, n % 7, n % 5, n) for n in range(4000)] + [(4, 5000 + n, 1, 1, 5000 + n) for n in range(50)]
    pieces = cut(positions(events), ["entity"], ["ts", "seq"], slice_of(F.col("ts"), 1_000_000))
    sizes = {tuple(row)[:2]: row["count"] for row in pieces.groupBy("_slice", "_part").count().collect()}
    hot = [n for (start, _), n in sizes.items() if start == 1_000_000]
    assert sum(hot) == 4000 and len(hot) >= 4 and max(hot) < 2000


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_steps_over_many_parts_equal_a_plain_lag(spark, reuse):
    """More rows than the sample of a range exchange, in one instant-rich slice, with a kept extra column."""
    from pyspark.sql import Window as W

    kept = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        n = F.col("id")
        events = spark.range(250_000).select(
            F.timestamp_millis(n % 50).alias("ts"), n.alias("seq"), F.lit(4).alias("entity"),
            (F.xxhash64(n) % 1000).cast("double").alias("x"), (F.xxhash64(n, n) % 1000).cast("double").alias("y"),
        )
        steps = motion.step_distances(events).select("seq", "entity", "step")
        w = W.orderBy("ts", "seq")
        plain = events.select("seq", F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)).alias("plain"))
        wrong = steps.join(plain, "seq").where("abs(step - coalesce(plain, 0)) > 1e-6")
        assert wrong.count() == 0 and steps.count() == 250_000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_any_number_of_zones(positions, rows):
    from fieldtally.functions import Zone

    zones = [Zone(f"z{n}", n, n + 2, -1, 1) for n in range(70)]
    found = motion.zone_exits(positions([(4, k, k + 1, 0) for k in range(71)]), zones)
    assert {row[2]: row[3] for row in rows(found)} == {f"z{n}": 1 for n in range(70)}


def test_no_python_in_the_plans(positions):
    for df in (
        motion.zone_exits(positions(ZONE_EVENTS), PENALTY_AREAS),
        motion.running_best(motion.avg_step(positions(STEP_EVENTS))),
        motion.step_distances(positions(STEP_EVENTS)),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_running_best_reads_its_windows_once(positions):
    best = motion.running_best(motion.avg_step(positions(STEP_EVENTS)))
    best.collect()
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan[: plan.index("Initial Plan")]


def test_pico_time(spark, rows):
    picos = spark.createDataFrame([("14879639146403495",), ("-1999999999",), ("170000000000000000000000",)], "ps STRING")
    assert rows(picos.select(F.unix_millis(pico_to_timestamp(F.col("ps"))))) == [(-1,), (14879639,), (170000000000000,)]


def plain_windows(events, size, slide):
    """(key, start) -> mean step, from every row of every window."""
    found = {}
    for key in {e[0] for e in events}:
        own = sorted((e[1], e[4], e[2], e[3]) for e in events if e[0] == key)
        for ms in {w for t, *_ in own for w in range((t - size) // slide * slide + slide, t + 1, slide) if t - size < w <= t}:
            inside = [r for r in own if ms <= r[0] < ms + size]
            steps = [math.dist(a[2:], b[2:]) for a, b in zip(inside, inside[1:])]
            found[key, ms] = sum(steps) / len(inside)
    return found


@pytest.mark.parametrize(("size", "slide"), [(5, 1), (6, 4), (4, 6), (7, 7), (30, 1), (1, 10), (12, 5)])
@pytest.mark.parametrize("copies", [0, 16])
def test_windows_by_blocks_equal_all_rows_of_each_window(spark, positions, monkeypatch, size, slide, copies):
    monkeypatch.setattr(motion, "FEW_COPIES", copies)
    rng = random.Random(size * 100 + slide)
    events = []
    for n in range(160):
        at = rng.choice([rng.randrange(-60_000, 60_000), rng.randrange(4) * 1000, rng.randrange(400_000, 420_000)])
        events.append((rng.randrange(3), at, rng.randrange(50), rng.randrange(50), n))
    found = motion.avg_step(positions(events), f"{size} seconds", f"{slide} seconds", ["entity"])
    got = {(r.entity, round(r.window_start.replace(tzinfo=timezone.utc).timestamp() * 1000)): r.avg_step for r in found.collect()}
    expected = plain_windows(events, size * 1000, slide * 1000)
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(v, abs=1e-9) for k, v in expected.items())


def test_windows_of_many_panes_cost_rows_by_windows(spark, positions):
    """5 hours by 1 second: 18,000 panes a window. Every generated row is one window's head or tail."""
    events = [(1, 1000 * n + 7, n % 13, n % 7, n) for n in range(3000)]
    summary = motion.pane_summaries(positions(events), ["entity"], "5 hours", "1 second")
    windows = motion.combine_panes(summary, ["entity"], "5 hours", "1 second")
    found = {round(r.window_start.replace(tzinfo=timezone.utc).timestamp()): r.avg_step for r in windows.collect()}
    assert len(found) == 18_000 + 2_999
    steps = [math.dist((n % 13, n % 7), ((n + 1) % 13, (n + 1) % 7)) for n in range(2999)]
    for start in (-17_999, -17_000, -15_001, -12, 0, 1, 1500, 2999):
        inside = [n for n in range(3000) if start <= n + 0.007 < start + 18_000]
        assert found[start] == pytest.approx(sum(steps[inside[0] : inside[-1]]) / len(inside), abs=1e-9)
    made = [int(x) for x in re.findall(r"Generate.*?rows: (\d+)", generated_rows(windows))]
    assert made and sum(made) == 2 * len(found)


def generated_rows(df):
    """The rows that each Generate node of the finished plan has put out."""
    df._jdf.collectToPython()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.nodeName() == "Generate":
            out.append(f"Generate rows: {node.metrics().apply('numOutputRows').value()}")
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return "\n".join(out)
