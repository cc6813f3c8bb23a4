"""Ordered questions on streams by whole slices: equal to the batch forms, whatever arrives in which micro-batch."""

import importlib
import os

import pytest
from pyspark.sql import functions as F

from fieldtally.functions import BALL_SENSORS, PENALTY_AREAS, PLAYER_SENSOR
from fieldtally.operators import motion
from fieldtally.sources import read_positions, stream_positions
from fieldtally.streaming import account, closed_avg_step, closed_zone_exits, finish_positions, live_running_best, results, set_aside
from fieldtally.streaming.tail import BESTS, EXITS, STEPS, Tail
from fieldtally.workspace import in_name_order
from fixtures import STEP_EVENTS, ZONE_EVENTS, position_line
from test_streaming import as_motion, write_files


def source(spark, tmp_path, **options):
    stream = stream_positions(spark, str(tmp_path / "in"), **({"max_files_per_trigger": 1} | options))
    more = ["_corrupt_record"] if "_corrupt_record" in stream.columns else []
    return stream.select("ts", F.col("ts_ps").alias("seq"), F.col("sensor_id").alias("entity"), "x", "y", *more)


def both_runs(spark, tmp_path, start):
    """Over the files, then over the end marker: a restart in between."""
    start().awaitTermination()
    finish_positions(spark, str(tmp_path / "in"))
    start().awaitTermination()


def batch_positions(spark, tmp_path, entities):
    return motion.only_entities(as_motion(read_positions(spark, str(tmp_path / "in"))), entities)


@pytest.mark.parametrize("scope", ["interleaved", "per_entity"])
@pytest.mark.parametrize("rollup", [None, "10 hours"])
def test_zone_exits_equal_batch(spark, tmp_path, rows, scope, rollup):
    more = [(4, 36_000_000 + 500 * n, 20000 * (n % 2), 20000) for n in range(9)] + [(47, 36_100_000, 0, 0)]
    write_files(tmp_path / "in", ZONE_EVENTS[:4], ZONE_EVENTS[4:], more[:3], more[3:])
    out = str(tmp_path / "out")
    batch = motion.zone_exits(batch_positions(spark, tmp_path, BALL_SENSORS), PENALTY_AREAS, scope=scope)
    expected = rows(motion.rollup_exits(batch, rollup) if rollup else batch)
    options = {"rollup": rollup, "scope": scope, "entities": BALL_SENSORS, "checkpoint": str(tmp_path / "progress")}
    both_runs(spark, tmp_path, lambda: closed_zone_exits(source(spark, tmp_path), PENALTY_AREAS, out, **options))
    assert rows(results(spark, out, "exits", EXITS)) == expected
    assert not [f for f in (tmp_path / "out" / "rows" / "kind=kept").glob("slice=*") if int(f.name[6:]) < 36_000_000_000]  # closed slices go


@pytest.mark.parametrize("files", [1, 3])
def test_mean_steps_equal_batch(spark, tmp_path, files):
    others = [(4, 10_000, 9, 9), (4, 100_000, 0, 9)]
    events = sorted(STEP_EVENTS + others, key=lambda e: e[1])
    write_files(tmp_path / "in", *([events] if files == 1 else [events[:1], events[1:4], events[4:]]))
    batch = motion.avg_step(batch_positions(spark, tmp_path, [PLAYER_SENSOR]))
    expected = {r.window_start: r.avg_step for r in batch.collect()}
    out, options = str(tmp_path / "out"), {"entities": [PLAYER_SENSOR], "checkpoint": str(tmp_path / "progress")}
    both_runs(spark, tmp_path, lambda: closed_avg_step(source(spark, tmp_path), out, **options))
    found = results(spark, out, "steps", STEPS).collect()
    assert {r.window_start: r.avg_step for r in found} == pytest.approx(expected) and len(found) == len(expected)


def test_mean_steps_by_key_and_over_gaps(spark, tmp_path):
    events = [(s, 20_000 * n + s, n * s, n % 3) for n in range(30) for s in (4, 8)] + [(8, 3_600_000 + 1000 * n, n, 0) for n in range(5)]
    write_files(tmp_path / "in", events[:7], events[7:30], events[30:])
    batch = motion.avg_step(batch_positions(spark, tmp_path, [4, 8]), keys=["entity"])
    expected = {(r.entity, r.window_start): r.avg_step for r in batch.collect()}
    out = str(tmp_path / "out")
    both_runs(spark, tmp_path, lambda: closed_avg_step(source(spark, tmp_path), out, keys=["entity"], checkpoint=str(tmp_path / "progress")))
    found = results(spark, out, "steps", f"entity LONG, {STEPS}").where("entity is not null").collect()
    assert {(r.entity, r.window_start): r.avg_step for r in found} == pytest.approx(expected) and len(found) == len(expected)


def best_events():
    return [(47, 15_000 * n, (n * n) % 17 * (n % 9), (n * 5) % 11) for n in range(120)]


def run_bests(spark, tmp_path, since=None):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    emit_from = F.timestamp_millis(F.lit(since)) if since is not None else None
    return lambda: live_running_best(source(spark, tmp_path), out, emit_from=emit_from, block="10 minutes", checkpoint=progress)


@pytest.mark.parametrize("since", [None, 900_000])
def test_running_best_equals_batch(spark, tmp_path, rows, since):
    events = best_events()
    write_files(tmp_path / "in", events[:10], events[10:50], events[50:51], events[51:])
    emit_from = F.timestamp_millis(F.lit(since)) if since is not None else None
    expected = rows(motion.running_best(motion.avg_step(batch_positions(spark, tmp_path, [47])), emit_from, "10 minutes"))
    both_runs(spark, tmp_path, run_bests(spark, tmp_path, since))
    found = rows(results(spark, str(tmp_path / "out"), "bests", BESTS))
    assert [r[:4] for r in found] == [r[:4] for r in expected] and [r[4] for r in found] == pytest.approx([r[4] for r in expected])
    assert len({r[2] for r in found}) > 1 or since


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path, rows):
    """The last micro-batch's commit is taken back, so that it runs again over its own tables."""
    events = best_events()
    write_files(tmp_path / "in", events[:10], events[10:50], events[50:])
    start, out = run_bests(spark, tmp_path), str(tmp_path / "out")
    start().awaitTermination()
    tables = lambda: (rows(results(spark, out, "bests", BESTS)), rows(results(spark, out, "steps", STEPS)), rows(account(spark, out)))
    once = tables()
    for _ in range(2):
        last = max((tmp_path / "progress" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
        last.unlink()
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
        start().awaitTermination()
        assert tables() == once
    finish_positions(spark, str(tmp_path / "in"))
    start().awaitTermination()
    expected = rows(motion.running_best(motion.avg_step(batch_positions(spark, tmp_path, [47])), None, "10 minutes"))
    assert [r[:4] for r in tables()[0]] == [r[:4] for r in expected]


def test_late_rows_are_kept_apart_and_counted(spark, tmp_path, rows):
    late = [(4, 500, 1, 1), (4, 2500, 20000, 20000)]
    write_files(tmp_path / "in", ZONE_EVENTS[:4], [(4, 200_000, 0, 0)], [*late, (4, 200_100, 0, 0)], [(8, 61_000, 5, 5), (8, 180_000, 7, 7)])
    out = str(tmp_path / "out")
    options = {"rollup": None, "scope": "interleaved", "checkpoint": str(tmp_path / "progress")}
    both_runs(spark, tmp_path, lambda: closed_zone_exits(source(spark, tmp_path), PENALTY_AREAS, out, **options))
    by_batch = {r.batch: r[1:] for r in account(spark, out).collect()}
    assert [by_batch[n] for n in range(5)] == [(4, 4, 0, 0), (1, 1, 0, 0), (3, 1, 2, 0), (2, 1, 1, 0), (1, 1, 0, 0)]
    assert all(given == kept + dropped + bad for given, kept, dropped, bad in by_batch.values())
    dropped = set_aside(spark, out, source(spark, tmp_path).schema, "late").select("batch", "entity", F.unix_millis("ts").alias("ms")).collect()
    assert sorted(map(tuple, dropped)) == [(2, 4, 500), (2, 4, 2500), (3, 8, 61_000)]
    survivors = motion.only_entities(as_motion(read_positions(spark, str(tmp_path / "in"))), [4, 8, 10, 12])
    survivors = survivors.where(~((F.col("entity") == 4) & F.unix_millis("ts").isin(500, 2500)) & ~((F.col("entity") == 8) & (F.unix_millis("ts") == 61_000)))
    assert rows(results(spark, out, "exits", EXITS)) == rows(motion.zone_exits(survivors, PENALTY_AREAS, scope="interleaved"))


def test_a_longer_delay_keeps_late_rows(spark, tmp_path, rows):
    write_files(tmp_path / "in", ZONE_EVENTS, [(4, 200_000, 0, 0)], [(4, 2500, 20000, 20000)])
    out = str(tmp_path / "out")
    options = {"rollup": None, "scope": "interleaved", "delay": "10 minutes", "checkpoint": str(tmp_path / "progress")}
    batch = motion.zone_exits(batch_positions(spark, tmp_path, BALL_SENSORS), PENALTY_AREAS, scope="interleaved")
    both_runs(spark, tmp_path, lambda: closed_zone_exits(source(spark, tmp_path), PENALTY_AREAS, out, **options))
    assert rows(results(spark, out, "exits", EXITS)) == rows(batch)
    assert account(spark, out).agg(F.sum("late")).first()[0] == 0


def test_unreadable_lines_go_to_their_own_table_once(spark, tmp_path, rows):
    """Over three micro-batches with a restart after them; the text of each bad line is kept."""
    bad = {0: ["BAD LINE"], 1: ["4,notatime,1,2,3,4,5,6,7,8,9,10,11", "1,2,3", "47,x,1,2,3,4,5,6,7,8,9,10,11"], 2: [position_line((4, 62_000, 1, 1)) + ",1"]}
    write_files(tmp_path / "in", ZONE_EVENTS[:3], ZONE_EVENTS[3:6], ZONE_EVENTS[6:])
    for n, lines in bad.items():
        with (tmp_path / "in" / f"{n:03}.csv").open("a") as out:
            out.writelines(f"{line}\n" for line in lines)
    in_name_order(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream = lambda: source(spark, tmp_path, mode="PERMISSIVE")
    options = {"rollup": None, "scope": "interleaved", "entities": BALL_SENSORS, "checkpoint": str(tmp_path / "progress")}
    both_runs(spark, tmp_path, lambda: closed_zone_exits(stream(), PENALTY_AREAS, out, **options))
    found = set_aside(spark, out, stream().schema, "bad").select("batch", "_corrupt_record").collect()
    assert sorted(map(tuple, found)) == sorted((n, line) for n, lines in bad.items() for line in lines)
    assert [tuple(r)[1:] for r in account(spark, out).orderBy("batch").collect()] == [(4, 3, 0, 1), (6, 3, 0, 3), (4, 3, 0, 1), (1, 1, 0, 0)]
    good = [e for e in ZONE_EVENTS if e[0] in BALL_SENSORS]
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "all.csv").write_text("\n".join(map(position_line, good)) + "\n")
    batch = motion.zone_exits(as_motion(read_positions(spark, str(tmp_path / "good"))), PENALTY_AREAS, scope="interleaved")
    assert rows(results(spark, out, "exits", EXITS)) == rows(batch)


def test_a_million_rows_in_one_slice_of_one_entity(spark, tmp_path):
    n = 1_000_000
    at = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") % 50_000)  # 50 ms, twenty rows an instant
    x, y = F.when(F.col("id") / 50_000 % 2 < 1, 0.0).otherwise(3.0), F.lit(0.0)
    rows = spark.range(n).select(at.alias("ts"), (F.col("id") % 50_000 * 20 + F.floor(F.col("id") / 50_000)).alias("seq"), F.lit(1).alias("entity"), x.alias("x"), y.alias("y"))
    rows.write.parquet(str(tmp_path / "in"))
    end = spark.range(1).select(F.lit("9999-01-01").cast("timestamp").alias("ts"), F.lit(0).cast("long").alias("seq"), F.lit(None).cast("int").alias("entity"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    start = lambda: closed_avg_step(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), out, "1 second", "1 second", entities=[1], checkpoint=progress)
    start().awaitTermination()
    assert results(spark, out, "steps", STEPS).isEmpty()  # the slice is still open
    end.write.mode("append").parquet(str(tmp_path / "in"))
    start().awaitTermination()
    found = results(spark, out, "steps", STEPS).collect()
    assert len(found) == 1 and found[0].avg_step == pytest.approx(3.0 * (n - 1) / n)  # each row stands three away from the one before it


def test_nothing_arrives(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = str(tmp_path / "out")
    both_runs(spark, tmp_path, lambda: closed_zone_exits(source(spark, tmp_path), PENALTY_AREAS, out, checkpoint=str(tmp_path / "progress")))
    assert results(spark, out, "exits", EXITS).isEmpty()
    assert Tail(spark, str(tmp_path / "none"), source(spark, tmp_path).schema).before(5)["batch"] == -1


def test_bytes_bound_a_micro_batch(spark, tmp_path):
    write_files(tmp_path / "in", *[[(4, 1000 * n + k, n, k) for k in range(20)] for n in range(6)])
    size = (tmp_path / "in" / "000.csv").stat().st_size
    out = str(tmp_path / "out")
    stream = source(spark, tmp_path, max_files_per_trigger=None, max_bytes_per_trigger=int(2.5 * size))
    closed_zone_exits(stream, PENALTY_AREAS, out, checkpoint=str(tmp_path / "progress")).awaitTermination()
    assert [r.given for r in account(spark, out).orderBy("batch").collect()] == [40, 40, 40]
    with pytest.raises(ValueError, match="not by both"):
        stream_positions(spark, str(tmp_path / "in"), 1, max_bytes_per_trigger=1)


TABLES = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the given tables")
def test_position_files_follow_the_rows(spark, monkeypatch):
    """More rows make more files, each a range of time, in the order of time; a file of delayed rows stays within one slot of arrival."""
    plans = importlib.import_module("fieldtally.plans.queries")
    time = F.col("_c1").cast("decimal(38,0)")
    numbers = []
    for rows in (5000, 1000):
        monkeypatch.setattr(plans, "FILE_ROWS", rows)
        read = spark.read.csv(plans.position_files(spark, TABLES))
        spans = read.groupBy(F.input_file_name().alias("file")).agg(F.min(time).alias("a"), F.max(time).alias("b")).orderBy("file").collect()
        assert all(x.b < y.a for x, y in zip(spans, spans[1:]))
        numbers.append(len(spans))
    assert numbers[0] == 2 and numbers[1] == 10
    path = plans.delayed_files(spark, TABLES)
    folders = spark.read.option("recursiveFileLookup", "true").text(path).select(F.input_file_name().alias("file")).groupBy("file").count().collect()
    assert sum(r["count"] for r in folders) == 10_000 and all(r.file.rsplit("/", 2)[1].startswith("slot=") for r in folders)
