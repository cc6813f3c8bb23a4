"""Replays of larger tables: larger micro-batches and no more of them, with the same rows."""

import importlib

import pytest
from pyspark.sql import functions as F

plans = importlib.import_module("fieldtally.plans.queries")
TYPES = ("click", "purchase", "signup", "view", "error")


def events(spark, path, n):
    """``n`` events of 30 days, evenly, the last type as often as the others."""
    start, step = 1_704_067_200_000_000, 30 * 86_400_000_000 // n
    kind = F.array(*[F.lit(x) for x in TYPES])[(F.col("id") * 7 % 5).cast("int")]
    rows = spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_micros(F.lit(start) + F.col("id") * step + 11).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 9).alias("user_id"), kind.alias("event_type"), (F.pmod(F.xxhash64("id"), F.lit(30_000)) / 100).alias("value"),
        F.concat(F.lit('{"k": '), F.pmod(F.hash("id"), F.lit(100)), F.lit("}")).alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.fixture
def small_batches(monkeypatch):
    """Bounds as small as the tables here, and the streams that are started over position files."""
    for name, value in {"FILE_ROWS": 50, "FILES": 6, "TRIGGER_BYTES": 2_000, "TRIGGERS": 2}.items():
        monkeypatch.setattr(plans, name, value, raising=False)
    started, begin = [], plans.stream_positions

    def begun(spark, files, **options):
        size = spark.read.text(files, recursiveFileLookup=True).agg(F.sum(F.length("value") + 1)).first()[0]
        started.append((len(spark.read.text(files, recursiveFileLookup=True).inputFiles()), size, options))
        return begin(spark, files, **options)

    monkeypatch.setattr(plans, "stream_positions", begun)
    return started


def check_replay(spark, tmp_path, started, query, expected):
    sf = events(spark, tmp_path, 1_200)
    found = sorted(map(str, plans.queries()[query](spark, sf).collect()))
    assert found == sorted(map(str, plans.queries()[expected](spark, sf).collect())) and found
    files, size, options = started[0]
    assert files <= 6 and size <= 2 * options["max_bytes_per_trigger"]


def test_live_running_best(spark, tmp_path, small_batches):
    check_replay(spark, tmp_path, small_batches, "q39_live_running_best", "q28_best_since")


class Started(Exception):
    """Ends a query where its stream starts."""


def check_bound(spark, tmp_path, started, monkeypatch, query, most=6):
    """What bounds a query's micro-batches, without running them."""
    begin = plans.stream_positions

    def stopped(*args, **options):
        begin(*args, **options)
        raise Started

    monkeypatch.setattr(plans, "stream_positions", stopped)
    with pytest.raises(Started):
        plans.queries()[query](spark, events(spark, tmp_path, 1_200))
    files, size, options = started[0]
    assert files <= most
    assert options.get("max_files_per_trigger") == 1 or size <= 2 * options["max_bytes_per_trigger"]


@pytest.mark.parametrize("query", ["q37_file_stream_exits_csv", "q38_live_best_window", "q42_closed_zone_exits", "q43_closed_avg_step"])
def test_micro_batches_are_bounded(spark, tmp_path, small_batches, monkeypatch, query):
    check_bound(spark, tmp_path, small_batches, monkeypatch, query)


@pytest.mark.parametrize("query", ["q40_late_rows", "q41_stream_account"])
def test_delayed_files_are_bounded(spark, tmp_path, small_batches, monkeypatch, query):
    """A file is a micro-batch there, and none reaches over two slots of arrival: 45 days make at most nine borders more."""
    check_bound(spark, tmp_path, small_batches, monkeypatch, query, most=6 + 10)
