import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fieldtally import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.log.level": "ERROR",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "checkpoints"),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples; timestamps as milliseconds."""

    def read(df, *columns):
        found = [tuple(_plain(v) for v in row) for row in df.select(*columns or df.columns).collect()]
        return sorted(found, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])

    return read


def _plain(value):
    if isinstance(value, datetime):
        return round((value - datetime(1970, 1, 1)) / timedelta(milliseconds=1))
    return value


@pytest.fixture
def positions(spark):
    """Positions from (entity, ms, x, y[, seq]) tuples."""
    from pyspark.sql import functions as F

    def build(values):
        data = [(v[0], v[1], float(v[2]), float(v[3]), v[4] if len(v) > 4 else n) for n, v in enumerate(values)]
        df = spark.createDataFrame(data, "entity LONG, ms LONG, x DOUBLE, y DOUBLE, seq LONG")
        return df.withColumn("ts", F.timestamp_millis("ms")).drop("ms")

    return build
