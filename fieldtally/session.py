"""Session settings the library is tuned for. Any session works; this is a helper."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "fieldtally",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC timestamps.

    On a cluster leave ``master`` out and set ``shuffle_partitions`` so that one partition
    of the largest shuffle holds a few hundred MB; adaptive execution merges small ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
