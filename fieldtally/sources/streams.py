"""Position files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldtally.sources.delimited import CORRUPT, POSITIONS_SCHEMA, with_corrupt_column, with_event_time


def stream_positions(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, mode: str = "FAILFAST", max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Sensor positions below ``path``, in folders of any depth, as a stream with event time.

    Each call makes an independent source that starts from the first file, so two queries
    never share progress. ``max_files_per_trigger`` or ``max_bytes_per_trigger`` bounds a micro-batch (one file at
    least is taken); files are taken by modification time (``workspace.in_name_order`` sets it). With ``mode="PERMISSIVE"``
    a malformed line is kept whole in ``_corrupt_record``.
    """
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("a micro-batch is bounded by files or by bytes, not by both")
    reader = spark.readStream.schema(with_corrupt_column(POSITIONS_SCHEMA, mode)).option("sep", ",").option("mode", mode)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", "true")
    if mode.upper() == "PERMISSIVE":  # lines with too few or too many fields are only found in whole rows
        reader = reader.option("columnPruning", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return with_event_time(reader.csv(path))
