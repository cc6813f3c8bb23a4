"""Readers for the delimited inputs: pipe tables, edge lists and sensor positions.

Every reader takes an explicit schema (nothing is inferred, so nothing is read twice) and
fails on a malformed line by default; ``mode="PERMISSIVE"`` keeps such lines in
``_corrupt_record`` instead. Empty lines are skipped.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.functions import pico_to_timestamp

CORRUPT = "_corrupt_record"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_LONG, _INT, _DOUBLE, _TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

# Column names and their order in the files.
CUSTOMERS_SCHEMA = _struct(
    ("custkey", _LONG), ("name", _TEXT), ("address", _TEXT), ("nationkey", _INT),
    ("phone", _TEXT), ("acctbal", _DOUBLE), ("mktsegment", _TEXT), ("comment", _TEXT),
)
ORDERS_SCHEMA = _struct(
    ("orderkey", _LONG), ("custkey", _LONG), ("orderstatus", _TEXT), ("price", _DOUBLE), ("orderdate", T.DateType()),
    ("orderpriority", _TEXT), ("clerk", _TEXT), ("shippriority", _TEXT), ("comment", _TEXT),
)
EDGES_SCHEMA = _struct(("src", _LONG), ("dst", _LONG))
POSITIONS_SCHEMA = _struct(
    ("sensor_id", _LONG), ("ts_ps", T.DecimalType(38, 0)), ("x", _INT), ("y", _INT), ("z", _INT),
    ("velocity", _INT), ("acceleration", _INT),
    ("direction_x", _INT), ("direction_y", _INT), ("direction_z", _INT),
    ("acceleration_x", _INT), ("acceleration_y", _INT), ("acceleration_z", _INT),
)


def with_corrupt_column(schema: T.StructType, mode: str) -> T.StructType:
    if mode.upper() != "PERMISSIVE":
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def read_pipe_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    header: bool = False,
    mode: str = "FAILFAST",
    sep: str = "|",
) -> DataFrame:
    """A pipe-separated table from one or several paths, columns by position."""
    return spark.read.csv(
        paths if isinstance(paths, str) else list(paths),
        schema=with_corrupt_column(schema, mode),
        sep=sep,
        header=header,
        mode=mode,
        dateFormat="yyyy-MM-dd",
        columnNameOfCorruptRecord=CORRUPT,
        escape='"',
    )


def is_table_file(name: str) -> Column:
    """Whether a row was read from the file ``name``, or from a folder of that name.

    The comparison ignores case. It uses the scan's file metadata only, so files of other
    tables are skipped when the files are listed, not read and thrown away.
    """
    pattern = "(^|/)" + re.sub(r"([^A-Za-z0-9_])", r"[\1]", name.lower()).replace("[^]", "\\^").replace("[\\]", "\\\\") + "(/[^/]*)?$"
    return F.lower(F.col("_metadata.file_path")).rlike(pattern)


def read_tagged_tables(
    spark: SparkSession,
    paths: Sequence[str],
    tables: Mapping[str, T.StructType],
    default: str | None = None,
    mode: str = "FAILFAST",
) -> dict[str, DataFrame]:
    """Several tables from one list of inputs, told apart by file name.

    ``tables`` maps file names to schemas. Files that match no name belong to ``default``,
    where one is given.
    """
    matches = {name: is_table_file(name) for name in tables}
    if default is not None:
        others = [match for name, match in matches.items() if name != default]
        matches[default] = ~reduce(or_, others, F.lit(False))
    return {
        name: read_pipe_table(spark, paths, schema, mode=mode).where(matches[name]) for name, schema in tables.items()
    }


def read_edge_list(spark: SparkSession, paths: str | Sequence[str], header: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """Tab-separated ``src``/``dst`` pairs with one header line per file."""
    return read_pipe_table(spark, paths, EDGES_SCHEMA, header=header, mode=mode, sep="\t")


def with_event_time(positions: DataFrame) -> DataFrame:
    """Adds ``ts`` (whole milliseconds); ``ts_ps`` stays for ordering."""
    return positions.withColumn("ts", pico_to_timestamp(F.col("ts_ps")))


def read_positions(spark: SparkSession, paths: str | Sequence[str], mode: str = "FAILFAST") -> DataFrame:
    """Comma-separated sensor positions with event time."""
    return with_event_time(read_pipe_table(spark, paths, POSITIONS_SCHEMA, mode=mode, sep=","))
