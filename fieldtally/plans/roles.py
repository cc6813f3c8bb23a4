"""The driver's tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.functions import Zone

SINCE = "1995-01-01"
MIN_BALANCE = 1000.0
CARRY = ("c_name", "c_mktsegment")
SOURCE_VERTEX = 0
BALLS = ("click", "purchase", "signup", "view")
PLAYER = "error"
ZONES = (Zone("A", 50, 250, 50, 95), Zone("B", 50, 250, 5, 45))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def price_cents() -> Column:
    """Prices as whole cents: integer sums do not depend on the order of addition."""
    return F.rint(F.col("o_totalprice") * 100).cast("long")


def goods_flow(lineitem: DataFrame) -> DataFrame:
    """A directed graph of all line items: goods go from a part to the order that ships them
    (return flag N) and from an order back to the part when returned. Parts have even ids,
    orders odd ones."""
    shipped = F.col("l_returnflag") == "N"
    part, order = 2 * F.col("l_partkey"), 2 * F.col("l_orderkey") + 1
    return lineitem.select(
        F.when(shipped, part).otherwise(order).alias("src"), F.when(shipped, order).otherwise(part).alias("dst")
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return goods_flow(table(spark, sf_dir, "lineitem"))


def as_positions(events: DataFrame) -> DataFrame:
    """Events as positions: the type is the moving object, ``value`` x and ``$.k`` y."""
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("entity"),
        F.col("value").alias("x"),
        F.get_json_object("props", "$.k").cast("double").alias("y"),
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_positions(table(spark, sf_dir, "events"))


def zone_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About a thousand zones: one for each occurring 10 by 5 square of (x, y), reaching a little over its neighbours."""
    squares = positions(spark, sf_dir).select(F.floor(F.col("x") / 10).alias("i"), F.floor(F.col("y") / 5).alias("j"))
    i, j = F.col("i"), F.col("j")
    return squares.where("i is not null and j is not null").distinct().select(
        F.concat_ws("/", i, j).alias("zone"), (i * 10 - 3).alias("x_low"), (i * 10 + 13).alias("x_high"),
        (j * 5 - 2).alias("y_low"), (j * 5 + 7).alias("y_high"),
    )
