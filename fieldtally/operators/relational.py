"""Questions over an entity table (customers) and a fact table (orders).

All of them reduce the facts to one row per key *before* any join: the partial aggregate
runs on the map side, so a key that holds a third of all facts arrives as one row per map
task, and the join that follows meets unique keys and reuses the aggregate's partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions import bounded_below


def filter_above(df: DataFrame, column: str, minimum: float, inclusive: bool = False) -> DataFrame:
    """Rows whose ``column`` exceeds ``minimum`` (or reaches it, with ``inclusive``)."""
    return df.where(bounded_below(F.col(column), F.lit(minimum), inclusive))


def filter_since(df: DataFrame, column: str, since: str, inclusive: bool = False) -> DataFrame:
    """Rows dated after ``since`` (on or after, with ``inclusive``).

    The bound is cast to the column's own type, so the comparison reaches the scan.
    """
    bound = F.lit(since).cast(df.schema[column].dataType)
    return df.where(bounded_below(F.col(column), bound, inclusive))


def one_row_per_key(entities: DataFrame, key: str, carry: Sequence[str]) -> DataFrame:
    """One row per key; of several rows of a key the greatest carried values win."""
    return (
        entities.groupBy(key)
        .agg(F.max(F.struct(*carry)).alias("_carried"))
        .select(key, *[F.col("_carried")[name].alias(name) for name in carry])
    )


def sum_and_count(facts: DataFrame, key: str, value: Column, sum_name: str = "total", count_name: str = "n") -> DataFrame:
    """Sum and count of ``value`` per key."""
    return facts.groupBy(key).agg(F.sum(value).alias(sum_name), F.count(value).alias(count_name))


def facts_with_entities(facts: DataFrame, entities: DataFrame, fact_key: str, entity_key: str) -> DataFrame:
    """Every fact next to its entity (inner join); Catalyst and AQE pick the strategy."""
    return facts.join(entities, facts[fact_key] == entities[entity_key], "inner").drop(facts[fact_key])


def avg_per_entity(
    entities: DataFrame,
    facts: DataFrame,
    entity_key: str,
    fact_key: str,
    value: Column,
    carry: Sequence[str],
    avg_name: str = "avg_value",
    unique_entities: bool = False,
) -> DataFrame:
    """Key, carried columns and the mean of ``value`` for entities that have facts.

    ``unique_entities`` states that ``entity_key`` is a primary key, which saves the
    de-duplication of the entity side.
    """
    totals = sum_and_count(facts.where(F.col(fact_key).isNotNull()), fact_key, value, "_total", "_n").where(F.col("_n") > 0)
    who = entities.select(entity_key, *carry)
    if not unique_entities:
        who = one_row_per_key(who, entity_key, carry)
    return totals.join(who, totals[fact_key] == who[entity_key], "inner").select(
        who[entity_key], *carry, (F.col("_total") / F.col("_n")).alias(avg_name)
    )


def tagged_avg(
    entities: DataFrame,
    facts: DataFrame,
    entity_key: str,
    fact_key: str,
    value: Column,
    carry: Sequence[str],
    avg_name: str = "avg_value",
) -> DataFrame:
    """The same mean by one tagged union instead of a join.

    Facts enter as per-key totals, entities with their carried columns, both partitioned by
    key; the union keeps that partitioning, so grouping it again moves no row. The totals
    carry an explicit tag column, so no text of an entity can be taken for a fact.
    """
    totals = sum_and_count(facts, fact_key, value, "_total", "_n").select(
        F.col(fact_key).alias(entity_key), F.lit("fact").alias("_tag"), "_total", "_n"
    )
    who = entities.select(entity_key, F.lit("entity").alias("_tag"), F.struct(*carry).alias("_who"))
    # without this the union would be shuffled as a whole, totals included
    who = who.repartition(entity_key)
    merged = (
        totals.unionByName(who, allowMissingColumns=True)
        .groupBy(entity_key)
        .agg(
            F.sum("_total").alias("_total"),
            F.sum("_n").alias("_n"),
            F.max("_who").alias("_who"),
            F.max(F.col("_tag") == "entity").alias("_known"),
        )
    )
    return merged.where((F.col("_n") > 0) & F.col("_known") & F.col(entity_key).isNotNull()).select(
        entity_key,
        *[F.col("_who")[name].alias(name) for name in carry],
        (F.col("_total") / F.col("_n")).alias(avg_name),
    )


def entities_without(
    entities: DataFrame,
    facts: DataFrame,
    entity_key: str,
    fact_key: str,
    carry: Sequence[str],
    unique_entities: bool = False,
) -> DataFrame:
    """Entities that have no fact (``NOT EXISTS``); facts without entity play no role."""
    seen = facts.select(F.col(fact_key).alias("_seen")).where(F.col("_seen").isNotNull()).distinct()
    who = entities.select(entity_key, *carry)
    if not unique_entities:
        who = one_row_per_key(who, entity_key, carry)
    return who.join(seen, who[entity_key] == seen["_seen"], "left_anti")


def existence_flags(
    entities: DataFrame, facts: DataFrame, entity_key: str, fact_key: str, flag_name: str = "has_fact"
) -> DataFrame:
    """For each entity key whether any fact has it: one hash aggregate, no join."""
    sides = entities.select(
        F.col(entity_key), F.lit(True).alias("_entity"), F.lit(False).alias("_fact")
    ).unionByName(facts.select(F.col(fact_key).alias(entity_key), F.lit(False).alias("_entity"), F.lit(True).alias("_fact")))
    return (
        sides.groupBy(entity_key)
        .agg(F.bool_or("_entity").alias("_entity"), F.bool_or("_fact").alias("_fact"))
        .where("_entity")
        .select(entity_key, (F.col("_fact") & F.col(entity_key).isNotNull()).alias(flag_name))
    )
