"""A training-data pipeline over ``documents``.

Each stage works on all that the one before it kept and returns the columns of ``documents``;
the last one returns where each row goes. Rows are told apart by id and text, and rows alike in both share
their fate, except among near duplicates, where exactly one row of a group stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.decontam import drop_contaminated
from fieldtally.llm.langid import keep_identified
from fieldtally.llm.mixing import Mixture
from fieldtally.llm.neardup import drop_near_duplicates
from fieldtally.llm.queries import WEIGHTS, levels
from fieldtally.llm.scratch import Scratch
from fieldtally.llm.sharding import shard_rows

NEAR = 80  #: percent of common shingles


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough certainty stay."""
    return keep_identified(docs, F.col("text"), F.col("doc_id"), declared=F.col("lang"), host=F.col("source"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays. op7's contract has 0.85; near copies to drop are linked from ``NEAR`` on."""
    return drop_near_duplicates(docs, threshold=NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word inside a passage of the benchmark go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, dealt by the target weights: a row stays once for each epoch that takes it."""
    return Mixture(docs, levels(), WEIGHTS).mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    return shard_rows(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: Language model and random shuffle have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
