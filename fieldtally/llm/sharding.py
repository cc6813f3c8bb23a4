"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

A uniform permutation of N rows cut into shards sends a multivariate hypergeometric number of rows from
each block to each shard. Those counts are drawn first (one small matrix of blocks by shards; the only
thing the driver sees is one row count per block); then the rows of each block are permuted on
their own, its first rows go to shard 0, the next to shard 1 and so on as the matrix says; after the
exchange each shard is permuted again. The shards' sizes are those of the plan, at most one apart.

Blocks and the second permutation's buckets come from seeded hashes of the rows, so a task that runs
again deals its rows alike, and no window holds more than one block or one bucket of a shard.
Only DataFrame functions touch the rows. The text itself is not shuffled, only its size and checksum.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldtally.llm.scratch import Scratch

SHARDS = 8
BLOCKS = 1024  #: rows of the matrix
BUCKETS = 4096  #: parts of a shard that are permuted on their own
_NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` balls are good. Beyond numpy's limit of 1e9 balls by rejection from a
    wide table mountain hat over the density (ratio of uniforms)."""
    if good + bad < _NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, drawn))
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    mean = drawn * good / total
    spread = math.sqrt(max(mean * bad / total * (total - drawn) / (total - 1), 0.25))

    def log_density(k: int) -> float:
        return -sum(math.lgamma(x + 1) for x in (k, good - k, drawn - k, bad - drawn + k))

    top = log_density(min(high, max(low, int((drawn + 1) * (good + 1) / (total + 2)))))
    width = 1.7155277699214135 * (spread + 0.5) + 0.8989161620588988
    while True:
        u, v = rng.random(), rng.random()
        k = math.floor(mean + 0.5 + width * (v - 0.5) / max(u, 1e-300))
        if low <= k <= high and 2 * math.log(max(u, 1e-300)) <= log_density(k) - top:
            return k


def matrix(block_rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows from each block to each shard: row sums as given, column sums at most one apart."""
    rng = np.random.Generator(np.random.PCG64(seed))
    total = sum(block_rows)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    out = []
    for n in block_rows:
        row, left, others = [], n, sum(room)
        for s in range(shards):
            others -= room[s]
            row.append(hypergeometric(rng, room[s], others, left) if left else 0)
            left -= row[-1]
        room = [r - x for r, x in zip(room, row, strict=True)]
        out.append(row)
    return out


def shard_rows(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shards: int = SHARDS,
    blocks: int = BLOCKS, buckets: int = BUCKETS, seed: int = 6,
) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot), one per row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus 1, NULL counting as empty; ``slot`` runs from 0 without
    a gap in each shard. Rows that are alike in id, size and checksum may stand for each other. Rows with a NULL id
    are dealt like others. An empty table gives no rows; fewer rows than shards leave shards empty.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    key = ("doc_id", "size", "text_crc32")

    def drawn(step: int):
        return F.xxhash64(F.lit(seed), F.lit(step), *key)

    scratch = Scratch(docs.sparkSession, "sharding")
    rows = scratch.written(rows.withColumn("block", F.pmod(drawn(1), F.lit(blocks)).cast("int")), "rows")
    counts = {r["block"]: r["count"] for r in rows.groupBy("block").count().collect()}  # one row per block
    plan = matrix([counts.get(b, 0) for b in range(blocks)], shards, seed)
    ends = json.dumps([np.cumsum(row).tolist() for row in plan])
    ends = F.from_json(F.lit(ends), "array<array<bigint>>")
    rank = F.row_number().over(W.partitionBy("block").orderBy(drawn(2), *key))
    dealt = rows.withColumn("rank", rank).select(
        *key, F.size(F.filter(F.element_at(ends, F.col("block") + 1), lambda end: end < F.col("rank"))).alias("shard")
    )
    dealt = dealt.withColumn("bucket", F.pmod(F.shiftrightunsigned(drawn(3), 40), F.lit(buckets)).cast("int"))
    dealt = scratch.written(dealt, "dealt")
    sizes = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    place = F.row_number().over(W.partitionBy("shard", "bucket").orderBy(drawn(4), *key))
    placed = dealt.withColumn("place", place).join(offsets, ["shard", "bucket"])
    return placed.select(*key, "shard", (F.col("offset") + F.col("place") - 1).cast("long").alias("slot"))
