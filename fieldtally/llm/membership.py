"""A filter of fixed size for ids, used to keep large rows out of shuffles.

The ids are hashed into ``2 ** BITS`` bits by grouped aggregation, kept as at most 65,536 rows of 64 bits
whatever the number of ids, so they can be broadcast. Rows that fail are certainly not among the ids; a join
that follows removes the few that pass by chance. More ids fill the filter, which costs shuffled bytes and never a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.scratch import Scratch

BITS = 22
SUSPECT = "membership_suspect"


def _places(key: Column) -> list[Column]:
    return [F.shiftrightunsigned(F.xxhash64(key, F.lit(step)), 64 - BITS) for step in (1, 2)]


def marked(rows: DataFrame, ids: DataFrame, column: str, key: Column, scratch: Scratch) -> DataFrame:
    """``rows`` with a column ``SUSPECT``: whether ``key`` may be among ``ids[column]``."""
    bits = ids.select(F.explode(F.array(*_places(F.col(column)))).alias("p"))
    one = F.expr("shiftleft(1L, CAST(p & 63 AS INT))")
    words = scratch.written(bits.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("b")), "filter").coalesce(1)
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    out = rows.select(whole, F.array(*_places(key)).alias("membership_p"))
    for n in (0, 1):
        word = words.toDF(f"membership_w{n}", f"membership_b{n}")
        out = out.join(F.broadcast(word), F.shiftright(F.col("membership_p")[n], 6) == F.col(f"membership_w{n}"), "left")
    hit = [F.expr(f"coalesce(shiftright(membership_b{n}, CAST(membership_p[{n}] & 63 AS INT)) & 1L, 0L) = 1L") for n in (0, 1)]
    return out.select("row.*", (hit[0] & hit[1]).alias(SUSPECT))


def without(rows: DataFrame, bad: DataFrame, key: Column, scratch: Scratch) -> DataFrame:
    """The rows whose ``key`` is not in the only column of ``bad`` (NULL equals NULL). Only rows that the filter lets
    through meet the join; the others pass in place. ``bad`` should be a written table, because it is read twice."""
    name = "without_bad_key"
    bad = bad.toDF(name).distinct()
    rows = marked(rows, bad, name, key, scratch)
    clean = rows.where(~F.col(SUSPECT)).drop(SUSPECT)
    return clean.unionByName(rows.where(SUSPECT).drop(SUSPECT).join(bad, key.eqNullSafe(F.col(name)), "left_anti"))
