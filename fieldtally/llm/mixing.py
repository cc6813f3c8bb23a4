"""Mixing sources to target weights by hierarchical budgeting.

Leaves are the distinct values of the level columns (say domain, language, source). A budget
of tokens flows down the tree: each node's children share what it got in proportion to
their weights, and none gets more than its leaves hold in ``max_epochs`` epochs. What a child cannot take goes to its
siblings first, by their weights; only what a whole subtree cannot take is left to the siblings of its
ancestors. The shares are found in closed form with window functions over siblings (a child is
full when its capacity per weight lies under the common level), in whole tokens, rounded down.

A leaf then takes a prefix of its stream of seeded epochs: each epoch is the leaf's documents in the order
of a seeded hash. Whole epochs are a count; the last one is cut by summing tokens per hash prefix (at most
65,536 sums a leaf), and only the documents of the one prefix that holds the cut are sorted. Nothing
sorts a whole leaf, and the tables joined to the documents have a row per leaf, or a few per leaf.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldtally.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
PREFIX = 4  #: hex digits of the order hash that are summed before anything is sorted


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def order_hash(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")))


def _weights(names: Sequence[str], weights: Mapping[tuple, int]) -> Column:
    """Weight of a node, 1 where none is given."""
    out = F.lit(1)
    for path, weight in weights.items():
        if len(path) == len(names):
            out = F.when(reduce(and_, [F.col(n) == F.lit(v) for n, v in zip(names, path, strict=True)]), weight).otherwise(out)
    return out.cast("long")


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple, int], budget: Column, max_epochs: int
) -> DataFrame:
    """(levels, tokens) -> (levels, tokens, alloc). ``budget`` may use the leaves' total ``tokens``."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    parents = None
    for depth in range(1, len(levels) + 1):
        names, above = list(levels[:depth]), list(levels[: depth - 1])
        nodes = leaves.groupBy(*names).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        siblings = W.partitionBy(*above) if above else W.partitionBy(F.lit(1))
        if not above:  # ``budget`` is an expression over the tokens of the whole tree
            whole = nodes.select(*names, "cap", F.col("tokens").alias("own"), F.sum("tokens").over(siblings).alias("tokens"))
            nodes = whole.select(*names, "cap", F.col("own").alias("tokens"), budget.cast("long").alias("got"))
        nodes = nodes.withColumn("w", _weights(names, weights)).where("w > 0 and cap > 0")
        nodes = nodes.join(parents, above) if above else nodes
        ordered = siblings.orderBy(F.col("cap").cast("double") / F.col("w"), names[-1])
        whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        nodes = (
            nodes.withColumn("got", F.least("got", F.sum("cap").over(siblings)))
            .withColumn("left", F.col("got") - F.coalesce(F.sum("cap").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("rest", F.sum("w").over(ordered.rowsBetween(W.currentRow, W.unboundedFollowing)))
            .withColumn("open", F.expr("left * w <= cap * rest"))
            .withColumn("after_open", F.max(F.col("open").cast("int")).over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow)))
            .withColumn("level", F.first(F.expr("CASE WHEN open THEN left END"), ignorenulls=True).over(whole))
            .withColumn("per", F.first(F.expr("CASE WHEN open THEN rest END"), ignorenulls=True).over(whole))
        )
        got = F.expr("CASE WHEN after_open = 1 THEN least(cap, (w * level) div per) ELSE cap END")
        parents = nodes.select(*names, "tokens", got.alias("got"))
        parents = parents if depth == len(levels) else parents.drop("tokens")
    return parents.select(*levels, "tokens", F.col("got").alias("alloc"))


class Mixture:
    """The plan of one mixing: leaves with their budgets and cuts, ready to be joined to documents.

    NULL levels are empty strings, which are nodes like others; NULL, empty and blank texts hold no tokens, and are in whole epochs only. Rows with
    equal ids have equal places in an epoch, the shorter text first, and share what any of them gets; a repeated row is as often in a mixture as it
    occurs times its copies. NULL ids are one id. A leaf without tokens, or without weight, gets nothing. An empty table gives no leaves. Columns of the input keep
    their names, whatever they are.
    """

    def __init__(
        self, docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple, int], budget: Column | None = None,
        max_epochs: int = 2, seed: int = 1, text: str = "text", doc_id: str = "doc_id",
    ):
        self.levels = {n: F.coalesce(c.cast("string"), F.lit("")) for n, c in levels.items()}
        self.text, self.doc_id, self.seed = F.col(f"`{text}`"), F.col(f"`{doc_id}`"), seed
        names = list(levels)
        scratch = Scratch(docs.sparkSession, "mixing")
        rows = docs.select(self.doc_id.alias("id"), n_tokens(self.text).alias("n"), *[c.alias(k) for k, c in self.levels.items()])
        rows = scratch.written(rows, "tokens")
        leaves = rows.groupBy(*names).agg(F.sum("n").alias("tokens"))
        leaves = leaf_budgets(leaves, names, weights, F.col("tokens") if budget is None else budget, max_epochs)
        leaves = leaves.withColumn("epochs", F.expr("alloc div tokens")).withColumn("rem", F.expr("alloc % tokens"))
        leaves = scratch.written(leaves, "leaves")
        # the last epoch: sums by hash prefix, then the documents of the prefix that holds the cut
        hashed = rows.join(leaves.where("rem > 0"), names)
        hashed = hashed.withColumn("h", order_hash(seed, F.col("epochs") + 1, F.col("id"))).withColumn("p", F.substring("h", 1, PREFIX))
        sums = hashed.groupBy(*names, "rem", "p").agg(F.sum("n").alias("n"))
        before = F.coalesce(F.sum("n").over(W.partitionBy(*names).orderBy("p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        cuts = sums.withColumn("before", before).where("before < rem and before + n >= rem")
        self.leaves = leaves.join(cuts.select(*names, F.col("p").alias("cut"), "before"), names, "left")
        self.leaves = scratch.written(self.leaves, "cuts").withColumnsRenamed({n: f"mix_{n}" for n in names})
        edge = hashed.join(cuts.select(*names, "p", "before"), [*names, "p"])
        inside = W.partitionBy(*names, "p").orderBy("h", "n").rowsBetween(W.unboundedPreceding, -1)
        edge = edge.withColumn("start", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        edge = edge.withColumn("part", F.greatest(F.lit(0), F.least("n", F.col("rem") - F.col("start"))))
        edge = edge.groupBy(*names, "h").agg(F.max("part").alias("part"))  # repeated rows: what any of them gets
        self.edge = scratch.written(edge, "edge").toDF(*[f"mix_{n}" for n in names], "edge_h", "edge_part")

    def assign(self, docs: DataFrame) -> DataFrame:
        """``docs`` as struct ``doc`` with its leaf (``mix_`` columns), n_tokens, leaf_budget, copies and partial_tokens.

        ``copies`` counts the epochs that the row is in; ``partial_tokens`` is what the last one takes of it
        where it does not take all (0 else)."""
        rows = docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), self.doc_id.alias("mix_id"),
            n_tokens(self.text).alias("n_tokens"), *[c.alias(f"mix_{k}") for k, c in self.levels.items()],
        )
        names = [f"mix_{n}" for n in self.levels]
        rows = rows.join(self.leaves, names, "left")
        rows = rows.withColumn("mix_h", F.when(F.col("rem") > 0, order_hash(self.seed, F.col("epochs") + 1, F.col("mix_id"))))
        rows = rows.withColumn("mix_p", F.substring("mix_h", 1, PREFIX))
        same = [rows[n] == self.edge[n] for n in names] + [rows["mix_h"] == self.edge["edge_h"]]
        rows = rows.join(self.edge, reduce(and_, same), "left").drop(*[self.edge[n] for n in names])
        taken = F.expr("CASE WHEN rem > 0 AND mix_p < cut THEN n_tokens ELSE coalesce(edge_part, 0) END")
        return rows.withColumn("taken", taken).select(
            "doc", *names, "n_tokens", F.coalesce("alloc", F.lit(0)).alias("leaf_budget"),
            (F.coalesce("epochs", F.lit(0)) + F.expr("CASE WHEN taken > 0 THEN 1 ELSE 0 END")).cast("long").alias("copies"),
            F.expr("CASE WHEN taken < n_tokens THEN taken ELSE 0 END").cast("long").alias("partial_tokens"),
        )

    def mixed(self, docs: DataFrame) -> DataFrame:
        """``docs`` with each row once per epoch that takes it; the text of a cut row stays whole."""
        rows = self.assign(docs).where("copies > 0")
        return rows.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("doc.*")
