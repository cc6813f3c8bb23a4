"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles; two documents are linked when the Jaccard
similarity of their sets reaches the threshold. Candidates come from a forest of chosen-path
trees: in a node of a tree, one or two coordinates of the documents' minhash signatures are
drawn (``1 / threshold`` on average, the same draw for all documents of the node), and every
document moves to the child nodes named by its values there. Small nodes are compared exhaustively on
signatures, large ones are branched again, but only to ``EXACT_DEPTH`` (``MAX_DEPTH`` for nodes of more than
``LARGE_NODE``, which then draw two coordinates each): what is large there is compared on its full sets. So
the depth is bounded, and the number of trees is the least one that misses a pair at the threshold with at most
``MISS``, all its nodes being as deep as nodes can be.

What keeps the work in proportion to the input:

* Texts with equal word sequences are one class; only the class's first row joins.
* Only components are asked for. In each node all documents are first compared with its smallest
  one, true links are merged, and a node whose documents lie in one component is finished, so a
  group of thousands of copies costs one comparison per copy and never its square. Documents
  of different components go on branching until they part, meet in a small node or are compared on full sets.
* Signatures (256 bytes) decide which pairs of small nodes are compared at all; texts move only for those.
* Large nodes, and small ones in which signatures leave too many pairs, are cut into blocks. A task has two blocks of
  shingle sets, counts what each pair shares by matrix products, and emits a spanning forest of the links between
  components, so pairs just below the threshold are counted and never become rows.
* Every link is confirmed on the full sets.

Everything between two rounds is a table below ``spark.checkpoint.dir``; hot nodes are joined,
never collected, so adaptive execution can split them.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.components import components
from fieldtally.llm.membership import SUSPECT, marked, without
from fieldtally.llm.scratch import Scratch, as_structs
from fieldtally.llm.words import SPACED, grams, grams_inside, mixed, runs

SHINGLE = 5
THRESHOLD = 85  #: percent
MISS = 1e-4  #: a pair at the threshold is missed at most with this probability
COORDINATES = 64
SMALL_NODE = 250
EXACT_DEPTH = 3  #: nodes this deep are compared on full sets if they have at most ``LARGE_NODE`` members
LARGE_NODE = 8192
MAX_DEPTH = 6  #: nodes this deep are compared on full sets whatever their size
DENSE = 8  #: a small node with more candidates than this a member is compared on full sets too
BLOCK = 512  #: documents
BLOCK_SHINGLES = 1 << 18
WIDTH = 4096  #: shingles of a matrix product

_SEEDS = np.random.Generator(np.random.PCG64(77)).integers(0, 1 << 32, (2, COORDINATES), dtype=np.uint32)
_ODD = _SEEDS[1] | np.uint32(1)

SKETCH = "rid long, h1 long, h2 long, n_shingles long, signature binary"


def _binomial(threshold: int) -> list[float]:
    """Probability of each number of equal coordinates of a pair at ``threshold``."""
    t = threshold / 100
    return [math.comb(COORDINATES, k) * t**k * (1 - t) ** (COORDINATES - k) for k in range(COORDINATES + 1)]


def least_equal(threshold: int) -> int:
    """A pair at the threshold has fewer equal coordinates with a probability under 1e-6."""
    below = itertools.accumulate(_binomial(threshold))
    return sum(1 for x in below if x < 1e-6)


def second_child(threshold: int) -> float:
    """Share of the nodes that draw two coordinates, so that nodes draw ``1 / threshold`` on average."""
    return min(1.0, 100 / threshold - 1)


def missed(threshold: int, trees: int) -> float:
    """Probability that a pair at ``threshold`` is separated in all trees, if every node is branched to ``MAX_DEPTH``. All
    trees draw from the same coordinates, so it is the mean over how many of them are equal."""
    shares = [second_child(threshold)] * (EXACT_DEPTH - 1) + [1.0] * (MAX_DEPTH - EXACT_DEPTH)
    total = 0.0
    for k, weight in enumerate(_binomial(threshold)):
        apart = 0.0
        for second in reversed(shares):
            parted_child = 1 - k / COORDINATES * (1 - apart)
            apart = (1 - second) * parted_child + second * parted_child**2
        parted = 1 - k / COORDINATES * (1 - apart)
        total += weight * parted**trees
    return total


def trees_for(threshold: int, miss: float = MISS) -> int:
    """The least number of trees, one root coordinate each, that misses with at most ``miss``."""
    return next((n for n in range(1, COORDINATES) if missed(threshold, n) <= miss), COORDINATES)


def shingle_sets(column: pa.Array) -> Iterator[tuple]:
    """For runs of texts: (run, word hashes, shingle hashes, first shingle of each text and its number).

    A text of fewer words than a shingle has one shingle, the whole sequence."""
    for run in runs(column, SPACED):
        words = run.hashes()
        counts = run.counts()
        first, number = grams_inside(run.words, SHINGLE)
        shingles = grams(words, SHINGLE)
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        if len(short):
            whole = np.zeros(len(short), dtype=np.uint64)
            for k, i in enumerate(short):
                own = words[run.words[i] : run.words[i + 1]]
                whole[k] = grams(own, len(own))[0] ^ np.uint64(len(own))
            first, number = first.copy(), number.copy()
            first[short] = len(shingles) + np.arange(len(short))
            number[short] = 1
            shingles = np.concatenate((shingles, whole))
        yield run, words, shingles, first, number


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rid = batch.column("rid").to_numpy()
        n = len(rid)
        h1, h2, sizes = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.int64)
        signatures = np.zeros((n, COORDINATES), np.uint32)
        for run, words, shingles, first, number in shingle_sets(batch.column("text")):
            some = np.flatnonzero(number)
            if not len(some):
                continue
            at = run.first + some
            # texts with shingles, each followed by the borders of its own windows
            edges = np.empty(2 * len(some), dtype=np.int64)
            edges[0::2], edges[1::2] = first[some], first[some] + number[some]
            low = np.append(shingles >> np.uint64(32), np.uint64(0)).astype(np.uint32)  # an edge may be the end
            for c in range(COORDINATES):
                values = (low ^ _SEEDS[0, c]) * _ODD[c]
                signatures[at, c] = np.minimum.reduceat(values, edges)[0::2]
            place = words * (np.arange(len(words), dtype=np.uint64) - np.repeat(run.words[:-1], run.counts()).astype(np.uint64) + np.uint64(1))
            starts = run.words[:-1][some]
            h1[at] = mixed(np.add.reduceat(mixed(place), starts) + run.counts()[some].astype(np.uint64))
            h2[at] = mixed(np.add.reduceat(mixed(place ^ np.uint64(0x5851F42D4C957F2D)), starts))
            for i in some:
                sizes[run.first + i] = len(np.unique(shingles[first[i] : first[i] + number[i]]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("rid"), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(sizes),
                pa.array([x.tobytes() for x in signatures], pa.binary()),
            ],
            ["rid", "h1", "h2", "n_shingles", "signature"],
        )


def _equal_coordinates(threshold: int) -> Callable:
    """Of rows (a, b, n_a, n_b, sig_a, sig_b) the pairs (a, b) that may be links."""
    least = least_equal(threshold)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            one = np.frombuffer(b"".join(batch.column("sig_a").to_pylist()), np.uint32).reshape(n, COORDINATES)
            two = np.frombuffer(b"".join(batch.column("sig_b").to_pylist()), np.uint32).reshape(n, COORDINATES)
            keep = pa.array((one == two).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return run_batches


def _inside_nodes(threshold: int) -> Callable:
    """Exhaustive comparison on signatures in nodes of at most ``SMALL_NODE`` documents: rows (NULL, a, b), or
    (node, NULL, NULL) of a node with more than ``DENSE`` pairs a member."""
    least = least_equal(threshold)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, dense = [], [], []
            for node, members in zip(batch.column("node").to_pylist(), batch.column("members").to_pylist(), strict=True):
                rid = np.array([m["rid"] for m in members])
                order = np.argsort(rid)
                rid = rid[order]
                comp = np.array([m["comp"] for m in members])[order]
                size = np.array([m["n"] for m in members])[order]
                sig = np.frombuffer(b"".join(members[i]["sig"] for i in order), np.uint32).reshape(len(rid), COORDINATES)
                own_a, own_b = [], []
                for i in range(1, len(rid)):  # documents with the smallest one are compared already in every node
                    equal = (sig[:i] == sig[i]).sum(axis=1)
                    fit = (equal >= least) & (comp[:i] != comp[i])
                    fit &= 100 * np.minimum(size[:i], size[i]) >= threshold * np.maximum(size[:i], size[i])
                    found = np.flatnonzero(fit)
                    own_a.extend([rid[i]] * len(found))
                    own_b.extend(rid[found])
                if len(own_a) > DENSE * len(rid):
                    dense.append(node)
                else:
                    a += own_a
                    b += own_b
            none = [None] * len(dense)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None] * len(a) + dense, pa.int64()), pa.array(a + none, pa.int64()), pa.array(b + none, pa.int64())], ["node", "a", "b"]
            )

    return run_batches


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (rid, text) the sorted shingle hashes."""
    for batch in batches:
        sets = []
        for _run, _words, shingles, first, number in shingle_sets(batch.column("text")):
            sets.extend(np.unique(shingles[f : f + m]).tobytes() for f, m in zip(first, number, strict=True))
        yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(sets, pa.binary())], ["rid", "shingles"])


def in_common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``one`` shares with each of ``two``."""
    sides = []
    for sets in (one, two):
        values = np.concatenate(sets)
        sides.append((values, np.repeat(np.arange(len(sets)), [len(x) for x in sets])))
    both = np.intersect1d(sides[0][0], sides[1][0])
    common = np.zeros((len(one), len(two)), np.float32)
    if not len(both):
        return common
    placed = []
    for values, row in sides:
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        known = both[at] == values
        at, row = at[known], row[known]
        order = np.argsort(at, kind="stable")
        placed.append((at[order], row[order]))
    for low in range(0, len(both), WIDTH):
        parts = []
        for (at, row), sets in zip(placed, (one, two), strict=True):
            here = slice(*np.searchsorted(at, (low, low + WIDTH)))
            part = np.zeros((len(sets), min(WIDTH, len(both) - low)), np.float32)
            part[row[here], at[here] - low] = 1
            parts.append(part)
        common += parts[0] @ parts[1].T
    return common


def spanning(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning forest of a graph given by its symmetric matrix."""
    todo = np.ones(len(linked), dtype=bool)
    for start in range(len(linked)):
        stack = [start] if todo[start] else []
        todo[start] = False
        while stack:
            v = stack.pop()
            new = np.flatnonzero(linked[v] & todo)
            todo[new] = False
            yield from ((v, w) for w in new)
            stack.extend(new)


def _inside_blocks(threshold: int) -> Callable:
    """Of two blocks of a node (or one with itself) links (a, b) on full sets that join the components they join."""

    def run_group(table: pa.Table) -> pa.Table:
        table = table.sort_by("rid")
        block = table.column("block").to_numpy()
        one = np.flatnonzero(block == table.column("i")[0].as_py())
        two = np.flatnonzero(block == table.column("j")[0].as_py())
        rid, comp = table.column("rid").to_numpy(), table.column("comp").to_numpy()
        a, b = [], []
        if len(one) and len(two) and len(np.unique(comp)) > 1:
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            sizes = np.array([len(x) for x in sets], dtype=np.int64)
            common = in_common([sets[x] for x in one], [sets[x] for x in two]).astype(np.int64)
            fit = 100 * common >= threshold * (sizes[one][:, None] + sizes[two][None, :] - common)
            fit &= (common > 0) & (comp[one][:, None] != comp[two][None, :])
            linked = np.zeros((len(rid), len(rid)), dtype=bool)
            linked[np.ix_(one, two)] = fit
            for v, w in spanning(linked | linked.T):
                a.append(rid[v])
                b.append(rid[w])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run_group


def _confirm(threshold: int) -> Callable:
    """Of rows (a, b, text_a, text_b) the pairs whose full sets reach the threshold."""

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("text_a", "text_b"):
                sets = []
                for _run, _words, shingles, first, number in shingle_sets(batch.column(name)):
                    sets.extend(np.unique(shingles[f : f + m]) for f, m in zip(first, number, strict=True))
                sides.append(sets)
            linked = []
            for x, y in zip(*sides, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(both > 0 and 100 * both >= threshold * (len(x) + len(y) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return run_batches


class Forest:
    """One run of the join over a written table (rid, text, n_shingles, signature) of classes."""

    def __init__(self, classes: DataFrame, texts: DataFrame, scratch: Scratch, seed: int, threshold: int = THRESHOLD):
        if not 0 < threshold <= 100:
            raise ValueError(f"threshold is a percentage above 0, not {threshold}")
        self.threshold = threshold
        self.sketches = classes.select("rid", "n_shingles", "signature")
        self.texts, self.scratch, self.seed = texts, scratch, seed
        self.comps: DataFrame | None = None
        self.links: DataFrame | None = None

    def coordinate(self, node: Column, child: int) -> Column:
        return F.pmod(F.xxhash64(node, F.lit(child), F.lit(self.seed)), F.lit(COORDINATES)).cast("int")

    @staticmethod
    def value(coordinate: Column) -> Column:
        return F.substring(F.col("signature"), coordinate * 4 + F.lit(1), F.lit(4))

    def roots(self) -> DataFrame:
        """(node, rid) of the first level; the trees draw different coordinates."""
        rng = random.Random(self.seed)
        drawn = iter(rng.sample(range(COORDINATES), COORDINATES))
        nodes = [F.xxhash64(F.lit(t), self.value(F.lit(next(drawn)))) for t in range(trees_for(self.threshold))]
        return self.sketches.select("rid", F.explode(F.array(*nodes)).alias("node"))

    def branched(self, members: DataFrame, levels: int, second: float) -> DataFrame:
        """(node, rid) some levels further down, where a share ``second`` of the nodes draws two coordinates."""
        members = members.join(self.sketches, "rid").select("node", "rid", "signature")
        for _ in range(levels):
            two = F.pmod(F.xxhash64("node", F.lit(-1), F.lit(self.seed)), F.lit(10000)) < round(10000 * second)
            child = [F.xxhash64("node", F.lit(c), self.value(self.coordinate(F.col("node"), c))) for c in (0, 1)]
            members = members.select(
                F.explode(F.when(two, F.array(*child)).otherwise(F.array(child[0]))).alias("node"), "rid", "signature"
            )
        return members.select("node", "rid")

    def with_comps(self, members: DataFrame) -> DataFrame:
        if self.comps is None:
            return members.withColumn("comp", F.col("rid"))
        known = self.comps.select(F.col("child").alias("rid"), "parent")
        return members.join(known, "rid", "left").select("node", "rid", F.coalesce("parent", "rid").alias("comp"))

    def open_members(self, members: DataFrame) -> DataFrame:
        """(node, rid, comp, size, pivot, pivot_comp) of nodes that hold more than one component."""
        members = self.with_comps(members)
        nodes = members.groupBy("node").agg(
            F.count(F.lit(1)).alias("size"), F.min(F.struct("rid", "comp")).alias("pivot"),
            F.min("comp").alias("low"), F.max("comp").alias("high"),
        ).where("low != high")
        return members.join(nodes, "node").select(
            "node", "rid", "comp", "size", F.col("pivot.rid").alias("pivot"), F.col("pivot.comp").alias("pivot_comp")
        )

    def alike(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sizes and signatures allow a link."""
        one = self.sketches.toDF("a", "n_a", "sig_a")
        two = self.sketches.toDF("b", "n_b", "sig_b")
        sized = pairs.join(one, "a").join(two, "b")
        sized = sized.where(f"100 * least(n_a, n_b) >= {self.threshold} * greatest(n_a, n_b)")
        return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(_equal_coordinates(self.threshold), "a long, b long")

    def star_pairs(self, opened: DataFrame) -> DataFrame:
        pairs = opened.where("rid != pivot and comp != pivot_comp").select(
            F.col("rid").alias("a"), F.col("pivot").alias("b")
        )
        return self.alike(pairs.distinct())

    def small_pairs(self, opened: DataFrame) -> DataFrame:
        """Written rows (NULL, a, b) and (node, NULL, NULL), as ``_inside_nodes`` gives them."""
        small = opened.where(f"size <= {SMALL_NODE} and size > 2").select("node", "rid", "comp")
        small = small.join(self.sketches, "rid")
        member = F.struct("rid", "comp", F.col("n_shingles").alias("n"), F.col("signature").alias("sig"))
        lists = small.groupBy("node").agg(F.collect_list(member).alias("members"))
        found = lists.mapInArrow(_inside_nodes(self.threshold), "node long, a long, b long").distinct()
        return self.scratch.written(found, "small")

    def block_links(self, members: DataFrame) -> DataFrame | None:
        """Links (a, b) inside nodes (node, rid, comp) by their full sets; none without members."""
        members = self.scratch.written(members.join(self.sketches.select("rid", "n_shingles"), "rid"), "blocks")
        if members.isEmpty():
            return None
        texts = marked(self.texts, members.select("rid"), "rid", F.col("rid"), self.scratch).where(SUSPECT)
        texts = texts.select("rid", "text").join(members.select("rid").distinct(), "rid", "left_semi")
        sets = self.scratch.written(texts.mapInArrow(_sets, "rid long, shingles binary"), "sets")
        cut = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks")
        cuts = members.groupBy("node").agg(cut)
        dealt = members.join(cuts, "node").withColumn("block", F.pmod(F.xxhash64("rid", "node"), F.col("blocks")))
        dealt = dealt.select("node", "rid", "comp", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        dealt = dealt.select("node", "rid", "comp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        pairs = dealt.join(sets, "rid").groupBy("node", "i", "j")
        return self.scratch.written(pairs.applyInArrow(_inside_blocks(self.threshold), "a long, b long"), "block-links")

    def merge(self, pairs: DataFrame, links: DataFrame | None = None) -> None:
        """Confirms ``pairs`` on full sets and merges what they and the confirmed ``links`` link."""
        pairs = self.scratch.written(pairs, "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("rid"))
        texts = marked(self.texts, ends, "rid", F.col("rid"), self.scratch).where(SUSPECT)
        one = texts.select(F.col("rid").alias("a"), F.col("text").alias("text_a"))
        two = texts.select(F.col("rid").alias("b"), F.col("text").alias("text_b"))
        full = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
        found = self.scratch.written(full.mapInArrow(_confirm(self.threshold), "a long, b long"), "links")
        found = found if links is None else found.union(links)
        if self.links is not None and found.isEmpty():
            return
        found = found.select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
        self.links = found if self.links is None else self.links.union(found)
        known = found if self.comps is None else self.comps.union(found)
        self.comps = components(known, self.scratch)

    def run(self) -> None:
        members = self.scratch.written(self.roots(), "level")
        self.merge(self.star_pairs(self.open_members(members)))
        depth, first = 1, True
        while True:
            opened = self.scratch.written(self.open_members(members), "open")
            large = opened.where(f"size > {SMALL_NODE}")
            if depth >= MAX_DEPTH:
                exact, large = large, large.limit(0)
            elif depth >= EXACT_DEPTH:
                exact, large = large.where(f"size <= {LARGE_NODE}"), large.where(f"size > {LARGE_NODE}")
            else:
                exact = large.limit(0)
            small = self.small_pairs(opened)
            dense = opened.join(small.where("node is not null").select("node"), "node", "left_semi")
            pairs = small.where("node is null").select("a", "b")
            if not first:
                pairs = pairs.union(self.star_pairs(opened))
            links = self.block_links(exact.union(dense).select("node", "rid", "comp"))
            self.merge(pairs.distinct(), links)
            if large.isEmpty():
                return
            further, second = (EXACT_DEPTH, second_child(self.threshold)) if depth < EXACT_DEPTH else (MAX_DEPTH, 1.0)
            members = self.scratch.written(self.branched(large.select("node", "rid"), further - depth, second), "level")
            depth, first = further, False


def labelled(docs: DataFrame, text: str, doc_id: str, seed: int, threshold: int) -> tuple[DataFrame, DataFrame, Scratch]:
    """The rows of ``docs`` as written, (rid, doc), and what is found of each, (rid, n_shingles, component_id, kept, keeper, n_links)."""
    scratch = Scratch(docs.sparkSession, "neardup")
    rows = as_structs(docs).withColumn("rid", F.monotonically_increasing_id())
    rows = scratch.written(rows, "rows")
    texts = rows.select("rid", F.col(f"doc.`{text}`").cast("string").alias("text"))
    sketches = scratch.written(texts.mapInArrow(_sketch, SKETCH), "sketches")
    some = sketches.where("n_shingles > 0")
    first = some.groupBy("h1", "h2").agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("copies"))
    first = scratch.written(first, "classes")
    copies = some.join(first.where("copies > 1"), ["h1", "h2"]).where("rid != first")
    copies = scratch.written(copies.select(F.col("rid").alias("child"), F.col("first").alias("parent")), "copies")
    forest = Forest(some.join(first.select(F.col("first").alias("rid")), "rid", "left_semi"), texts, scratch, seed, threshold)
    forest.sketches = scratch.written(forest.sketches, "class-sketches")
    forest.run()
    # rid -> first row of its class -> smallest row of its component
    roots = forest.comps.select(F.col("child").alias("parent"), F.col("parent").alias("root"))
    copies = copies.join(roots, "parent", "left").select(
        F.col("child").alias("rid"), F.coalesce("root", "parent").alias("root")
    )
    rooted = copies.union(forest.comps.select(F.col("child").alias("rid"), F.col("parent").alias("root")))
    both = forest.links.select("child", "parent").union(forest.links.select("parent", "child")).distinct()
    n_links = both.groupBy(F.col("child").alias("rid")).agg(F.count(F.lit(1)).alias("n_links"))
    own = (
        rows.select("rid", F.col(f"doc.`{doc_id}`").alias("id"))
        .join(rooted, "rid", "left")
        .select("rid", "id", F.coalesce("root", "rid").alias("root"))
    )
    own = scratch.written(own, "roots")
    best = own.groupBy("root").agg(
        F.min("id").alias("component_id"), F.count(F.lit(1)).alias("rows_in"),
        F.min_by("rid", F.struct(F.col("id").isNull(), "id", "rid")).alias("keeper_rid"),
    )
    labels = (
        own.join(best.where("rows_in > 1"), "root", "left")
        .join(sketches.select("rid", "n_shingles"), "rid")
        .join(n_links, "rid", "left")
    )
    component = F.when(F.col("rows_in").isNull(), F.col("id")).otherwise(F.col("component_id"))
    labels = labels.select(
        "rid", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"),
        (F.coalesce("keeper_rid", "rid") == F.col("rid")).alias("keeper"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    return rows, scratch.written(labels, "labels"), scratch


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 7, threshold: int = THRESHOLD) -> DataFrame:
    """Rows (doc: the input row, n_shingles, component_id, kept, keeper, n_links), one per input row.

    ``component_id`` is the smallest id reachable over links, ``kept`` says whether the row has
    that id, and ``keeper`` is true for exactly one row of each component. ``threshold`` is the percentage of common
    shingles that links two rows. ``n_links`` counts the row's class's links that were confirmed while its component was put together, not all
    that exist; equal texts add none. NULL, empty and blank texts have no
    shingles and stay alone. Rows with the same id are documents of their own; the smallest id ignores
    NULL ids. An empty table gives an empty one. Other columns pass through untouched.
    """
    rows, labels, _scratch = labelled(docs, text, doc_id, seed, threshold)
    return rows.join(labels, "rid").drop("rid")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 7, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, every row without words."""
    rows, labels, scratch = labelled(docs, text, doc_id, seed, threshold)
    return without(rows, labels.where("not keeper").select("rid"), F.col("rid"), scratch).select("doc.*")
