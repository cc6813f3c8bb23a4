"""Hard negatives by threshold joins over an inverted index of whole-number vectors.

For some rows (anchors) the best rows of the same label are its positives; for each positive, the best rows of other
labels whose score lies in a window below the positive's are its hard negatives. Both are threshold joins of the anchors, in
blocks of ``BLOCK``, with all rows:

* Dimensions are ordered by falling energy. A row is filed under a dimension only while the norm of its remaining
  coordinates can still reach some anchor's threshold; what the bound covers is left out of the index, and a row whose whole
  norm is covered is not filed at all.
* Partial scores are accumulated over the filed dimensions, ``STEP`` at a time. After each step a pair stays only if its partial score plus
  the product of both remaining norms reaches the anchor's threshold; pairs that are left are verified exactly.
* Thresholds start high and are lowered for the anchors whose windows are not full yet. A window that is full of
  scores above its threshold is final, since every row above the threshold has been seen.

Scores are exact integers (float64 products of integers below 2 ** 53). Anchors are written to the shared folder, a file a
block; tasks read block after block beside their rows, so neither side is ever broadcast or shuffled against the other. A task emits
at most a full window for each anchor, and Spark merges these by anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldtally.llm import shared_files
from fieldtally.llm.scratch import Scratch

BLOCK = 512  #: anchors of a block
ROWS = 1 << 16  #: rows that a task holds while it goes through the blocks
PART = 4096  #: rows that are multiplied with a block at once
STEP = 16  #: dimensions of a step
FEW = 0.05  #: share of pairs that is verified pair by pair instead of step by step
START = 1.25  #: first threshold for positives, in multiples of a bound that certainly fills the window
FIRST = 92  #: percent of a positive's score, the first threshold for its negatives
LARGEST = 1 << 53
SLACK = 1 + 1e-9  #: on norms, for the rounding of roots
NOTHING = -np.inf  #: the threshold that every score reaches


def whole_numbers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component; NULL for a vector that is NULL or has a NULL or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def dense(column: pa.Array, width: int) -> np.ndarray:
    """Lists as the rows of a matrix, zeros behind their ends."""
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values)[offsets[0] : offsets[-1]]
    sizes, out = np.diff(offsets), np.zeros((len(column), width))
    if len(values):
        row = np.repeat(np.arange(len(column)), sizes)
        out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


def remaining_norms(rows: np.ndarray, borders: list[int]) -> np.ndarray:
    """The norm of each row's dimensions from each border on."""
    squares = np.cumsum((rows * rows)[:, ::-1], axis=1)[:, ::-1]
    squares = np.concatenate((squares, np.zeros((len(rows), 1))), axis=1)
    return np.sqrt(squares[:, borders]) * SLACK


def matches(rows: np.ndarray, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, score) of all pairs whose score is at least the anchor's threshold ``least``."""
    width = rows.shape[1]
    borders = [*range(0, width, STEP), width]
    rest, rest_of = remaining_norms(rows, borders), remaining_norms(anchors, borders)
    with np.errstate(divide="ignore", invalid="ignore"):
        # the norm from which on a row is filed under the dimensions behind a border
        filed = np.where(rest_of > 0, least[:, None] / rest_of, np.inf)
        filed = np.where(least[:, None] <= 0, NOTHING, filed).min(axis=0)
    here, score = np.arange(len(rows)), np.zeros((len(rows), len(anchors)))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]

    def verify(some: np.ndarray, of: np.ndarray, partial: np.ndarray, border: int) -> None:
        for k in range(0, len(some), PART):
            i, a = some[k : k + PART], of[k : k + PART]
            exact = partial[k : k + PART] + np.einsum("ij,ij->i", rows[i, border:], anchors[a, border:])
            hit = exact >= least[a]
            found.append((i[hit], a[hit], exact[hit]))

    for step, border in enumerate(borders):
        if not len(here):
            break
        stays = rest[here, step] >= filed[step] if step < len(borders) - 1 else np.zeros(len(here), bool)
        if step == 0:
            here, score = here[stays], score[stays]
        else:
            alive = score + rest[here, step][:, None] * rest_of[:, step] >= least
            if alive.sum() < FEW * alive.size:
                stays[:] = False
            out = alive & ~stays[:, None]
            i, a = np.nonzero(out)
            verify(here[i], a, score[i, a], border)
            stays &= alive.any(axis=1)
            here, score = here[stays], score[stays]
        if step < len(borders) - 1:
            end = borders[step + 1]
            score = score + rows[here, border:end] @ anchors[:, border:end].T
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of each group, by falling score, then by id."""
    order = np.lexsort((ids, -score, group))
    sorted_group = group[order]
    first = np.flatnonzero(np.append(True, sorted_group[1:] != sorted_group[:-1])) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < n]


class Blocks:
    """The files of a folder of anchors, one block each; a few are kept."""

    KEPT = 8

    def __init__(self, folder: str, order: np.ndarray):
        self.order, self.kept = order, {}
        self.system, path = shared_files.resolve(folder)
        found = self.system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        self.paths = sorted(f.path for f in found if f.base_name.endswith(".parquet"))

    def __iter__(self) -> Iterator[dict]:
        for path in self.paths:
            block = self.kept.get(path)
            if block is None:
                with self.system.open_input_file(path) as source:
                    table = pq.ParquetFile(source).read().combine_chunks()
                block = {c: table.column(c).to_numpy() for c in table.column_names if c not in ("v", "windows")}
                block["v"] = dense(_one(table.column("v")), len(self.order))[:, self.order] if table.num_rows else None
                block["windows"] = table.column("windows").to_pylist() if "windows" in table.column_names else None
                if len(self.kept) < self.KEPT:
                    self.kept[path] = block
            if block["v"] is not None:
                yield block


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _search(folder: str, order: np.ndarray, pick: Callable) -> Callable:
    """Runs the join of each task's rows with all blocks; ``pick`` chooses what is emitted for one block and part of the rows."""

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, held, n = Blocks(folder, order), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
            rows = dense(_one(table.column("v")), len(order))[:, order]
            for block in blocks:
                for k in range(0, len(rows), PART):
                    yield from pick(block, ids[k : k + PART], labels[k : k + PART], rows[k : k + PART])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= ROWS:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    return run_batches


def _positives(wanted: int) -> Callable:
    """The best rows of each anchor's own label, itself included."""

    def pick(block: dict, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        for label in np.intersect1d(np.unique(block["label"]), labels):
            own, of = np.flatnonzero(labels == label), np.flatnonzero(block["label"] == label)
            i, a, score = matches(rows[own], block["v"][of], block["least"][of])
            i, a = own[i], of[a]
            top = best(a, score, ids[i], wanted + 1)
            i, a, score = i[top], a[top], score[top]
            itself = ids[i] == block["vec_id"][a]
            at = np.flatnonzero(itself)
            itself[at] = (rows[i[at]] == block["v"][a[at]]).all(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block["a"][a]), pa.array(ids[i]), pa.array(score.astype(np.int64)), pa.array(itself)], ["a", "other", "score", "itself"]
            )

    return pick


def _negatives(wanted: int) -> Callable:
    """The best rows of other labels in each of the anchors' windows, (top, least) pairs of scores."""

    def pick(block: dict, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        least = np.array([min(w["least"] for w in x) for x in block["windows"]], dtype=np.float64)
        i, a, score = matches(rows, block["v"], least)
        other = labels[i] != block["label"][a]
        i, a, score = i[other], a[other], score[other]
        for k in range(max(map(len, block["windows"]))):
            tops, leasts = (np.array([x[k][c] if k < len(x) else LARGEST for x in block["windows"]], dtype=np.float64) for c in ("top", "least"))
            some = np.flatnonzero((score <= tops[a]) & (score >= leasts[a]))
            some = some[best(a[some], score[some], ids[i[some]], wanted)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block["a"][a[some]]), pa.array(tops[a[some]].astype(np.int64)),
                    pa.array(ids[i[some]]), pa.array(score[some].astype(np.int64)),
                ],
                ["a", "top", "other", "score"],
            )

    return pick


def _energy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's sum of squares and largest magnitude in each dimension, and its largest squared norm."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = dense(batch.column("v"), int(np.diff(np.asarray(batch.column("v").offsets)).max()))
        square = rows * rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(rows.shape[1])), pa.array(square.sum(axis=0)), pa.array(np.full(rows.shape[1], square.sum(axis=1).max()))],
            ["dimension", "energy", "norm"],
        )


def _lower_bounds(order: np.ndarray, wanted: int) -> Callable:
    """(a, least): a bound that certainly fills an anchor's window, the score of the last of its best in its own block."""

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column("a").to_numpy(), batch.column("label").to_numpy()
            rows, bound = dense(batch.column("v"), len(order)), np.full(batch.num_rows, NOTHING)
            for k in range(0, len(rows), BLOCK):
                own = slice(k, k + BLOCK)
                score = np.where(labels[own, None] == labels[None, own], rows[own] @ rows[own].T, NOTHING)
                np.fill_diagonal(score, NOTHING)
                if score.shape[1] >= wanted:
                    bound[own] = np.partition(score, -wanted, axis=1)[:, -wanted]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(bound)], ["a", "least"])

    return run_batches


class Mining:
    """One run over written rows (vec_id, label, v)."""

    def __init__(self, rows: DataFrame, is_anchor: Column, scratch: Scratch):
        self.rows, self.scratch, self.spark = rows, scratch, rows.sparkSession
        found = rows.select("v").mapInArrow(_energy, "dimension long, energy double, norm double")
        found = found.groupBy("dimension").agg(F.sum("energy").alias("energy"), F.max("norm").alias("norm")).collect()  # a row per dimension
        if max((r["norm"] for r in found), default=0) >= LARGEST:
            raise ValueError("scores of 2 ** 53 and more are not exact")
        energy = np.zeros(max((r["dimension"] for r in found), default=0) + 1)
        for r in found:
            energy[r["dimension"]] = r["energy"]
        self.order = np.argsort(-energy, kind="stable")
        anchors = rows.where(is_anchor).groupBy("vec_id", "label", "v").agg(F.count(F.lit(1)).alias("times"))
        self.anchors = scratch.written(anchors.select(F.monotonically_increasing_id().alias("a"), "*"), "anchors")
        self.n_anchors = self.anchors.count()

    def joined(self, asked: DataFrame, pick: Callable, kind: str) -> DataFrame:
        """What ``pick`` finds for the anchors in ``asked`` (a, and columns for ``pick``), in blocks of ``BLOCK``."""
        asked = self.scratch.written(asked, "asked")
        n = -(-asked.count() // BLOCK)
        folder = self.scratch.folder("blocks")
        asked.repartition(max(1, n)).write.option("maxRecordsPerFile", BLOCK).parquet(folder)
        return self.rows.mapInArrow(_search(folder, self.order, pick), kind)

    def top(self, found: DataFrame, keys: list[str], wanted: int, *first: Column) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), "other", *first))
        return found.withColumn("rank", rank).where(F.col("rank") <= wanted)

    def positives(self, wanted: int) -> DataFrame:
        """(a, rank, other, score): the first ``wanted`` other rows of each anchor's label."""
        bounds = self.anchors.repartition(-(-self.n_anchors // BLOCK) or 1).mapInArrow(_lower_bounds(self.order, wanted), "a long, least double")
        bounds = self.scratch.written(bounds, "bounds")
        open_ones = self.anchors.join(bounds, "a").select("a", "vec_id", "label", "v", "least")
        high = F.when(F.col("least") > 0, F.col("least") * START).otherwise(F.col("least"))
        done = []
        for least in (high, F.col("least")):  # the second is reached by enough rows, or by all rows
            found = self.joined(open_ones.withColumn("least", least), _positives(wanted), "a long, other long, score long, itself boolean")
            found = self.top(found, ["a"], wanted + 1, F.col("itself"))
            # one copy of the anchor itself goes, if it is among them
            alike = F.row_number().over(W.partitionBy("a", "itself").orderBy("rank"))
            found = found.withColumn("alike", alike).where("not itself or alike > 1")
            found = self.scratch.written(self.top(found, ["a"], wanted), "positives").select("a", "rank", "other", "score")
            full = found.where(F.col("rank") == wanted).select("a")
            done.append(found.join(full, "a", "left_semi") if not done else found)
            open_ones = open_ones.join(full, "a", "left_anti")
        return done[0].unionByName(done[1])

    def negatives(self, positives: DataFrame, wanted: int, percent: int) -> DataFrame:
        """(a, top, rank, other, score): the first ``wanted`` rows of other labels with a score of at most ``top``, a score of
        one of the anchor's positives, and of at least ``percent`` of it."""
        floor = F.expr(f"cast(ceil(cast({percent} as decimal(20,0)) * top / 100) as bigint)")
        tops = positives.where("score >= 0").select("a", F.col("score").alias("top")).distinct().withColumn("floor", floor)
        tops = self.scratch.written(tops, "tops")
        first = F.expr(f"greatest(floor, cast(ceil(cast({FIRST} as decimal(20,0)) * top / 100) as bigint))")
        done = []
        for least in (first, F.col("floor")):
            windows = tops.groupBy("a").agg(F.collect_list(F.struct("top", least.alias("least"))).alias("windows"))  # a positive each
            asked = self.anchors.select("a", "label", "v").join(windows, "a")
            found = self.joined(asked, _negatives(wanted), "a long, top long, other long, score long")
            found = self.scratch.written(self.top(found, ["a", "top"], wanted), "negatives").select("a", "top", "rank", "other", "score")
            full = found.where(F.col("rank") == wanted).select("a", "top")
            done.append(found.join(full, ["a", "top"], "left_semi") if not done else found)
            tops = tops.join(full, ["a", "top"], "left_anti")
        return done[0].unionByName(done[1])


def hard_negatives(
    rows: DataFrame, vec_id: str, label: str, vector: str, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vector`` is an array of whole numbers and ``label`` a whole number. ``is_anchor`` is a condition on a column ``vec_id``. An anchor's
    positives are its first ``positives`` other rows of its label; a positive's negatives are the first ``negatives`` rows of other labels
    whose score is at most the positive's and at least ``percent`` percent of it. Higher scores come first, ties by smaller id.

    Rows with a NULL id, label or vector, or a NULL component, take no part. Missing dimensions count as 0. Repeated rows are rows of
    their own: a copy of an anchor is one of its other rows, and a repeated anchor repeats its answers. A positive with a
    negative score has no negatives. An empty table and one without anchors give no rows. Other columns are not read. Scores that could
    reach 2 ** 53 are an error.
    """
    scratch = Scratch(rows.sparkSession, "negatives")
    named = rows.select(*[F.col(f"`{c}`").cast(kind).alias(name) for c, kind, name in ((vec_id, "long", "vec_id"), (label, "long", "label"), (vector, "array<long>", "v"))])
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", F.isnull)
    mining = Mining(scratch.written(named.where(usable), "rows"), is_anchor, scratch)
    own = scratch.written(mining.positives(positives), "own")
    found = mining.negatives(own, negatives, percent)
    pairs = own.select("a", F.col("other").alias("positive_id"), F.col("score").alias("top"))
    times = mining.anchors.select("a", F.col("vec_id").alias("anchor_id"), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
    return pairs.join(found, ["a", "top"]).join(times, "a").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"),
        F.col("top").alias("positive_score"), F.col("score").alias("negative_score"),
    )
