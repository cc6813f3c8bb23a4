"""Quality by the perplexity of an interpolated modified Kneser-Ney model of byte n-grams.

The model is trained on all trusted documents, per language: raw counts of the highest order, continuation counts (distinct
bytes to the left) below it, three discounts per order and language from the counts of counts. All counts are
grouped tables; probabilities are computed by joining them, order by order, for the distinct n-grams that documents have.

``score_words`` does this with words (``word_model``) and takes its bound from held-out texts; ``score`` does it with bytes, as follows, for
texts that have no words or are too small for a model of words.

Texts are never shuffled. A block is an input file: one pass lists the distinct n-grams of each task's part of a block, their
probabilities are joined to that list, dealt by block and written to the shared folder, and a last pass reads each
block's probabilities (no more than its texts have n-grams) beside its texts. Which documents are trusted travels
to the blocks in the same way. A table that does not come from files is written to the shared folder first.

A document is kept if its perplexity is at most the ``QUANTILE`` of its language's trusted documents, read
from a histogram of log perplexities with cells of ``CELL``, plus a margin for not having been trained on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm import shared_files, word_model
from fieldtally.llm.scratch import Scratch, shuffles_dropped
from fieldtally.llm.words import RUN_BYTES, texts_of
from fieldtally.workspace import drop_run

LANGUAGES = ("en", "de", "fr", "es")
ORDER = 4
MIN_BYTES = 200  #: shorter texts are not judged
QUANTILE = 0.99
MARGIN = 0.02  #: of the log perplexity
CELL = 0.001
ALPHABET = 256


def codes(column: pa.Array, label: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: index of the first, where each begins, and the key of the n-gram that ends at each byte: its language
    above 32 bits that hold ``ORDER`` bytes, zeros before the text."""
    data, offsets = texts_of(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + RUN_BYTES, "right")) - 1)
        part = data[offsets[first] : offsets[last]].astype(np.int64)
        own = offsets[first : last + 1] - offsets[first]
        sizes = np.diff(own)
        place = np.arange(len(part)) - np.repeat(own[:-1], sizes)
        key = part + (np.repeat(label[first:last], sizes) << 32)
        for back in range(1, ORDER):
            before = np.zeros_like(part)
            before[back:] = part[:-back]
            before[place < back] = 0
            key += before << (8 * back)
        yield first, own, key
        first = last


def labels_of(batch: pa.RecordBatch, languages: Sequence[str]) -> np.ndarray:
    place = {name: k for k, name in enumerate(languages)}
    return np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()], dtype=np.int64)


class BlockFiles:
    """The rows of one block in a folder written with ``partitionBy("block")``; the last block read is kept."""

    def __init__(self, folder: str):
        self.folder, self.block, self.rows = folder, None, None

    def read(self, block: int, columns: list[str]) -> pa.Table | None:
        if block != self.block:
            system, path = shared_files.resolve(f"{self.folder}/block={block}")
            found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
            parts = []
            for info in found:
                if info.base_name.endswith(".parquet"):
                    with system.open_input_file(info.path) as source:
                        parts.append(pq.ParquetFile(source).read(columns=columns))
            self.block, self.rows = block, pa.concat_tables(parts) if parts else None
        return self.rows


def _count(trusted_folder: str, languages: Sequence[str], all_texts: bool) -> Callable:
    """Distinct keys: of all texts by block without counts, or of the trusted ones with counts."""

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trusted = BlockFiles(trusted_folder)
        block, keys, numbers = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        names = ["block", "key", "n"]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block, np.int64)), pa.array(keys), pa.array(numbers)], names)

        for batch in batches:
            label = labels_of(batch, languages)
            blocks = batch.column("block").to_numpy()
            for own_block in np.unique(blocks):
                if own_block != block:
                    if len(keys):
                        yield out()
                    block, keys, numbers = own_block, keys[:0], numbers[:0]
                here = np.flatnonzero(blocks == own_block)
                label_here = label[here]
                if not all_texts:
                    ids = trusted.read(int(own_block), ["th"])
                    known = np.isin(batch.column("th").to_numpy()[here], ids.column("th").to_numpy()) if ids is not None else np.zeros(len(here), bool)
                    label_here = np.where(known, label_here, -1)
                found = [(keys, numbers)]
                for _first, _own, key in codes(batch.column("text").take(pa.array(here)), label_here):
                    key = key[key >= 0]
                    found.append(np.unique(key, return_counts=True))
                    if sum(len(f[0]) for f in found) > 1 << 21:
                        found = [merged(found)]
                keys, numbers = merged(found)
        if len(keys):
            yield out()

    return run_batches


def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    weights = np.concatenate([f[1] for f in found])
    return keys, np.bincount(place, weights=weights, minlength=len(keys)).astype(np.int64)


def _score(folder: str, languages: Sequence[str]) -> Callable:
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = BlockFiles(folder)
        block, known, logs = None, None, None
        for batch in batches:
            label = labels_of(batch, languages)
            blocks = batch.column("block").to_numpy()
            total, size = np.zeros(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64)
            for own_block in np.unique(blocks):
                here = np.flatnonzero(blocks == own_block)
                if own_block != block:
                    rows = model.read(int(own_block), ["key", "logp"])
                    block, known, logs = own_block, np.zeros(0, np.int64), np.zeros(0)
                    if rows is not None:
                        known, at = np.unique(rows.column("key").to_numpy(), return_index=True)
                        logs = rows.column("logp").to_numpy()[at]
                for first, own, key in codes(batch.column("text").take(pa.array(here)), label[here]):
                    sizes = np.diff(own)
                    at = here[first : first + len(sizes)]
                    size[at] = sizes
                    some = np.flatnonzero((sizes > 0) & (label[at] >= 0))
                    if len(some):
                        value = np.where(key >= 0, logs[np.minimum(np.searchsorted(known, key), len(known) - 1)], 0.0)
                        sums = np.concatenate(([0.0], np.cumsum(value)))
                        total[at[some]] = (sums[own[1:]] - sums[own[:-1]])[some]
            judged = (label >= 0) & (size > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("th"), batch.column("lang"), batch.column("block"), pa.array(size),
                    pa.array(-total / np.maximum(size, 1), mask=~judged),
                ],
                ["doc_id", "th", "lang", "block", "n_bytes", "log_perplexity"],
            )

    return run_batches


def discounts(counts: DataFrame, lang: Column | None = None) -> DataFrame:
    """(lang, d1, d2, d3) from (key, c); a row per language. Missing counts of counts give the usual fallback of 0.5, 1, 1.5."""
    how_many = [F.sum(F.when(F.col("c") == i, 1).otherwise(0)).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    rows = counts.groupBy((F.shiftright("key", 32) if lang is None else lang).alias("lang")).agg(*how_many)
    y = "n1 / (n1 + 2 * n2)"
    full = "n1 > 0 AND n2 > 0 AND n3 > 0"
    return rows.select(
        "lang", F.expr(f"CASE WHEN {full} THEN greatest(0.05, 1 - 2 * {y} * n2 / n1) ELSE 0.5 END").alias("d1"),
        F.expr(f"CASE WHEN {full} THEN greatest(0.05, 2 - 3 * {y} * n3 / n2) ELSE 1.0 END").alias("d2"),
        F.expr(f"CASE WHEN {full} THEN greatest(0.05, 3 - 4 * {y} * n4 / n3) ELSE 1.5 END").alias("d3"),
    )


def suffix(key: Column, n: int) -> Column:
    """The last ``n`` bytes of an n-gram, with its language."""
    return F.shiftleft(F.shiftright(key, 32), 32) + key.bitwiseAND(F.lit((1 << 8 * n) - 1))


def context(key: Column) -> Column:
    return F.shiftleft(F.shiftright(key, 32), 32) + F.shiftright(key.bitwiseAND(F.lit(0xFFFFFFFF)), 8)


def probabilities(counts: DataFrame, types: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, p) for the distinct n-grams ``types`` (key), from the trusted counts (key, c) of the highest order."""
    tables = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):  # how many distinct bytes stand to the left
        lower = tables[n + 1].groupBy(suffix(F.col("key"), n).alias("key")).agg(F.count(F.lit(1)).alias("c"))
        tables[n] = scratch.written(lower, f"order-{n}")
    p = None
    for n in range(1, ORDER + 1):
        asked = types if n == ORDER else types.select(suffix(F.col("key"), n).alias("key")).distinct()
        d = scratch.written(discounts(tables[n]), f"discounts-{n}")  # a row per language
        counted = tables[n].withColumn("lang", F.shiftright("key", 32)).join(d, "lang")
        cut = F.expr("CASE c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END")
        counted = counted.select("key", "c", cut.alias("d"))
        contexts = counted.groupBy(context(F.col("key")).alias("context")).agg(F.sum("c").alias("total"), F.sum("d").alias("taken"))
        rows = asked.join(counted, "key", "left").withColumn("context", context(F.col("key"))).join(contexts, "context", "left")
        if p is None:
            rows = rows.withColumn("lower", F.lit(1.0 / ALPHABET))
        else:
            rows = rows.withColumn("short", suffix(F.col("key"), n - 1)).join(p.select(F.col("key").alias("short"), F.col("p").alias("lower")), "short")
        value = F.when(F.col("total").isNull(), F.col("lower")).otherwise(
            (F.coalesce(F.greatest(F.col("c") - F.col("d"), F.lit(0.0)), F.lit(0.0)) + F.col("taken") * F.col("lower")) / F.col("total")
        )
        p = scratch.written(rows.select("key", value.alias("p")), f"p-{n}")
    return p


def score(
    docs: DataFrame, trusted: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", languages: Sequence[str] = LANGUAGES,
) -> DataFrame:
    """Rows (doc_id, lang, n_bytes, perplexity, threshold, kept), one per row of ``docs``; ``trusted`` has the ids (doc_id) of
    the documents to learn from.

    NULL and empty texts have no perplexity and are not kept. Texts of fewer than ``MIN_BYTES`` bytes and texts in a language that is not in
    ``languages``, or has no trusted text, are kept without being judged. Repeated rows count as often as they occur and get equal answers.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "perplexity")
    if not docs.inputFiles():
        docs = scratch.written(docs, "docs")
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"),
        F.xxhash64(F.input_file_name()).alias("block"),
    ).withColumn("th", F.xxhash64("doc_id", "text"))

    good = trusted.select(F.col("doc_id").alias("good")).distinct()
    known = rows.select("doc_id", "th", "block").join(good, F.col("doc_id") == F.col("good"), "left_semi").select("th", "block").distinct()
    trusted_folder = scratch.folder("trusted")
    known.repartition("block").write.partitionBy("block").parquet(trusted_folder)

    given = rows.select("text", "lang", "block", "th")
    kind = "block long, key long, n long"
    counts = given.mapInArrow(_count(trusted_folder, languages, False), kind).groupBy("key").agg(F.sum("n").alias("c"))
    counts = scratch.written(counts, "counts")
    asked = scratch.written(given.mapInArrow(_count(trusted_folder, languages, True), kind).select("block", "key"), "asked")
    p = probabilities(counts, asked.select("key").distinct(), scratch)
    folder = scratch.folder("scores")
    dealt = asked.join(p, "key").select("block", "key", F.log("p").alias("logp"))
    dealt.repartition("block").sortWithinPartitions("block", "key").write.option("compression", "zstd").partitionBy("block").parquet(folder)

    schema = T.StructType().add("doc_id", rows.schema["doc_id"].dataType).add("th", "long").add("lang", "string")
    schema = schema.add("block", "long").add("n_bytes", "long").add("log_perplexity", "double")
    scored = scratch.written(rows.mapInArrow(_score(folder, languages), schema), "scored")
    marks = spark.read.parquet(trusted_folder).select("th") if known_any(spark, trusted_folder) else scored.select("th").limit(0)
    return verdicts(scored, marks.distinct(), scratch)


def verdicts(scored: DataFrame, marks: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``scored`` judged by the bound that those with a mark (th) give each language."""
    own = scored.where(f"n_bytes >= {MIN_BYTES} and log_perplexity is not null").join(marks, "th", "left_semi")
    cells = own.groupBy("lang", F.floor(F.col("log_perplexity") / CELL).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    by_lang = W.partitionBy("lang").orderBy("cell")
    cells = cells.withColumn("up_to", F.sum("n").over(by_lang)).withColumn("all", F.sum("n").over(W.partitionBy("lang")))
    bounds = cells.where(F.col("up_to") >= QUANTILE * F.col("all")).groupBy("lang").agg(F.min("cell").alias("cell"))
    bounds = scratch.written(bounds.select("lang", ((F.col("cell") + 1) * CELL * (1 + MARGIN)).alias("bound")), "bounds")
    judged = scored.join(bounds, "lang", "left")
    free = (F.col("n_bytes") < MIN_BYTES) | F.col("log_perplexity").isNull() | F.col("bound").isNull()
    return judged.select(
        "doc_id", "lang", "n_bytes", F.exp("log_perplexity").alias("perplexity"), F.exp("bound").alias("threshold"),
        ((F.col("n_bytes") > 0) & (free | (F.col("log_perplexity") <= F.col("bound")))).alias("kept"),
    )


HELD_OUT = 10  #: one of so many trusted texts is not trained on and gives the bound


def _from_files(docs: DataFrame) -> bool:
    """Whether each row comes straight from a file, so that every pass finds it in the same place."""
    return bool(docs.inputFiles()) and docs.select(F.input_file_name().alias("file")).where("file = ''").isEmpty()


def score_words(
    docs: DataFrame, trusted: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", languages: Sequence[str] = LANGUAGES,
) -> DataFrame:
    """As ``score``, but by n-grams of three words, and per word. The tables grow with the text; they are counted as ``word_model`` describes.

    A model of words knows what it was trained on far better than anything else, so a bound from trained texts would reject
    what is new: one of ``HELD_OUT`` trusted texts (all copies of it) is not trained on, and these give the bound. A language
    without held-out texts is not judged, and its texts have a perplexity if any text of it was trained on. Texts with a NULL language have none."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "word-perplexity")
    with shuffles_dropped(spark):
        if not _from_files(docs):
            docs = scratch.written(docs, "docs")
        body = F.col(f"`{text}`").cast("string")
        rows = docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"),
            F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("block"),
        ).withColumn("th", F.xxhash64("doc_id", "text"))
        held = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(HELD_OUT)) == 0
        good = trusted.select(F.col("doc_id").alias("good")).distinct()
        known = rows.select("doc_id", "th", "block", held.alias("held")).join(good, F.col("doc_id") == F.col("good"), "left_semi")
        known = scratch.written(known.select("th", "block", "held").distinct(), "known")
        trusted_folder = scratch.folder("trusted")
        known.where("not held").select("th", "block").repartition("block").write.partitionBy("block").parquet(trusted_folder)
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(1, -(-size // word_model.SHARD_BYTES))

        given, folders, levels = rows.select("text", "lang", "block", "th"), {}, {}
        for order in word_model.ORDERS:
            folder = scratch.folder(f"answers-{order}")
            for part in range(word_model.PARTS[order]):
                asked = given.mapInArrow(word_model.ask(order, languages, shards, trusted_folder, dict(folders), part), word_model.REQUEST)
                answers = asked.groupBy("shard").applyInArrow(word_model.answer(order), word_model.ANSWER)
                answers.repartition("block").write.mode("append").partitionBy("block").parquet(folder)
            folders = {order: folder}  # each pass needs what the one before was answered
            levels[order] = folder
        models = {k: {} for k in range(len(languages))}
        for order, folder in levels.items():
            if known_any(spark, folder):
                sums = [F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "types", "total")]
                own = F.floor(F.col("shard") / shards).cast("int").alias("own")
                for r in spark.read.schema(word_model.ANSWER).parquet(folder).groupBy(own).agg(*sums).collect():  # a row per language
                    models[r["own"]][order] = word_model.Level(*[r[c] for c in ("n1", "n2", "n3", "n4", "types", "total")])
        models = {k: m for k, m in models.items() if 1 in m and m[1].total}
        schema = T.StructType().add("doc_id", rows.schema["doc_id"].dataType).add("th", "long").add("lang", "string")
        schema = schema.add("block", "long").add("n_bytes", "long").add("log_perplexity", "double")
        scored = scratch.written(rows.select("doc_id", "text", "lang", "block", "th").mapInArrow(word_model.score(languages, shards, levels, models), schema), "scored")
        for folder in levels.values():
            drop_run(spark, folder)
        return verdicts(scored, known.where("held").select("th").distinct(), scratch)


def known_any(spark, folder: str) -> bool:
    """Whether a partitioned table has any row; an empty one has no files to read."""
    system, path = shared_files.resolve(folder)
    return any(i.type == fs.FileType.Directory for i in system.get_file_info(fs.FileSelector(path, allow_not_found=True)))
