"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item is one window as a
whole). Both sides are fingerprinted alike: of every ``WINDOW - GRAM + 1`` neighbouring hashes of
``GRAM`` words the smallest is kept, so any shared span of ``WINDOW`` words shares at least one
fingerprint. Short items are fingerprinted by their own length, which documents then try at every word.

The fingerprints of the items go into a Bloom filter of a fixed number of bits, the only thing that
is broadcast. Documents are read once: a text without a fingerprint in the filter is done,
the others are written to the shared folder with theirs and joined with the items' fingerprints
by hash. Each pair of document and item found is then extended to its whole shared spans by
comparing all windows of the two texts, so neither a chance hit of the filter nor one of a
fingerprint remains. A larger benchmark fills the filter, which costs work and never a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm.membership import without
from fieldtally.llm.scratch import Scratch
from fieldtally.llm.words import ALNUM, Run, grams, mixed, runs

WINDOW = 10
GRAM = 5
FILTER_BITS = 23  #: the filter has 2 ** 23 bits, 1 MB
_PROBES = (np.uint64(0), np.uint64(0x2545F4914F6CDD1D))


def tagged(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of runs of ``n`` words, different for each ``n``; 0 stands for the winnowed ones."""
    return mixed(grams(words, n or GRAM) + np.uint64(n))


def inside(run: Run, n: int) -> np.ndarray:
    """Where runs of ``n`` words begin that end in the same text."""
    number = np.maximum(run.counts() - n + 1, 0)
    total = int(number.sum())
    first = np.concatenate(([0], np.cumsum(number)[:-1])) if len(number) else number
    return np.arange(total) + np.repeat(run.words[:-1] - first, number)


def winnowed(run: Run, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints of texts of at least ``WINDOW`` words."""
    hashes = tagged(words, 0)
    width = WINDOW - GRAM + 1
    starts = inside(run, WINDOW)
    if not len(starts):
        return starts, hashes[:0]
    size = len(hashes) - width + 1
    least, place = hashes[:size].copy(), np.zeros(size, dtype=np.int8)
    for k in range(1, width):
        other = hashes[k : k + size]
        less = other < least
        least[less] = other[less]
        place[less] = k
    chosen = starts + place[starts]
    chosen = chosen[np.append(True, chosen[1:] != chosen[:-1])]
    return chosen, hashes[chosen]


def _item_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, lengths, found = [], [], []
        for run in runs(batch.column("text"), ALNUM):
            words, counts = run.hashes(), run.counts()
            places, hashes = winnowed(run, words)
            rows.append(run.first + np.searchsorted(run.words, places, "right") - 1)
            lengths.append(np.zeros(len(places), dtype=np.int32))
            found.append(hashes)
            for i in np.flatnonzero((counts > 0) & (counts < WINDOW)):
                own = words[run.words[i] : run.words[i + 1]]
                rows.append(np.array([run.first + i]))
                lengths.append(np.array([counts[i]], dtype=np.int32))
                found.append(tagged(own, int(counts[i])))
        take = pa.array(np.concatenate(rows)) if rows else pa.array([], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item").take(take),
                pa.array(np.concatenate(lengths) if rows else [], pa.int32()),
                pa.array(np.concatenate(found).view(np.int64) if rows else [], pa.int64()),
            ],
            ["item", "length", "fp"],
        )


def probes(fp: np.ndarray, filter_bits: int) -> list[np.ndarray]:
    return [mixed(fp ^ seed) >> np.uint64(64 - filter_bits) for seed in _PROBES]


def _filter_words(filter_bits: int) -> Callable:
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unique(np.concatenate(probes(batch.column("fp").to_numpy().view(np.uint64), filter_bits)))
            word, at = np.unique(bits >> np.uint64(6), return_index=True)
            values = np.bitwise_or.reduceat(np.uint64(1) << (bits & np.uint64(63)), at) if len(bits) else bits
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(values.view(np.int64))], ["w", "b"])

    return run_batches


def _suspects(shared, lengths: list[int], filter_bits: int) -> Callable:
    """(key, text) -> (key, n_words, text where a fingerprint is in the filter, those fingerprints)."""

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint64)

        def hit(hashes: np.ndarray) -> np.ndarray:
            found = np.ones(len(hashes), dtype=bool)
            for p in probes(hashes, filter_bits):
                found &= (bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
            return found

        for batch in batches:
            n = batch.num_rows
            n_words = np.zeros(n, dtype=np.int64)
            rows, found = [], []
            for run in runs(batch.column("text"), ALNUM):
                words = run.hashes()
                n_words[run.first : run.first + run.n_texts] = run.counts()
                kinds = [winnowed(run, words)]
                for length in lengths:
                    starts = inside(run, length)
                    kinds.append((starts, tagged(words, length)[starts] if len(starts) else words[:0]))
                for places, hashes in kinds:
                    some = hit(hashes)
                    rows.append(run.first + np.searchsorted(run.words, places[some], "right") - 1)
                    found.append(hashes[some])
            row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            fps = np.concatenate(found) if rows else np.zeros(0, np.uint64)
            order = np.argsort(row, kind="stable")
            counts = np.bincount(row, minlength=n)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(fps[order].view(np.int64))
            )
            text = batch.column("text")
            text = pa.compute.if_else(pa.array(counts > 0), text, pa.scalar(None, text.type))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(n_words), text, lists],
                ["doc_id", "th", "n_words", "text", "fps"],
            )

    return run_batches


def _windows(run: Run, words: np.ndarray, i: int, n: int) -> np.ndarray:
    return grams(words[run.words[i] : run.words[i + 1]], n)


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, th, text, item_id, item_text) -> (doc_id, th, item_id, spans), the spans as [start, end) pairs."""
    for batch in batches:
        spans = [[] for _ in range(batch.num_rows)]
        items = {}
        for run in runs(batch.column("item_text"), ALNUM):
            words, counts = run.hashes(), run.counts()
            for i in range(run.n_texts):
                n = int(min(WINDOW, counts[i]))
                items[run.first + i] = (n, np.unique(_windows(run, words, i, n)) if n else words[:0])
        for run in runs(batch.column("text"), ALNUM):
            words = run.hashes()
            for i in range(run.n_texts):
                n, wanted = items[run.first + i]
                own = _windows(run, words, i, n) if n else words[:0]
                if not len(own) or not len(wanted):
                    continue
                at = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
                hits = np.flatnonzero(wanted[at] == own)
                if len(hits):
                    cut = np.flatnonzero(np.diff(hits) > n) + 1
                    begin = hits[np.append(0, cut)]
                    end = hits[np.append(cut - 1, len(hits) - 1)] + n
                    spans[run.first + i] = [{"s": int(s), "e": int(e)} for s, e in zip(begin, end, strict=True)]
        kept = pa.array([bool(s) for s in spans], pa.bool_())
        kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").filter(kept), batch.column("th").filter(kept),
                batch.column("item_id").filter(kept), pa.array([s for s in spans if s], kind),
            ],
            ["doc_id", "th", "item_id", "spans"],
        )


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, th, text): rows with equal id and text have equal results and need no other name."""
    body = F.col(f"`{text}`").cast("string")
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("th"), body.alias("text"))


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Rows (doc_id, th, n_words, n_hit, n_items, items_sha256, contaminated), one per row of ``docs``.

    Text is lower-cased (A-Z); words are runs of digits, letters and non-ASCII characters. NULL and
    empty texts have no words and no hit; an item without words hits nothing. Repeated rows of ``docs`` all
    get the same answer, repeated items count once by id, items without an id mark words but
    are not listed. With an empty benchmark nothing is hit. ``th`` is the hash of the text.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontam")
    narrow = keyed(docs, text, doc_id)
    body = F.col(f"`{item_text}`").cast("string")
    tests = items.select(F.struct(F.col(f"`{item_id}`").alias("item_id"), body.alias("text")).alias("item"), body.alias("text"))
    item_type = tests.schema["item"].dataType
    schema = T.StructType([T.StructField("item", item_type), T.StructField("length", T.IntegerType()), T.StructField("fp", T.LongType())])
    prints = scratch.written(tests.mapInArrow(_item_fingerprints, schema).distinct(), "item-fingerprints")
    lengths = sorted(r.length for r in prints.where("length > 0").select("length").distinct().collect())  # 1 to 9 at most
    words = prints.select("fp").mapInArrow(_filter_words(filter_bits), "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b"))
    bits = np.zeros(1 << (filter_bits - 6), dtype=np.int64)
    for r in words.collect():  # at most 2 ** 17 rows, whatever the benchmark's size
        bits[r.w] = r.b
    shared = spark.sparkContext.broadcast(bits.tobytes())

    id_type = narrow.schema["doc_id"].dataType
    schema = T.StructType().add("doc_id", id_type).add("th", "long").add("n_words", "long").add("text", "string").add("fps", T.ArrayType(T.LongType()))
    read = scratch.written(narrow.mapInArrow(_suspects(shared, lengths, filter_bits), schema), "read")
    suspects = read.where("text is not null")
    seeds = suspects.select("doc_id", "th", F.explode(F.array_distinct("fps")).alias("fp"))
    pairs = seeds.join(prints.select("fp", "item"), "fp").select("doc_id", "th", "item").distinct()
    same = [F.col("p.doc_id").eqNullSafe(F.col("d.doc_id")), F.col("p.th") == F.col("d.th")]
    texts = suspects.select("doc_id", "th", "text").dropDuplicates(["doc_id", "th"])
    full = pairs.alias("p").join(texts.alias("d"), same).select(
        "p.doc_id", "p.th", "d.text", F.col("item.item_id").alias("item_id"), F.col("item.text").alias("item_text")
    )
    schema = T.StructType().add("doc_id", id_type).add("th", "long")
    schema = schema.add("item_id", items.schema[item_id].dataType).add("spans", T.ArrayType(T.StructType().add("s", "long").add("e", "long")))
    found = full.mapInArrow(_extend, schema).groupBy("doc_id", "th").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.collect_set("item_id").alias("ids")
    )
    covered = (
        "aggregate(spans, named_struct('e', 0L, 't', 0L), (acc, x) -> named_struct('e', greatest(acc.e, x.e),"
        " 't', acc.t + greatest(0L, x.e - greatest(acc.e, x.s))), acc -> acc.t)"
    )
    found = found.select("doc_id", "th", F.expr(covered).alias("hit"), "ids")
    same = [F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")), F.col("r.th") == F.col("f.th")]
    ids = F.array_sort(F.transform(F.coalesce("ids", F.array().cast("array<string>")), lambda x: x.cast("string")))
    return (
        read.select("doc_id", "th", "n_words").alias("r").join(found.alias("f"), same, "left")
        .select(
            "r.doc_id", "r.th", "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(ids).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
            (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without a word inside a benchmark window."""
    bad = contamination(docs, items, text, doc_id).where("contaminated").select(F.struct("doc_id", "th").alias("key"))
    scratch = Scratch(docs.sparkSession, "contaminated")
    bad = scratch.written(bad, "contaminated")
    key = F.struct(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("th"))
    return without(docs, bad, key, scratch)
