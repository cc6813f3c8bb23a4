"""Language identification by Bayesian evidence fusion.

The posterior of a language is the product of four pieces of evidence, each neutral where it is missing:

* the text, by a naive Bayes model of letter trigrams (hashed into ``BUCKETS`` cells, trained on the whole table with
  the declared languages as labels); neighbouring trigrams say much the same, so each counts ``TEXT_WEIGHT``;
* the declared language (markup or metadata), right with probability ``DECLARED_RIGHT``;
* the host's prior and, one level up, that of its address suffix: languages of the host's documents as the text
  alone tells them, counted by grouped aggregation and smoothed towards the suffix, which is smoothed towards the whole table.

The table is read twice, for the model and for the likelihoods; the model has languages x ``BUCKETS`` cells
at most, so it can be broadcast. Priors are joined to rows that hold no text any more.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm.membership import without
from fieldtally.llm.scratch import Scratch
from fieldtally.llm.words import LOWER, RUN_BYTES, texts_of

LANGUAGES = ("en", "de", "fr", "es")
BUCKETS = 1 << 16
TEXT_WEIGHT = 0.1
DECLARED_RIGHT = 0.9
SMOOTHING = 50.0  #: rows that a prior one level up counts for
MIN_POSTERIOR = 0.6

_LETTERS = LOWER.copy()
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def trigrams(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: index of the first, cells of all trigrams of letters, and where each text's begin."""
    data, offsets = texts_of(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + RUN_BYTES, "right")) - 1)
        part = _LETTERS[data[offsets[first] : offsets[last]]].astype(np.uint32)
        own = offsets[first : last + 1] - offsets[first]
        text = np.repeat(np.arange(last - first), np.diff(own))
        code = part[:-2] | (part[1:-1] << np.uint32(8)) | (part[2:] << np.uint32(16))
        fit = (text[:-2] == text[2:]) & (part[:-2] + part[1:-1] + part[2:] != 0x60) if len(part) > 2 else np.zeros(0, bool)
        cells = ((code[fit] * np.uint32(0x9E3779B1)) >> np.uint32(16)) if len(part) > 2 else np.zeros(0, np.uint32)
        yield first, cells, np.searchsorted(text[:-2][fit], np.arange(last - first + 1)) if len(part) > 2 else np.zeros(last - first + 1, int)
        first = last


def _count(languages: Sequence[str]) -> Callable:
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        place = {name: k for k, name in enumerate(languages)}
        for batch in batches:
            label = np.array([place.get(x, -1) for x in batch.column("declared").to_pylist()], dtype=np.int64)
            for first, cells, starts in trigrams(batch.column("text")):
                own = np.repeat(label[first : first + len(starts) - 1], np.diff(starts))
                some = own >= 0
                counts += np.bincount(own[some] * BUCKETS + cells[some], minlength=counts.size).reshape(counts.shape)
        language, cell = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(language.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(counts[language, cell])],
            ["language", "cell", "n"],
        )

    return run_batches


def _likelihoods(shared, n_languages: int) -> Callable:
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.frombuffer(shared.value, dtype=np.float32).reshape(n_languages, BUCKETS)
        for batch in batches:
            sums = np.zeros((batch.num_rows, n_languages))
            number = np.zeros(batch.num_rows, dtype=np.int64)
            for first, cells, starts in trigrams(batch.column("text")):
                last = first + len(starts) - 1
                number[first:last] = np.diff(starts)
                some = first + np.flatnonzero(np.diff(starts))
                if len(some):
                    for k in range(n_languages):
                        sums[some, k] = np.add.reduceat(logs[k][cells].astype(np.float64), starts[:-1][np.diff(starts) > 0])
            flat = pa.array(sums.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, n_languages), pa.int32()), flat)
            keep = [batch.column(n) for n in ("doc_id", "declared", "suffix", "host")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(number), lists], ["doc_id", "declared", "suffix", "host", "n", "ll"])

    return run_batches


def identify(
    docs: DataFrame, text: Column, doc_id: Column, declared: Column | None = None, host: Column | None = None,
    suffix: Column | None = None, languages: Sequence[str] = LANGUAGES, addresses: DataFrame | None = None,
) -> DataFrame:
    """Rows (doc_id, declared, n_trigrams, lang, posterior, kept), one per row of ``docs``.

    ``kept`` is false where no language reaches ``MIN_POSTERIOR``, where the text has no letters (NULL, empty,
    blank, symbols), and where its trigrams are likelier by pure chance than in the language found.
    ``addresses`` (doc_id, suffix) gives the address suffixes of documents whose addresses lie in another table, instead of
    ``suffix``; of several the first in the order of text counts. It is joined to rows that hold no text any more.
    Unknown declared languages, and NULL hosts and suffixes, count as missing. Of tied languages the
    first in ``languages`` wins. An empty table gives no rows; repeated rows get equal answers.
    """
    spark, k = docs.sparkSession, len(languages)
    scratch = Scratch(spark, "langid")
    none = F.lit(None).cast("string")
    pick = lambda c: none if c is None else F.lower(c.cast("string"))
    rows = docs.select(
        doc_id.alias("doc_id"), text.cast("string").alias("text"), pick(declared).alias("declared"),
        pick(suffix).alias("suffix"), pick(host).alias("host"),
    )
    counted = rows.select("text", "declared").mapInArrow(_count(languages), "language int, cell int, n long")
    cells = counted.groupBy("language", "cell").agg(F.sum("n").alias("n"))
    table = np.full((k, BUCKETS), 0.5)
    for part in cells.toArrow().to_batches():  # at most languages x BUCKETS cells
        language, cell, n = (part.column(i).to_numpy() for i in range(3))
        table[language, cell] += n
    logs = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    shared = spark.sparkContext.broadcast(logs.tobytes())
    schema = T.StructType([f for f in rows.schema if f.name != "text"]).add("n", "long").add("ll", T.ArrayType(T.DoubleType()))
    order = ["doc_id", "declared", "suffix", "host", "n", "ll"]
    scored = scratch.written(rows.mapInArrow(_likelihoods(shared, k), T.StructType([schema[n] for n in order])), "likelihoods")

    if addresses is not None:
        known = addresses.where("doc_id is not null and suffix is not null").groupBy("doc_id").agg(F.min(F.lower("suffix")).alias("suffix"))
        scored = scratch.written(scored.drop("suffix").join(known, "doc_id", "left").select(order), "addressed")

    def best(values: Column) -> Column:
        return F.array_position(values, F.array_max(values)).cast("int")

    # priors: what the text alone says, counted by host, by suffix and over all
    told = scored.where("n > 0").select("host", "suffix", best(F.col("ll")).alias("g"))
    told = scratch.written(told.groupBy("host", "suffix", "g").agg(F.count(F.lit(1)).alias("n")), "told")

    def shares(*names: str) -> DataFrame:
        counts = [F.sum(F.when(F.col("g") == i + 1, F.col("n")).otherwise(0)) for i in range(k)]
        return told.groupBy(*names).agg(F.array(*counts).alias("c"))

    def smoothed(counts: Column, above: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.transform(counts, lambda x, i: (x + F.lit(SMOOTHING) * F.element_at(above, i + 1)) / (total + SMOOTHING))

    even = F.array(*[F.lit(1.0 / k)] * k)
    total_row = shares().first()  # one row of ``k`` numbers
    base = [float(x or 0) for x in (total_row["c"] or [0] * k)]
    base = F.array(*[F.lit((x + SMOOTHING / k) / (sum(base) + SMOOTHING)) for x in base])
    by_suffix = shares("suffix").where("suffix is not null").select("suffix", smoothed(F.col("c"), base).alias("suffix_prior"))
    by_host = shares("host", "suffix").where("host is not null")
    by_host = by_host.join(by_suffix, "suffix", "left")
    by_host = by_host.select("host", F.col("suffix").alias("host_suffix"), smoothed(F.col("c"), F.coalesce("suffix_prior", base)).alias("host_prior"))
    hosts = scratch.written(by_host, "hosts").alias("h")
    suffixes = scratch.written(by_suffix, "suffixes").withColumnRenamed("suffix", "known_suffix")
    joined = scored.join(hosts, (scored["host"] == F.col("h.host")) & scored["suffix"].eqNullSafe(F.col("h.host_suffix")), "left")
    joined = joined.drop(F.col("h.host")).join(suffixes, F.col("suffix") == F.col("known_suffix"), "left")
    prior = F.coalesce("host_prior", "suffix_prior", base)
    names = F.array(*[F.lit(x) for x in languages])
    known = F.array_contains(names, F.col("declared"))
    claim = F.when(F.coalesce(known, F.lit(False)), F.transform(names, lambda x: F.when(x == F.col("declared"), DECLARED_RIGHT).otherwise((1 - DECLARED_RIGHT) / max(k - 1, 1)))).otherwise(even)
    joined = joined.withColumn("logs", F.transform(F.arrays_zip(F.col("ll").alias("l"), prior.alias("p"), claim.alias("c")), lambda x: x["l"] * TEXT_WEIGHT + F.log(x["p"]) + F.log(x["c"])))
    joined = joined.withColumn("top", F.array_max("logs")).withColumn("g", best(F.col("logs")))
    joined = joined.withColumn("posterior", 1 / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    fits = (F.col("n") > 0) & (F.col("posterior") >= MIN_POSTERIOR) & (F.element_at("ll", F.col("g")) >= F.col("n") * math.log(1 / BUCKETS))
    return joined.select(
        "doc_id", "declared", F.col("n").alias("n_trigrams"), F.when(F.col("n") > 0, F.element_at(names, F.col("g"))).alias("lang"),
        F.when(F.col("n") > 0, F.col("posterior")).alias("posterior"), F.coalesce(fits, F.lit(False)).alias("kept"),
    )


def keep_identified(docs: DataFrame, text: Column, doc_id: Column, **evidence: Column) -> DataFrame:
    """The rows of ``docs`` whose language is told; rows alike in id, evidence and text share their fate."""
    key = F.struct(doc_id.alias("id"), F.xxhash64(text.cast("string"), *evidence.values()).alias("h"))
    bad = identify(docs, text, key, **evidence).where("not kept").select("doc_id")
    scratch = Scratch(docs.sparkSession, "langid-rejected")
    return without(docs, scratch.written(bad, "rejected"), key, scratch)
