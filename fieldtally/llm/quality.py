"""Quality rules by distribution divergence.

Each language has two reference distributions, counted over the whole table: classes of characters, and its common
words (those that make up at least ``COMMON`` of the language's words, so there are at most ``1 / COMMON`` of them) with
one cell for all others. A document is kept when the Jensen-Shannon distance (square root of the divergence,
base 2) of its own histograms to those references stays under both bounds. A histogram of few words says little, so
documents with fewer than ``MIN_WORDS`` words are not judged by it, nor are those of a language without reference.

The table is read twice. Word counts are combined in each batch and then grouped; what is broadcast has ``1 / COMMON`` words
and eight classes a language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm.scratch import Scratch
from fieldtally.llm.words import LOWER, SPACED, SPACES, Run, grams, mixed, runs

LANGUAGES = ("en", "de", "fr", "es")
COMMON = 0.002
MIN_WORDS = 60
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.48
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  #: percent

#: Classes of bytes: other ASCII, a-z, A-Z, digits, white space, marks, symbols, non-ASCII.
CLASSES = 8
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[SPACES] = 4
_CLASS[list(b".,;:!?'\"()-")] = 5
_CLASS[list(SYMBOLS)] = 6
_CLASS[0x80:] = 7


def class_counts(run: Run) -> np.ndarray:
    """Bytes of each class, a row per text."""
    text = np.repeat(np.arange(run.n_texts), np.diff(run.offsets))
    return np.bincount(text * CLASSES + _CLASS[run.data], minlength=run.n_texts * CLASSES).reshape(-1, CLASSES)


def lowered_hashes(run: Run) -> np.ndarray:
    """Hashes of the words with A-Z lower-cased; classes are counted on the bytes as they are."""
    return Run(run.first, LOWER[run.data], run.offsets, run.starts, run.ends, run.words).hashes()


def _references(languages: Sequence[str]) -> Callable:
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {name: k for k, name in enumerate(languages)}
        for batch in batches:
            label = np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()], dtype=np.int64)
            hashes, owners = [], []
            classes = np.zeros((len(languages), CLASSES), dtype=np.int64)
            for run in runs(batch.column("text"), SPACED, lower=False):
                own = label[run.first : run.first + run.n_texts]
                np.add.at(classes, own[own >= 0], class_counts(run)[own >= 0])
                owner = np.repeat(own, run.counts())
                hashes.append(lowered_hashes(run)[owner >= 0])
                owners.append(owner[owner >= 0])
            hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
            for k in range(len(languages)):
                words, n = np.unique(hashes[owners == k], return_counts=True)
                size = len(words) + CLASSES
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, k, np.int32)), pa.array(np.append(np.zeros(len(words), bool), np.ones(CLASSES, bool))),
                        pa.array(np.append(words.view(np.int64), np.arange(CLASSES))), pa.array(np.append(n, classes[k])),
                    ],
                    ["lang", "is_class", "cell", "n"],
                )

    return run_batches


def divergence(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``counts`` to ``reference``."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        one = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        two = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(axis=1)
    return np.sqrt(np.maximum((one + two) / 2, 0))


def repeated_words(run: Run, words: np.ndarray) -> np.ndarray:
    """For each text the words inside windows of ``REPEAT_WINDOW`` words that it has twice or more."""
    number = np.maximum(run.counts() - REPEAT_WINDOW + 1, 0)
    total = int(number.sum())
    out = np.zeros(run.n_texts, dtype=np.int64)
    if not total:
        return out
    starts = np.arange(total) + np.repeat(run.words[:-1] - np.concatenate(([0], np.cumsum(number)[:-1])), number)
    text = np.repeat(np.arange(run.n_texts, dtype=np.uint64), number)
    marks = mixed(grams(words, REPEAT_WINDOW)[starts] + text * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(marks)
    equal = marks[order[1:]] == marks[order[:-1]]
    twice = np.zeros(total, dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    change = np.zeros(len(words) + 1, dtype=np.int64)
    at = starts[twice]
    change[:-1] += np.bincount(at, minlength=len(words))
    change -= np.bincount(at + REPEAT_WINDOW, minlength=len(words) + 1)
    covered = np.cumsum(change[:-1]) > 0
    np.add.at(out, run.text_of_word()[covered], 1)
    return out


def duplicate_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _judge(shared, languages: Sequence[str]) -> Callable:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance")

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, words_of, shares = shared.value
        place = {name: k for k, name in enumerate(languages)}
        symbol = _CLASS == 6
        for batch in batches:
            n = batch.num_rows
            label = np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()], dtype=np.int64)
            found = {name: np.zeros(n, dtype=np.int64) for name in names[:5]}
            distances = {name: np.full(n, np.nan) for name in names[5:]}
            found["n_dup_lines"][:] = [duplicate_lines(x) for x in batch.column("text").to_pylist()]
            for run in runs(batch.column("text"), SPACED, lower=False):
                here = slice(run.first, run.first + run.n_texts)
                own, counts = label[here], run.counts()
                begins = SPACED[run.data] & ((run.data & 0xC0) != 0x80)
                sums = np.concatenate(([0], np.cumsum(begins)))
                found["n_words"][here] = counts
                found["word_chars"][here] = np.diff(sums[run.offsets])
                sums = np.concatenate(([0], np.cumsum(symbol[run.data])))
                found["n_symbols"][here] = np.diff(sums[run.offsets])
                found["n_repeat_words"][here] = repeated_words(run, run.hashes())
                histogram = class_counts(run)
                lowered = lowered_hashes(run)
                text = run.text_of_word()
                for k in range(len(languages)):
                    mine = np.flatnonzero((own == k) & (counts >= MIN_WORDS))
                    if not len(mine) or not len(words_of[k]):
                        continue
                    distances["class_distance"][run.first + mine] = divergence(histogram[mine], classes[k])
                    slot = np.full(run.n_texts, -1)
                    slot[mine] = np.arange(len(mine))
                    row = slot[text]
                    chosen, row = lowered[row >= 0], row[row >= 0]
                    at = np.minimum(np.searchsorted(words_of[k], chosen), len(words_of[k]) - 1)
                    cell = np.where(words_of[k][at] == chosen, at, len(words_of[k]))
                    width = len(words_of[k]) + 1
                    counted = np.bincount(row * width + cell, minlength=len(mine) * width).reshape(-1, width)
                    distances["word_distance"][run.first + mine] = divergence(counted, shares[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(found[x]) for x in names[:5]], *[pa.array(distances[x], mask=np.isnan(distances[x])) for x in names[5:]]],
                ["doc_id", *names],
            )

    return run_batches


def judge(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", languages: Sequence[str] = LANGUAGES,
) -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance, word_distance,
    base_failed, kept), one per row of ``docs``.

    NULL, empty and blank texts have no words and fail. Distances are NULL where a document is not judged by them; such
    documents are kept unless they fail the base rules. Distances at a bound pass. Repeated rows get equal answers, and an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    counted = rows.select("text", "lang").mapInArrow(_references(languages), "lang int, is_class boolean, cell long, n long")
    counted = counted.groupBy("lang", "is_class", "cell").agg(F.sum("n").alias("n"))
    counted = scratch.written(counted, "counts")
    totals = counted.groupBy("lang", "is_class").agg(F.sum("n").alias("total"))  # two rows a language
    common = counted.join(F.broadcast(totals), ["lang", "is_class"]).where(f"is_class or n >= {COMMON} * total")
    classes = [np.zeros(CLASSES) for _ in languages]
    words: list[dict[int, float]] = [{} for _ in languages]
    for r in common.collect():  # eight classes and at most 1 / COMMON words a language
        if not r["total"]:
            continue
        if r["is_class"]:
            classes[r["lang"]][r["cell"]] = r["n"] / r["total"]
        else:
            words[r["lang"]][r["cell"]] = r["n"] / r["total"]
    order = [np.sort(np.array(list(w), dtype=np.int64).view(np.uint64)) for w in words]
    shares = [np.array([words[k][int(x)] for x in order[k].view(np.int64)] + [max(0.0, 1 - sum(words[k].values()))]) for k in range(len(languages))]
    shared = spark.sparkContext.broadcast((classes, order, shares))
    schema = T.StructType().add("doc_id", rows.schema["doc_id"].dataType)
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        schema = schema.add(name, "long")
    schema = schema.add("class_distance", "double").add("word_distance", "double")
    judged = rows.mapInArrow(_judge(shared, languages), schema)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CLASS_DISTANCE) & (F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE)
    return judged.select("*", failed.alias("base_failed"), (~failed & near).alias("kept"))
