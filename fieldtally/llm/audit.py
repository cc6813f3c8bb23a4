"""How the sources of a language differ in their use of words, over all terms that enough documents have.

The terms are found by iceberg refinement of byte prefixes. At the first level the distinct documents of each prefix of
``FIRST_WIDTH`` bytes are counted; prefixes in fewer than ``least`` documents are discarded, and only terms with a kept prefix go on to
the next level, whose prefixes are twice as long, until no kept prefix is the beginning of a longer term. A term that is as short as its
level's prefixes is complete there and is counted by source in the same pass. So a rare term of any length is never shuffled
beyond the level at which its prefix becomes rare, and no term is counted twice.

Each level is one pass over the texts. Tasks know the kept prefixes from a Bloom filter of a fixed number of bits; what it lets
through by chance has a prefix in too few documents, hence itself too few, and falls at the next count. Counts are summed
in each Arrow batch (in parts of bounded size), then by Spark on the map side, then by key, so a hot source sends no more than a row per prefix and task.

Divergences are whole numbers throughout. The sum over all kept terms for each pair of sources is taken without visiting pairs of
terms that neither has: from the number of terms that a source lacks, a histogram of its shares, and corrections for terms that both have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldtally.llm.decontam import _filter_words, probes
from fieldtally.llm.scratch import Scratch
from fieldtally.llm.tokens import ragged
from fieldtally.llm.words import Run, byte_class, mixed, runs

#: Terms of ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` in text with A-Z lower-cased: letters and all that is not ASCII.
LETTERS = byte_class([*range(0x00, 0x61), *range(0x7B, 0x80)])
FIRST_WIDTH = 6  #: bytes of the first level's prefixes
LEAST = 3  #: documents of a kept term
TOP = 200  #: terms listed for each source
UNIT = 1_000_000_000
FILTER_BITS = 23
PAIRS = 1 << 21  #: pairs of sources that a task holds at once
HELD = 1 << 18  #: partial counts that a task holds at once, and those of one run more
_OPEN = np.uint64(0xA24BAED4963EE407)
_LEVEL = "place long, prefix binary, docs long, n long"


def prefixes(run: Run, width: int, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the hash of its first ``width`` bytes with its language's, and whether that is the whole word. A whole word and the
    beginning of a longer one differ."""
    sizes = run.ends - run.starts
    whole = sizes <= width
    cut = Run(run.first, run.data, run.offsets, run.starts, run.starts + np.minimum(sizes, width), run.words)
    hashes = cut.hashes() ^ np.where(whole, np.uint64(0), _OPEN)
    return mixed(hashes + np.repeat(lang, run.counts())), whole


def _some(run: Run, text: np.ndarray, words: np.ndarray) -> tuple[Run, np.ndarray]:
    """The run with some of its words only, and these words' texts."""
    text = text[words]
    borders = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=run.n_texts))))
    return Run(run.first, run.data, run.offsets, run.starts[words], run.ends[words], borders), text


def _level(width: int, before: int, shared) -> Callable:
    """Partial counts of one level: prefixes of ``width`` bytes of the words that were cut at ``before`` bytes and whose prefix was kept.
    The beginning of a longer word ends in a zero byte, and its place is the language; that of a whole word is the source."""

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint64) if shared else None
        for batch in batches:
            langs, sources = (batch.column(c).to_numpy().view(np.uint64) for c in ("lang", "source"))
            found, held = [], 0
            for run in runs(batch.column("text"), LETTERS):
                lang, source = (x[run.first : run.first + run.n_texts] for x in (langs, sources))
                text = run.text_of_word()
                if before:
                    run, text = _some(run, text, np.flatnonzero(run.ends - run.starts > before))
                    parent, _ = prefixes(run, before, lang)
                    kept = np.ones(len(parent), dtype=bool)
                    for p in probes(parent, FILTER_BITS):
                        kept &= (bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
                    run, text = _some(run, text, np.flatnonzero(kept))
                if not len(text):
                    continue
                key, whole = prefixes(run, width, lang)
                place = np.where(whole, source[text], lang[text])
                key = mixed(key ^ place)
                order = np.argsort(key, kind="stable")  # a key's words stay in the order of their texts
                key, at = key[order], text[order]
                new = np.append(True, key[1:] != key[:-1])
                first = np.flatnonzero(new)
                other_text = np.append(True, at[1:] != at[:-1]) | new
                word = order[first]
                n = np.diff(np.append(first, len(key)))
                sizes = np.minimum(run.ends[word] - run.starts[word], width)
                letters = run.data[ragged(run.starts[word], sizes)[0]]
                found.append((key[first], place[word], whole[word], np.add.reduceat(other_text, first, dtype=np.int64), n, sizes, letters))
                held += len(first)
                if held > HELD:
                    yield _summed(found)
                    found, held = [], 0
            if found:
                yield _summed(found)

    return run_batches


def _summed(found: list[tuple]) -> pa.RecordBatch:
    """The counts of some runs, a row per key."""
    key, place, whole, docs, n, sizes, letters = (np.concatenate(x) for x in zip(*found, strict=True))
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    docs, n = (np.bincount(number, weights=x, minlength=len(first)).astype(np.int64) for x in (docs, n))
    whole, own = whole[first], sizes[first]
    offsets = np.concatenate(([0], np.cumsum(own + ~whole))).astype(np.int32)
    out = np.zeros(offsets[-1], dtype=np.uint8)  # zeros end what goes on
    out[ragged(offsets[:-1], own)[0]] = letters[ragged((np.cumsum(sizes) - sizes)[first], own)[0]]
    names = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(place[first].view(np.int64)), names, pa.array(docs), pa.array(n)], ["place", "prefix", "docs", "n"])


def _filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filter's words that hold the prefixes (lang, prefix) of each batch."""

    def prints() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").to_numpy().view(np.uint64)
            names, offsets = batch.column("prefix"), np.asarray(batch.column("prefix").cast(pa.large_binary()).buffers()[1])
            offsets = np.frombuffer(offsets, dtype=np.int64)[: len(names) + 1]
            data = np.frombuffer(b"".join(names.to_pylist()), dtype=np.uint8)
            offsets = offsets - offsets[0]
            words = Run(0, data, offsets, offsets[:-1], offsets[1:] - 1, np.arange(len(names) + 1))
            key = mixed((words.hashes() ^ _OPEN) + lang)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["fp"])

    return _filter_words(FILTER_BITS)(prints())


def kept_terms(texts: DataFrame, groups: DataFrame, scratch: Scratch, least: int = LEAST, first_width: int = FIRST_WIDTH) -> DataFrame:
    """(g, term, n) of the terms that at least ``least`` rows of ``texts`` (lang, source, text) have in their language.
    Languages and sources are given by 64-bit hashes; ``groups`` (lang, g) has those of each source's language."""
    spark, width, before, shared, done = texts.sparkSession, first_width, 0, None, []
    while True:
        rows = texts.mapInArrow(_level(width, before, shared), _LEVEL).groupBy("place", "prefix").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
        rows = scratch.written(rows, f"prefixes-{width}")
        ends = F.substring("prefix", -1, 1) == F.lit(b"\0")
        whole = rows.where(~ends).join(groups.select("lang", F.col("g").alias("place")), "place")
        kept = scratch.written(whole.groupBy("lang", "prefix").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least), f"kept-{width}")
        counts = whole.join(kept.select("lang", "prefix"), ["lang", "prefix"], "left_semi")
        done.append(counts.select(F.col("place").alias("g"), F.col("prefix").cast("string").alias("term"), "n"))
        words = rows.where(ends & (F.col("docs") >= least)).select(F.col("place").alias("lang"), "prefix").mapInArrow(_filter_bits, "w long, b long")
        words = words.groupBy("w").agg(F.bit_or("b").alias("b")).collect()  # of a filter of fixed size
        if not words:
            break
        bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
        for r in words:
            bits[r["w"]] = r["b"]
        shared, before, width = spark.sparkContext.broadcast(bits.tobytes()), width, 2 * width
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return scratch.written(out, "terms")


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, other, value): what terms that both sources have add to the sum that counts each as lacked by the other."""

    def value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    for batch in batches:
        entries = batch.column("entries")
        group, p, base = (np.asarray(x) for x in entries.values.flatten())
        offsets = np.asarray(entries.offsets).astype(np.int64)
        sizes = np.repeat(np.diff(offsets), np.diff(offsets))  # of each entry: how many its term has, and where they begin
        starts = np.repeat(offsets[:-1], np.diff(offsets))
        groups, number = np.unique(group, return_inverse=True)
        work, first = np.cumsum(sizes), 0
        while first < len(sizes):
            before = work[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(work, before + PAIRS, "right")))
            a = np.repeat(np.arange(first, last), sizes[first:last]) + offsets[0]
            b, _ = ragged(starts[first:last], sizes[first:last])
            a, b = a[a != b], b[a != b]
            more = value(p[a], p[b]) - value(p[a], base[b]) - value(base[a], p[b]) + value(base[a], base[b])
            pairs, place = np.unique(number[a] * len(groups) + number[b], return_inverse=True)
            sums = np.zeros(len(pairs), dtype=np.int64)
            np.add.at(sums, place, more)
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups[pairs // len(groups)]), pa.array(groups[pairs % len(groups)]), pa.array(sums)], ["g", "other", "value"]
            )
            first = last


def share(n: str, total: str) -> str:
    """SQL of a term's smoothed share in units of one over ``UNIT``."""
    return f"1 + (cast({UNIT} as decimal(38, 0)) * ({n} + 1)) div ({total} + v)"


def _f(p: str, q: str) -> str:
    """SQL of a divergence; shares are at most ``UNIT`` + 1, so a square fits a long."""
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP, first_width: int = FIRST_WIDTH,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for each occurring language and source.

    Part ``pair``: the item is each other source of the language, the value the sum over all kept terms of ``floor((p - q) ** 2 / q)``, with p
    the share of the term in the source and q that in the item. Part ``term``: the item is each kept term that the source has and
    uses more than its language as a whole (share q), the ``top`` of the largest value only. Shares are ``1 + floor(UNIT * (count + 1) /
    (N + V))``, N the source's occurrences of the V kept terms of its language.

    NULL text, language and source are empty strings, which are a language and a source like others. A repeated row is a document of its
    own. Sources without kept terms have the share ``1 + floor(UNIT / V)`` of each; in a language without kept terms all
    pairs have the value 0. Ties are ranked by item, in the order of UTF-8 bytes. An empty table gives no rows. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "audit")
    texts = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    names = texts.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs"))
    names = scratch.written(names.select("*", F.xxhash64("lang", "source").alias("g")), "names")
    hashed = texts.select(F.xxhash64("lang").alias("lang"), F.xxhash64("lang", "source").alias("source"), "text")
    terms = kept_terms(hashed, names.select(F.xxhash64("lang").alias("lang"), "g"), scratch, least, first_width)
    sums = terms.groupBy("g").agg(F.sum("n").alias("own"))
    v = terms.join(names, "g").select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = names.join(sums, "g", "left").join(v, "lang", "left")
    whole = "sum(coalesce(own, 0)) over (partition by lang) as whole"
    groups = groups.selectExpr("g", "lang", "source", "coalesce(own, 0) as own", "coalesce(v, 0) as v", whole)
    base = f"case when v > 0 then {share('0', 'own')} end as base"
    groups = scratch.written(groups.select("*", F.expr(base)), "groups")
    entries = terms.join(groups, "g").selectExpr("lang", "whole", "v", "term", "n", "g", "base", f"{share('n', 'own')} as p")
    entry = F.struct("g", "p", "base")
    by_term = entries.groupBy("lang", "term", "whole", "v").agg(F.sum("n").alias("n"), F.collect_list(entry).alias("entries"))  # an entry a source
    by_term = scratch.written(by_term, "by-term")

    shares = by_term.selectExpr("lang", "term", f"{share('n', 'whole')} as q", "inline(entries)").where("p > q")
    shares = shares.select("g", F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    ranked = W.partitionBy("g").orderBy(F.desc("value"), "item")
    best = shares.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    others = groups.select("lang", F.col("g").alias("other"), F.col("source").alias("item"), F.col("base").alias("other_base"))
    both = groups.join(others, "lang").where("g != other")
    wide = "cast({} as decimal(38, 0)) as value"
    lacked = both.selectExpr("g", "other", wide.format(f"v * cast({_f('base', 'other_base')} as decimal(38, 0))"))
    shapes = by_term.selectExpr("inline(entries)").groupBy("g", "p").agg(F.count(F.lit(1)).alias("terms"))
    shapes = shapes.join(both.select("g", "other", "base", "other_base"), "g")
    as_p = shapes.selectExpr("g", "other", wide.format(f"terms * ({_f('p', 'other_base')} - {_f('base', 'other_base')})"))
    as_q = shapes.selectExpr("other as g", "g as other", wide.format(f"terms * ({_f('other_base', 'p')} - {_f('other_base', 'base')})"))
    common = by_term.select("entries").mapInArrow(_common, "g long, other long, value long").selectExpr("g", "other", wide.format("value"))
    # each is summed on its own before they meet: the first has a row per pair, the others many
    parts = [x.groupBy("g", "other").agg(F.sum("value").alias("value")) for x in (as_p, as_q, common)]
    total = lacked.unionByName(parts[0]).unionByName(parts[1]).unionByName(parts[2]).groupBy("g", "other").agg(F.sum("value").alias("value"))
    total = both.select("g", "other", "item").join(total, ["g", "other"])
    pairs = total.select("g", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")).withColumn("rank", F.row_number().over(ranked))
    out = pairs.withColumn("part", F.lit("pair")).unionByName(best.withColumn("part", F.lit("term")))
    return out.join(groups.select("g", "lang", "source"), "g").select("lang", "source", "part", "item", "value", "rank")
