import importlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldtally.llm import audit
from fieldtally.llm.scratch import Scratch

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, term STRING, g LONG"


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute(docs, least=3, top=200):
    counts, where = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in docs:
        lang, source = lang or "", source or ""
        counts[lang, source].update(words_of(text))
        where[lang].update(set(words_of(text)))
    kept = {lang: [t for t, n in found.items() if n >= least] for lang, found in where.items()}
    share = lambda own, terms, t: 1 + 10**9 * (own[t] + 1) // (sum(own[x] for x in terms) + len(terms))
    out = []
    for (lang, source), own in counts.items():
        terms = kept[lang]
        whole = sum((c for (x, _), c in counts.items() if x == lang), Counter())
        p = {t: share(own, terms, t) for t in terms}
        listed = []
        for (x, item), other in counts.items():
            if x == lang and item != source:
                q = {t: share(other, terms, t) for t in terms}
                listed.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in terms), item.encode()))
        out += [(lang, source, "pair", i.decode(), -v, n + 1) for n, (v, i) in enumerate(sorted(listed))]
        listed = []
        for t in terms:
            q = share(whole, terms, t)
            if own[t] and p[t] > q:
                listed.append((-((p[t] - q) ** 2 // q), t.encode()))
        out += [(lang, source, "term", i.decode(), -v, n + 1) for n, (v, i) in enumerate(sorted(listed)[:top])]
    return sorted(out)


def documents():
    rng = random.Random(12)
    stems = ["a", "ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "Über", "übermütig", "中文", "中文字", "x" * 70, "x" * 71, "x" * 300, "é" * 9, "naïve"]
    rare = [f"word{'abcdefghij'[n // 10]}{'abcdefghij'[n % 10]}" for n in range(100)]
    out = []
    for n in range(150):
        words = rng.choices(stems, k=rng.randrange(30)) + rng.choices(rare, k=3)
        source = rng.choice(["s0", "s0", "s0", "s1", "s2", "ß"])
        out.append((n, rng.choice([" ", "-1-", "\n"]).join(words), rng.choice(["en", "en", "de"]), source, "mine", 7))
    out += [(200, None, "en", "s0", None, None), (201, "", None, "s0", None, None), (202, "ABC abc Abc", None, None, None, None)] + [out[3]] * 4
    out += [(300 + n, "no letters 12" if n else "alone", "fr", f"s{n}", None, None) for n in range(3)]
    out.append((400, "123 456", "en", "empty", None, None))
    return out


@pytest.mark.parametrize(("least", "top", "width", "pairs"), [(3, 200, 4, 1 << 21), (2, 5, 1, 7)])
def test_rows_equal_brute_force(spark, monkeypatch, least, top, width, pairs):
    monkeypatch.setattr(audit, "PAIRS", pairs)
    docs = documents()
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    found = audit.source_divergence(frame, least=least, top=top, first_width=width)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == brute(docs, least, top)


def test_rare_prefixes_are_not_extended(spark):
    docs = [("en", "s0", f"zzzz{c}yyyyyyyyyyyy common") for c in "abc"] + [("en", "s1", "qqqqqqqqqqqqqqqq common")] * 2 + [("de", "s0", "common")]
    scratch = Scratch(spark, "t")
    texts = spark.createDataFrame(docs, "lang STRING, source STRING, text STRING")
    hashed = texts.select(F.xxhash64("lang").alias("lang"), F.xxhash64("lang", "source").alias("source"), "text")
    groups = texts.select(F.xxhash64("lang").alias("lang"), F.xxhash64("lang", "source").alias("g"), F.concat_ws("/", "lang", "source").alias("name")).distinct()
    found = audit.kept_terms(hashed, groups, scratch, first_width=4).join(groups, "g")
    assert {(r.name, r.term): r.n for r in found.collect()} == {("en/s0", "common"): 3, ("en/s1", "common"): 2}
    levels = []
    for n, width in ((1, 4), (3, 8)):
        levels.append({bytes(r.prefix): r.docs for r in spark.read.parquet(f"{scratch.path}/{n:03d}-prefixes-{width}").orderBy("docs").collect()})
    assert levels[0] == {b"zzzz\0": 3, b"qqqq\0": 2, b"comm\0": 5}
    assert levels[1] == {b"common": 3, **{f"zzzz{c}yyy\0".encode(): 1 for c in "abc"}}  # qqqq is too rare


def test_empty_table(spark):
    assert audit.source_divergence(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_very_long_text(spark):
    long = " ".join("ab" * (n % 40 + 1) for n in range(60_000))
    docs = [(n, long if n < 3 else "ab abab", "en", f"s{n % 2}", None, None) for n in range(5)]
    frame = spark.createDataFrame(docs, SCHEMA)
    assert sorted(tuple(r) for r in audit.source_divergence(frame).collect()) == brute(docs)


def test_partial_counts_held_at_once_are_bounded(monkeypatch):
    """A batch of many runs is counted in parts of bounded size, and the parts add up to the same counts."""
    words = importlib.import_module("fieldtally.llm.words")
    texts = [" ".join(f"w{chr(97 + (7 * n + k) % 26)}{chr(97 + k % 26)}" for k in range(40)) for n in range(200)]
    ids = pa.array(np.ones(len(texts), dtype=np.int64))
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], ["lang", "source", "text"])
    sizes, summed = [], audit._summed
    monkeypatch.setattr(audit, "_summed", lambda found: sizes.append(sum(len(f[0]) for f in found)) or summed(found))
    monkeypatch.setattr(words, "RUN_BYTES", 1_000)

    def counts(held):
        monkeypatch.setattr(audit, "HELD", held, raising=False)
        total = Counter()
        for part in audit._level(6, 0, None)(iter([batch])):
            for row in part.to_pylist():
                total[(row["place"], row["prefix"])] += row["n"]
        return total

    whole = counts(1 << 30)
    sizes.clear()
    assert counts(500) == whole and max(sizes) < 1_000 and len(sizes) > 1
