"""Winnowing against a search for every window at every place."""

import hashlib
import random
import re

import pytest

from fieldtally.llm import decontam

DOCS, ITEMS = "doc_id LONG, text STRING, fp STRING", "item_id LONG, text STRING"


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words_of(text), set(), set()
        for item_id, item in items:
            v = words_of(item)
            n = min(10, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            at = [i for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows] if n else []
            hit |= {p for i in at for p in range(i, i + n)}
            if at and item_id is not None:
                ids.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    frame = spark.createDataFrame([(i, t, "own") for i, t in docs], DOCS)
    found = decontam.contamination(frame, spark.createDataFrame(items, ITEMS), **options).drop("th")
    return sorted((tuple(r) for r in found.collect()), key=str)


def corpus(seed, vocabulary):
    rng = random.Random(seed)
    some = [f"W{n}" for n in range(vocabulary)]

    def fresh(n):
        return [rng.choice(some) for _ in range(n)]

    items = [(n, " ".join(fresh(rng.choice([1, 2, 3, 5, 7, 9, 10, 11, 30, 60])))) for n in range(30)] + [(31, ""), (32, None), (2, "w1 - w2")]
    docs = []
    for n in range(60):
        words = fresh(rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            item = rng.choice(items)[1] or ""
            part = item.split()
            at, size = rng.randrange(len(part) + 1), rng.randrange(5, 40)
            words[rng.randrange(len(words) + 1) : 0] = part[at : at + size]
        docs.append((n, rng.choice([" ", ", ", "\n"]).join(words)))
    return docs + [(60, None), (61, ""), (3, docs[3][1]), (None, docs[5][1])], items


@pytest.mark.parametrize(("seed", "vocabulary"), [(1, 5000), (2, 40), (3, 2)])
def test_equals_brute_force(spark, seed, vocabulary):
    docs, items = corpus(seed, vocabulary)
    assert run(spark, docs, items) == brute(docs, items)


def test_filter_that_is_full_loses_nothing(spark):
    docs, items = corpus(4, 400)
    assert run(spark, docs, items, filter_bits=7) == brute(docs, items)


def test_item_without_id_marks_words_but_is_not_listed(spark):
    passage = " ".join(f"p{n}" for n in range(12))
    assert run(spark, [(1, passage)], [(None, passage)]) == brute([(1, passage)], [(None, passage)])


def test_empty_tables_and_dropping(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b c")], []) == brute([(1, "a b c")], [])
    docs, items = corpus(1, 5000)
    frame = spark.createDataFrame([(i, t, "own") for i, t in docs], DOCS)
    kept = decontam.drop_contaminated(frame, spark.createDataFrame(items, ITEMS))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in brute(docs, items) if not r[5])


def test_long_text_with_passage_at_its_end(spark):
    passage = " ".join(f"p{n}" for n in range(20))
    docs = [(1, " ".join(f"x{n}" for n in range(80_000)) + " " + passage)]
    assert run(spark, docs, [(7, passage)]) == brute(docs, [(7, passage)])
