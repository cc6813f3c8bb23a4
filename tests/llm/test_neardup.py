"""The chosen-path join against all pairs of shingle sets."""

import random
import re

import pytest

from fieldtally.llm import neardup

SCHEMA = "doc_id LONG, text STRING, kept STRING, rid INT"


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, threshold=85):
    """(doc_id, size, component) by comparing everything with everything; ids must differ."""
    sets = {i: shingles(t) for i, t in docs}
    label = {i: i for i in sets}

    def top(v):
        while label[v] != v:
            v = label[v]
        return v

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {i: (len(s), top(i)) for i, s in sets.items()}


def run(spark, docs):
    frame = spark.createDataFrame([(i, t, "own", 1) for i, t in docs], SCHEMA)
    return neardup.near_duplicates(frame).select("doc.*", "n_shingles", "component_id", neardup.F.col("kept").alias("stays"), "keeper")


def corpus(seed=1):
    """Families of copies, chains of near copies whose ends are unlike, shared passages and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(4000)]

    def fresh(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    docs = [" ".join(fresh(rng.randrange(1, 120))) for _ in range(60)]
    passage = fresh(40)
    docs += [" ".join(fresh(15) + passage + fresh(10)) for _ in range(40)]
    for _ in range(6):
        base = fresh(rng.randrange(60, 300))
        for _ in range(8):
            copy = base[:]
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(" ".join(copy))
    chain = fresh(200)
    for _ in range(10):
        chain = chain[4:] + fresh(4)
        docs.append(" ".join(chain))
    docs += ["Same Text here now", "same text HERE now", "", None, "   \n", "one", "One", "a b c d", "a b c", docs[0], docs[0].upper()]
    rng.shuffle(docs)
    return [(3 * n + 5, t) for n, t in enumerate(docs)]


@pytest.mark.parametrize("small", [neardup.SMALL_NODE, 4])
def test_equals_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL_NODE", small)
    docs = corpus()
    found = run(spark, docs).collect()
    expected = brute(docs)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["stays"] == (r["doc_id"] == r["component_id"]) == r["keeper"] for r in found)
    assert {r["kept"] for r in found} == {"own"}


def test_deep_nodes_are_compared_exhaustively(spark, monkeypatch):
    """Where branching is stopped early, the all-pairs fallback gives the same answer."""
    monkeypatch.setattr(neardup, "SMALL_NODE", 2)
    monkeypatch.setattr(neardup, "MAX_DEPTH", 1)
    docs = corpus(2)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, docs).collect()} == brute(docs)


def test_repeated_rows_null_ids_and_long_texts(spark):
    long = " ".join(f"v{n}" for n in range(60_000))
    docs = [(1, "x y z a b c d e"), (1, "x y z a b c d e"), (None, "x y z a b c d e"), (None, None), (9, long), (8, long + " end"), (1, "else")]
    rows = run(spark, docs).collect()
    assert sorted(str(r["component_id"]) for r in rows) == ["1", "1", "1", "1", "8", "8", "None"]
    assert sum(r["keeper"] for r in rows) == 4
    kept = neardup.drop_near_duplicates(spark.createDataFrame([(i, t, "own", 1) for i, t in docs], SCHEMA))
    assert kept.columns == ["doc_id", "text", "kept", "rid"] and kept.count() == 4


def test_empty_table(spark):
    assert run(spark, []).count() == 0
    assert neardup.drop_near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
