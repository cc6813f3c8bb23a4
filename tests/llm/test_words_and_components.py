import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldtally.llm import membership, words
from fieldtally.llm.components import components
from fieldtally.llm.scratch import Scratch

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAzZ09 \t\n\x0b\x85é中-.", max_size=30)), max_size=12)


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


@settings(max_examples=150, deadline=None)
@given(TEXTS)
@pytest.mark.parametrize(("table", "pattern"), [(words.SPACED, "[^\x20\x09-\x0d]+"), (words.ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")])
def test_words_equal_a_regular_expression(table, pattern, texts):
    seen = {}
    for run in words.runs(pa.array(texts, pa.string()), table):
        hashes = run.hashes()
        for i in range(run.n_texts):
            expected = re.findall(pattern, lowered(texts[run.first + i]))
            own = hashes[run.words[i] : run.words[i + 1]]
            assert len(own) == len(expected)
            for word, h in zip(expected, own):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_words_over_many_runs_and_long_words(monkeypatch):
    monkeypatch.setattr(words, "RUN_BYTES", 50)
    texts = ["x" * 9000, "x" * 9001, "", None, "one two " * 30, "x" * 9000]
    found = {}
    for run in words.runs(pa.array(texts, pa.string()), words.SPACED):
        for i in range(run.n_texts):
            found[run.first + i] = run.hashes()[run.words[i] : run.words[i + 1]]
    assert sorted(found) == list(range(6)) and len(found[4]) == 60 and len(found[2]) == len(found[3]) == 0
    assert found[0][0] == found[5][0] != found[1][0]
    assert len(np.unique(found[4])) == 2


def test_sliced_column_with_nulls():
    column = pa.array(["a b", None, "c", "d e f"], pa.string())[1:]
    assert [list(r.counts()) for r in words.runs(column, words.SPACED)] == [[0, 1, 3]]


@pytest.mark.parametrize("links", [[], [(2, 1)], [(n + 1, n) for n in range(40)], [(n, 0) for n in range(1, 60)]])
def test_components_of_known_graphs(spark, links):
    found = components(spark.createDataFrame(links, "child LONG, parent LONG"), Scratch(spark, "t"))
    least = min((b for _, b in links), default=0)
    assert {tuple(r) for r in found.collect()} == {(v, least) for link in links for v in link if v != least}


def test_components_of_a_random_graph(spark):
    rng = random.Random(3)
    links = [tuple(sorted((rng.randrange(200), rng.randrange(200)), reverse=True)) for _ in range(130)]
    links = [x for x in links if x[0] != x[1]]
    root = list(range(200))

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    found = components(spark.createDataFrame(links, "child LONG, parent LONG"), Scratch(spark, "t"))
    assert {tuple(r) for r in found.collect()} == {(v, top(v)) for v in range(200) if top(v) != v}


def test_filter_never_loses_and_without_is_exact(spark):
    from pyspark.sql import functions as F

    scratch = Scratch(spark, "t")
    ids = spark.createDataFrame([(n,) for n in range(0, 300, 3)] + [(None,)], "k LONG")
    rows = spark.createDataFrame([(n, str(n)) for n in range(300)] + [(None, "none"), (7, "again")], "id LONG, membership_p STRING")
    kept = membership.without(rows, ids, F.col("id"), scratch)
    assert kept.columns == rows.columns
    assert sorted(r["id"] for r in kept.collect()) == sorted([n for n in range(300) if n % 3] + [7])
    found = membership.marked(rows, ids, "k", F.col("id"), scratch).where(membership.SUSPECT)
    assert {n for n in range(0, 300, 3)} <= {r["id"] for r in found.collect()}
    none = spark.createDataFrame([], "k LONG")
    assert membership.without(rows, none, F.col("id"), scratch).count() == 302
