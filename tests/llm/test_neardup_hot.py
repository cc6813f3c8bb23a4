"""Groups of more texts than a node that is compared on signatures, with most pairs just below the threshold."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.llm import neardup
from test_neardup import SCHEMA, brute

SLOTS = 200


def slotted(row):
    """1,000 words; each changed slot changes five shingles of its own."""
    return " ".join(f"b{s} c{s} s{s}v{v} d{s} e{s}" for s, v in enumerate(row))


def hot_group(families=550, seed=3):
    """Pairs at 0.86 among texts that are about 0.8 alike. Returns the slots of each text."""
    rng = random.Random(seed)
    rows, fresh = [], iter(range(1, 10**6))
    for _ in range(families):
        one = np.zeros(SLOTS, dtype=np.int64)
        changed = rng.sample(range(1, SLOTS - 1), 18)
        for s in changed[:10]:
            one[s] = next(fresh)
        two = one.copy()
        two[changed[:7]] = 0
        for s in changed[10:]:
            two[s] = next(fresh)
        rows += [one, two]
    return np.array(rows)


def roots(linked):
    root = np.arange(len(linked))
    for i in range(len(linked)):
        if root[i] == i:
            stack = [i]
            while stack:
                for j in np.flatnonzero(linked[stack.pop()]):
                    if root[j] > i:
                        root[j] = i
                        stack.append(j)
    return root


def hot_expected(rows, threshold):
    size = 5 * SLOTS - 4
    apart = np.array([(rows != r).sum(axis=1) for r in rows])
    return roots(100 * (size - 5 * apart) >= threshold * (size + 5 * apart))


def frame(spark, texts):
    return spark.createDataFrame([(n, t, "own", 1) for n, t in enumerate(texts)], SCHEMA)


def test_links_of_a_hot_group_are_found(spark):
    rows = hot_group()
    texts = [slotted(r) for r in rows]
    few = brute(list(enumerate(texts[:40])))
    expected = hot_expected(rows, 85)
    assert [few[i][1] for i in range(40)] == hot_expected(rows[:40], 85).tolist()
    assert len(set(expected.tolist())) > 100
    found = neardup.near_duplicates(frame(spark, texts)).select(F.col("doc.doc_id").alias("doc_id"), "component_id").collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(expected.tolist()))


def test_pairs_below_the_threshold_do_not_become_rows(spark, monkeypatch):
    """The rows that candidates make grow with the group and not with its square."""
    made = []
    confirm = neardup.Forest.merge

    def counted(self, pairs, links=None):
        made.append(pairs.count() + (links.count() if links is not None else 0))
        confirm(self, pairs, links)

    monkeypatch.setattr(neardup.Forest, "merge", counted)
    rows = hot_group(200)
    neardup.near_duplicates(frame(spark, [slotted(r) for r in rows])).count()
    assert sum(made) < 400 * 40 < 400 * 399 / 2


@pytest.mark.parametrize("threshold", [80, 85, 90])
def test_trees_follow_recall(threshold):
    n = neardup.trees_for(threshold)
    assert neardup.missed(threshold, n) <= neardup.MISS < neardup.missed(threshold, n - 1)
    below = sum(neardup._binomial(threshold)[: neardup.least_equal(threshold)])
    assert below < 1e-6


def test_shared_elements_and_forest(monkeypatch):
    monkeypatch.setattr(neardup, "WIDTH", 7)
    rng = random.Random(1)
    sets = [np.array(sorted(rng.sample(range(60), rng.randrange(1, 40))), dtype=np.uint64) for _ in range(25)]
    expected = [[len(np.intersect1d(a, b)) for b in sets[10:]] for a in sets[:10]]
    assert neardup.in_common(sets[:10], sets[10:]).tolist() == expected
    linked = np.array([[rng.random() < 0.03 for _ in range(40)] for _ in range(40)])
    linked |= linked.T
    edges = list(neardup.spanning(linked))
    tree = np.zeros_like(linked)
    for a, b in edges:
        assert linked[a, b]
        tree[a, b] = tree[b, a] = True
    assert roots(tree).tolist() == roots(linked).tolist() and len(edges) == 40 - len(set(roots(linked).tolist()))
