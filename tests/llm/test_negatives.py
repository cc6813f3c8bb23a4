import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldtally.llm import negatives


def brute(rows, is_anchor, n_positives=5, n_negatives=5, percent=80):
    """``rows``: (id, label, whole numbers)."""
    usable = [r for r in rows if None not in r[:3] and None not in r[2]]
    out = []
    for n, (anchor, label, v) in enumerate(usable):
        if not is_anchor(anchor):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=False)), i, own) for m, (i, own, w) in enumerate(usable) if m != n]
        scored.sort(key=lambda s: s[:2])
        for score, positive, _ in [s for s in scored if s[2] == label][:n_positives]:
            hard = [s for s in scored if s[2] != label and percent * -score <= 100 * -s[0] <= 100 * -score]
            out += [(anchor, positive, k + 1, i, -score, -s) for k, (s, i, _) in enumerate(hard[:n_negatives])]
    return sorted(out)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "mine") for r in rows], "vec_id LONG, label INT, vector ARRAY<LONG>, score STRING").repartition(parts)


def found(frame, n=10, **how):
    got = negatives.hard_negatives(frame, "vec_id", "label", "vector", F.col("vec_id") % n == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 70), st.integers(1, 40), st.integers(1, 9), st.integers(0, 5), st.data())
def test_matches_equal_the_full_product(width, n, k, kind, data):
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    rows, anchors = (rng.integers(-9, 10, (m, width)).astype(float) * (rng.random((m, width)) < [0.1, 1][kind % 2]) for m in (n, k))
    least = np.array(rng.choice([-np.inf, -50.0, 0.0, 1.0, 200.0, 2000.0], k))
    i, a, score = negatives.matches(rows, anchors, least)
    full = rows @ anchors.T
    assert sorted(zip(i.tolist(), a.tolist(), score.tolist(), strict=True)) == sorted((x, y, full[x, y]) for x, y in zip(*np.nonzero(full >= least), strict=True))


def test_index_leaves_out_what_norms_cover():
    """Rows whose norm cannot reach any threshold are not multiplied at all, and a row is filed only under its first dimensions."""
    rows = np.zeros((3, 64))
    rows[0, :] = 1  # norm 8
    rows[1, 0], rows[1, 40] = 100, 1
    rows[2, 63] = 1000
    anchors = np.ones((1, 64))
    norms = negatives.remaining_norms(rows, [0, 16, 32, 48, 64])
    assert norms[0, 0] * 8 >= 64 and norms[1, 1] * 8 < 90 and norms[2, 3] * 8 > 90
    i, _a, score = negatives.matches(rows, anchors, np.array([90.0]))
    assert sorted(zip(i.tolist(), score.tolist(), strict=True)) == [(1, 101.0), (2, 1000.0)]


@pytest.mark.parametrize(("block", "part", "rows_held"), [(512, 4096, 1 << 16), (3, 7, 20)])
def test_table_equals_brute_force(spark, monkeypatch, block, part, rows_held):
    for name, value in (("BLOCK", block), ("PART", part), ("ROWS", rows_held)):
        monkeypatch.setattr(negatives, name, value)
    rng = random.Random(8)
    rows = [(n, rng.randrange(4), [rng.randrange(-6, 7) for _ in range(20)]) for n in range(160)]
    rows += [(200 + n, n % 4, [3] * 20) for n in range(50)]  # a common vector in all labels
    rows += [(300, 1, rows[10][2]), (310, 2, []), (320, 1, [1, 2]), (330, 3, [0] * 20), (340, 0, [-5] * 20)]
    rows += [(350, None, [1]), (None, 1, [1]), (360, 1, None), (370, 1, [1, None])]
    rows += [rows[20], rows[20], rows[33], (40, 2, [9] * 20)]  # repeated rows and an id with two vectors
    assert found(table(spark, rows)) == brute(rows, lambda i: i % 10 == 0)


def test_few_rows_and_other_parameters(spark):
    rows = [(0, 1, [10, 0]), (1, 1, [9, 1]), (2, 2, [8, 0]), (3, 2, [9, -3]), (4, 2, [2, 0])]
    assert found(table(spark, rows)) == brute(rows, lambda i: i == 0) == [(0, 1, 1, 3, 90, 90), (0, 1, 2, 2, 90, 80)]
    more = dict(positives=1, negatives=1, percent=20)
    assert found(table(spark, rows), **more) == brute(rows, lambda i: i == 0, 1, 1, 20)


def test_empty_tables(spark):
    assert found(table(spark, [], 1)) == []
    assert found(table(spark, [(1, 1, [2])])) == [] and found(table(spark, [(0, 1, [])])) == []
    assert found(table(spark, [(0, 1, []), (1, 1, []), (2, 2, [])])) == [(0, 1, 1, 2, 0, 0)]


def test_large_numbers_are_an_error(spark):
    with pytest.raises(ValueError, match="not exact"):
        found(table(spark, [(0, 1, [1 << 30]), (1, 1, [1])]))


def test_whole_numbers(spark):
    frame = spark.createDataFrame(
        [([0.5, -0.001],), ([1.0, float("nan")],), ([float("inf")],), ([1.0, None],), (None,), ([],)], "v ARRAY<FLOAT>")
    assert [r[0] for r in frame.select(negatives.whole_numbers(F.col("v"), 256)).collect()] == [[128, -1], None, None, None, None, []]
