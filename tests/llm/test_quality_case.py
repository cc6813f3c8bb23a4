"""Distances of mixed-case texts against brute force."""

import random
from collections import Counter

import pytest

from fieldtally.llm import quality
from test_languages_and_quality import corpus, distance, frame


def test_distances_of_mixed_case_texts(spark):
    rng = random.Random(4)
    case = [str, str.title, str.upper]
    rows = [(i, " ".join(rng.choice(case)(w) for w in text.split()), lang, s) for i, text, lang, s in corpus(60)]
    classes, words = {}, {}
    for _, text, lang, _ in rows:
        classes.setdefault(lang, Counter()).update(quality._CLASS[list(text.encode())].tolist())
        words.setdefault(lang, Counter()).update(lower(text).split())
    assert all(c[2] > 0 for c in classes.values())
    for r in quality.judge(frame(spark, rows)).collect():
        _, text, lang, _ = rows[r.doc_id]
        cells = Counter(quality._CLASS[list(text.encode())].tolist())
        p, q = ([c[k] / sum(c.values()) for k in range(quality.CLASSES)] for c in (cells, classes[lang]))
        assert r.class_distance == pytest.approx(distance(p, q), abs=1e-6)
        total = sum(words[lang].values())
        common = [w for w, n in words[lang].items() if n >= quality.COMMON * total]
        own = Counter(lower(text).split())
        mine, ref = ([c[w] / sum(c.values()) for w in common] for c in (own, words[lang]))
        assert r.word_distance == pytest.approx(distance(mine + [1 - sum(mine)], ref + [1 - sum(ref)]), abs=1e-6)


def lower(text):
    """A-Z only, as the operator does."""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
