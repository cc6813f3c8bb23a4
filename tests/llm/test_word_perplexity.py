"""The word model of op9 against a plain one, and on shuffled words."""

import random
from collections import Counter

import numpy as np
import pytest

from fieldtally.llm import perplexity
from test_languages_and_quality import ODD, frame


def prose(rng, n):
    """Sentences of a small grammar: what may follow a word depends on it."""
    out, at = [], rng.randrange(300)
    for _ in range(n):
        at = (at * 7 + rng.choice((1, 5, 11))) % 300
        out.append(f"word{at}")
    return " ".join(out)


def texts(n):
    rng = random.Random(9)
    return [(i, prose(rng, 120), "en" if i % 3 else "de", "s") for i in range(n)]


def plain(trained, order=3):
    counts = Counter()
    for t in trained:
        w = ["", "", *t.split()]
        counts.update(tuple(w[i - 2 : i + 1]) for i in range(2, len(w)))
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    discounts, contexts = {}, {}
    for n, t in levels.items():
        of = Counter(t.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0
        full = all(of[i] for i in (1, 2, 3))
        discounts[n] = [max(0.05, i + 1 - (i + 2) * y * of[i + 2] / of[i + 1]) for i in range(3)] if full else [0.5, 1.0, 1.5]
        for g, c in t.items():
            got = contexts.setdefault((n, g[:-1]), [0, 0.0])
            got[0] += c
            got[1] += discounts[n][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / (len(levels[1]) + 1)
        lower, n = p(g[1:]), len(g)
        if (n, g[:-1]) not in contexts:
            return lower
        total, taken = contexts[n, g[:-1]]
        c = levels[n][g]
        return (max(c - discounts[n][min(c, 3) - 1], 0) if c else 0) / total + taken / total * lower

    return p


def test_equals_a_plain_model(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(perplexity, "HELD_OUT", 10**9)  # nothing is held out
    rows = texts(40) + ODD
    frame(spark, rows).repartition(3).write.parquet(str(tmp_path / "docs"))
    good = [i for i, *_ in rows[:40] if i % 2]
    trusted = spark.createDataFrame([(i,) for i in good], "doc_id LONG")
    models = {k: plain([t for i, t, lang, _ in rows[:40] if i in good and lang == k]) for k in ("en", "de")}
    found = {r.doc_id: r for r in perplexity.score_words(spark.read.parquet(str(tmp_path / "docs")), trusted).collect()}
    assert len(found) == len(rows)
    for i, text, lang, _ in rows[:40]:
        w = ["", "", *text.split()]
        logs = [np.log(models[lang](tuple(w[k - 2 : k + 1]))) for k in range(2, len(w))]
        assert found[i].perplexity == pytest.approx(np.exp(-np.mean(logs)), rel=1e-9)
    assert [found[i].kept for i in (900, 901, 902, 905)] == [False, False, True, True]


def test_shuffled_words_exceed_the_threshold(spark):
    rows = texts(500)
    shuffled = []
    for n in range(30):
        words = rows[n][1].split()
        random.Random(n).shuffle(words)
        shuffled.append((5000 + n, " ".join(words), rows[n][2], "s"))
    trusted = spark.createDataFrame([(i,) for i, *_ in rows[:400]], "doc_id LONG")
    found = {r.doc_id: r.kept for r in perplexity.score_words(frame(spark, rows + shuffled), trusted).collect()}
    assert not any(found[r[0]] for r in shuffled)
    assert np.mean([found[r[0]] for r in rows[400:]]) > 0.9


def test_no_rows_and_no_trusted_rows(spark):
    none = spark.createDataFrame([], "doc_id LONG")
    assert perplexity.score_words(frame(spark, []), none).count() == 0
    found = perplexity.score_words(frame(spark, texts(5)), none).collect()
    assert len(found) == 5 and all(r.kept and r.threshold is None for r in found)
