import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.llm import langid, perplexity, quality

SYLLABLES = {"en": "th er on an re he in ed nd ha".split(), "de": "ch ei un sch ge ie ung ver zu ein".split(), "fr": "le eau ou que ai oi é è ment tre".split(), "es": "ció os de la ar el ñ rr ado ue".split()}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(n=240):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, sentence(rng, lang, rng.randrange(80, 200)), lang, f"src{i % 3}"))
    return rows


SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, host STRING"
ODD = [(900, None, "en", None), (901, "", None, "src0"), (902, "### $$$ 12 34", "en", "src1"), (905, "x", "xx", "src1")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own") for r in rows], SCHEMA)


def identify(spark, rows):
    return langid.identify(frame(spark, rows), F.col("text"), F.col("doc_id"), declared=F.col("lang"), host=F.col("source"))


def test_languages_are_told(spark):
    rows = corpus()
    wrong = [(1000 + i, text, "de" if lang != "de" else "fr", s) for i, text, lang, s in rows[:20]]  # wrongly declared
    bare = [(2000 + i, text, None, None) for i, text, lang, s in rows[:20]]
    truth = {i: lang for i, _, lang, _ in rows} | {1000 + i: lang for i, _, lang, _ in rows[:20]} | {2000 + i: lang for i, _, lang, _ in rows[:20]}
    found = {r.doc_id: r for r in identify(spark, rows + wrong + bare + ODD).collect()}
    assert all(found[i].lang == lang and found[i].kept for i, lang in truth.items())
    assert [found[i].kept for i in (900, 901, 902)] == [False] * 3 and found[900].lang is None
    assert identify(spark, []).count() == 0


def test_posterior_is_the_product_of_its_evidence(spark):
    """Against Bayes' rule on counts made by hand."""
    rows = [r for r in corpus(60)]
    cells = {k: Counter() for k in langid.LANGUAGES}

    def tri(text):
        import pyarrow as pa

        return [int(c) for _, cs, _ in langid.trigrams(pa.array([text])) for c in cs]

    for _, text, lang, _ in rows:
        cells[lang].update(tri(text))
    size = {k: sum(c.values()) + 0.5 * langid.BUCKETS for k, c in cells.items()}
    ll = {i: [sum(np.log((cells[k][c] + 0.5) / size[k]) for c in tri(text)) for k in langid.LANGUAGES] for i, text, _, _ in rows}
    told = {i: int(np.argmax(v)) for i, v in ll.items()}
    over_all = Counter(told.values())
    by_host = Counter((s, told[i]) for i, _, _, s in rows)
    for r in identify(spark, rows).collect():
        _, _, lang, source = rows[r.doc_id]
        base = [(over_all[k] + langid.SMOOTHING / 4) / (len(rows) + langid.SMOOTHING) for k in range(4)]
        n_host = sum(by_host[source, k] for k in range(4))
        prior = [(by_host[source, k] + langid.SMOOTHING * base[k]) / (n_host + langid.SMOOTHING) for k in range(4)]
        claim = [langid.DECLARED_RIGHT if x == lang else (1 - langid.DECLARED_RIGHT) / 3 for x in langid.LANGUAGES]
        logs = np.array(ll[r.doc_id]) * langid.TEXT_WEIGHT + np.log(prior) + np.log(claim)
        best = int(np.argmax(logs))
        assert r.lang == langid.LANGUAGES[best] and r.posterior == pytest.approx(1 / np.exp(logs - logs[best]).sum(), abs=1e-4)


def test_suffix_prior_decides_a_text_without_much(spark):
    rows = corpus(120)
    base = spark.createDataFrame([(i, t, lang, f"h{i}.{lang}", lang) for i, t, lang, _ in rows] + [(999, "zzzz", None, "new.fr", "fr")], "doc_id LONG, text STRING, lang STRING, host STRING, suffix STRING")
    found = langid.identify(base, F.col("text"), F.col("doc_id"), declared=F.col("lang"), host=F.col("host"), suffix=F.col("suffix"))
    last = found.where("doc_id = 999").first()
    assert last.lang == "fr", last


def test_rejected_rows_go_and_columns_stay(spark):
    rows = corpus(40) + ODD[:3] + [ODD[0]]
    kept = langid.keep_identified(frame(spark, rows), F.col("text"), F.col("doc_id"), declared=F.col("lang"), host=F.col("source"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "host"] and kept.count() == 40


def base_rules(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    at = {}
    for k in range(len(w) - 7):
        at.setdefault(tuple(w[k : k + 8]), []).append(k)
    covered = {p for v in at.values() if len(v) > 1 for k in v for p in range(k, k + 8)}
    seen, twice = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            twice += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), twice, len(covered), failed


def test_base_rules_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", "\n\n", "a\n" * 30, "x y " * 30, "é中 " * 25, "Same line\nother\nSame line\n same line", "a\x85b \u2028 c"]
    texts += ["".join(rng.choice(["a ", "b ", "\n", "# ", "é", "line one two\n"]) for _ in range(rng.randrange(90))) for _ in range(120)]
    rows = [(n, t, rng.choice(["en", None]), "s") for n, t in enumerate(texts)]
    for r in quality.judge(frame(spark, rows)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_rules(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    half = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a > 0)
    return np.sqrt(max(0.0, (half(p) + half(q)) / 2))


def test_distances_equal_brute_force(spark):
    rows = corpus(80)
    words, classes = {k: Counter() for k in SYLLABLES}, {k: Counter() for k in SYLLABLES}
    for _, text, lang, _ in rows:
        words[lang].update(text.lower().split())
        classes[lang].update(quality._CLASS[list(text.encode())].tolist())
    for r in quality.judge(frame(spark, rows)).collect():
        _, text, lang, _ = rows[r.doc_id]
        total = sum(words[lang].values())
        common = sorted(w for w, n in words[lang].items() if n >= quality.COMMON * total)
        ref = [words[lang][w] / total for w in common]
        own = Counter(text.lower().split())
        mine = [own[w] / sum(own.values()) for w in common]
        assert r.word_distance == pytest.approx(distance(mine + [1 - sum(mine)], ref + [1 - sum(ref)]), abs=1e-6)
        cells = Counter(quality._CLASS[list(text.encode())].tolist())
        p, q = ([c[k] / sum(c.values()) for k in range(8)] for c in (cells, classes[lang]))
        assert r.class_distance == pytest.approx(distance(p, q), abs=1e-6)


def test_junk_fails_and_clean_text_stays(spark):
    rows = corpus(120)
    junk = [(3000 + n, " ".join(f"{w}###" for w in rows[n][1].upper().split()), rows[n][2], "s") for n in range(10)]
    found = {r.doc_id: r.kept for r in quality.judge(frame(spark, rows + junk)).collect()}
    assert all(found[r[0]] for r in rows) and not any(found[r[0]] for r in junk)


def kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney over bytes in plain dictionaries."""
    counts = Counter()
    for t in texts:
        b = bytes(order - 1) + t.encode()
        counts.update(b[i - order + 1 : i + 1] for i in range(order - 1, len(b)))
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    model = {}
    for n, table in levels.items():
        of = Counter(table.values())
        if all(of[i] for i in (1, 2, 3)):
            y = of[1] / (of[1] + 2 * of[2])
            d = [max(0.05, i + 1 - (i + 2) * y * of[i + 2] / of[i + 1]) for i in range(3)]
        else:
            d = [0.5, 1.0, 1.5]
        context = {}
        for g, c in table.items():
            got = context.setdefault(g[:-1], [0, 0.0])
            got[0] += c
            got[1] += d[min(c, 3) - 1]
        model[n] = (table, d, context)

    def p(gram):
        if not gram:
            return 1 / 256
        table, d, context = model[len(gram)]
        lower = p(gram[1:])
        if gram[:-1] not in context:
            return lower
        total, taken = context[gram[:-1]]
        c = table.get(gram, 0)
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / total + taken / total * lower

    return p


def test_perplexity_equals_a_plain_model(spark, tmp_path):
    rows = [r for r in corpus(60)] + ODD + [(7, *corpus(60)[7][1:])]
    good = [r[0] for r in rows if r[0] % 2 and r[0] < 60]
    frame(spark, rows).repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    trusted = spark.createDataFrame([(i,) for i in good], "doc_id LONG")
    for source in (docs, frame(spark, rows)):  # from files and not
        found = perplexity.score(source, trusted).collect()
        assert len(found) == len(rows)
        by_text = {(r[0], r[1]): r for r in rows}
        models = {k: kneser_ney([r[1] for r in rows if r[0] in good and r[2] == k], perplexity.ORDER) for k in SYLLABLES}
        for r in found:
            if r.lang in models and r.n_bytes > 1:
                text = next(t for (i, t), x in by_text.items() if i == r.doc_id and x[2] == r.lang)
                b = bytes(perplexity.ORDER - 1) + text.encode()
                logs = [np.log(models[r.lang](b[i - perplexity.ORDER + 1 : i + 1])) for i in range(perplexity.ORDER - 1, len(b))]
                assert r.perplexity == pytest.approx(np.exp(-np.mean(logs)), rel=1e-9)
                assert r.kept == (r.n_bytes < perplexity.MIN_BYTES or r.perplexity <= r.threshold)
        kept = {r.doc_id: r.kept for r in found}
        assert not kept[900] and not kept[901] and kept[902] and kept[905]


def test_probabilities_of_all_bytes_add_up_to_one():
    p = kneser_ney(["abracadabra", "abc"], 3)
    for context in (b"\0\0", b"ab", b"zz"):
        assert sum(p(context + bytes([x])) for x in range(256)) == pytest.approx(1)


def test_held_out_junk_is_found(spark):
    rows = corpus(200)
    junk = [(5000 + n, "".join(random.Random(n).choice("#$%xqjzw 0189") for _ in range(600)), "en", "s") for n in range(20)]
    trusted = spark.createDataFrame([(i,) for i, *_ in rows[:120]], "doc_id LONG")
    found = {r.doc_id: r.kept for r in perplexity.score(frame(spark, rows + junk), trusted).collect()}
    assert not any(found[r[0]] for r in junk)
    assert np.mean([found[r[0]] for r in rows[120:]]) > 0.95


def test_no_rows_and_no_trusted_rows(spark):
    none = spark.createDataFrame([], "doc_id LONG")
    assert perplexity.score(frame(spark, []), none).count() == 0
    found = perplexity.score(frame(spark, corpus(5)), none).collect()
    assert all(r.kept and r.threshold is None for r in found)
    assert quality.judge(frame(spark, [])).count() == 0


def test_addresses_of_another_table_are_suffixes(spark):
    """As if the suffix were a column: NULL, missing and repeated addresses, and one that decides a text without much."""
    rows = [(i, t, lang, src, ["fr", "de", "com", None][i % 4] if lang != "fr" else "fr") for i, t, lang, src in corpus(200)]
    rows += [(999, "zzzz", None, None, "fr"), (998, "zzzz", None, None, None), (997, None, "en", None, "fr"), (5, rows[5][1], rows[5][2], rows[5][3], rows[5][4])]
    base = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, host STRING, suffix STRING")
    evidence = {"declared": F.col("lang"), "host": F.col("host")}
    plain = langid.identify(base, F.col("text"), F.col("doc_id"), suffix=F.col("suffix"), **evidence)
    known = base.select("doc_id", F.upper("suffix").alias("suffix")).union(spark.createDataFrame([(999, "xx"), (12345, "de"), (None, "de"), (1, None)], "doc_id LONG, suffix STRING"))
    found = langid.identify(base.drop("suffix"), F.col("text"), F.col("doc_id"), addresses=known, **evidence)
    order = lambda df: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)
    assert order(found) == order(plain)
    told = {r.doc_id: r for r in found.collect()}
    without = {r.doc_id: r for r in langid.identify(base, F.col("text"), F.col("doc_id"), **evidence).collect()}
    assert told[999].lang == "fr" and told[999].posterior > without[999].posterior
