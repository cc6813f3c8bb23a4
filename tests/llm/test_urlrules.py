import itertools
import random
import re

from pyspark.sql import functions as F

from fieldtally.llm import urlrules
from fieldtally.llm.scratch import Scratch


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]+", lambda m: m[0].lower(), host), path


def fixed(host, path):
    fit = [(h + p, v) for h, p, v in urlrules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[0]), default=(None, None))


URLS = [
    None, "", "no scheme", "http://", "http://net/", "http://NET/x", "http://a.Example.NET/en/1", "http://example.net/en", "http://xexample.net/en/1",
    "http://fr.org/fr/", "http://org/fr/?q", "https://b.example.com/de/4#x", "http://example.com?u=http://net/", "a://b://net/c", "http://É.net/ü", "http://h\nx/p\nq#r",
    "http://example.net?x", "http://example.net", "HTTP://a.net/#://org/fr/",
]


def no_labels(spark):
    return spark.createDataFrame([], "url STRING, bad BOOLEAN")


def test_parts_and_fixed_rules(spark):
    pages = spark.createDataFrame([(n, u, "own") for n, u in enumerate(URLS)] + [(0, None, "own")], "page_id LONG, url STRING, host STRING")
    found = urlrules.judge(pages, no_labels(spark)).collect()
    assert len(found) == len(URLS) + 1
    for r in found:
        host, path = parts(URLS[r.page_id])
        rule, verdict = fixed(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")


def labelled(n=400):
    rng = random.Random(8)
    rows = []
    for k in range(n):
        host, part, query = rng.choice(["good", "spam", "mixed"]), rng.choice(["news", "casino", "x"]), rng.choice(["", "?ref=feed", "?p=1"])
        bad = host == "spam" and part == "casino" or (part == "casino" and query == "?ref=feed") or rng.random() < 0.1
        rows.append((f"http://{host}.example.org/{part}/{k}{query}", bad))
    return rows


def test_mined_rules_equal_counting_all_combinations(spark):
    rows = labelled()
    frame = spark.createDataFrame(rows, "url STRING, bad BOOLEAN")
    tokens = [set(r.t) for r in frame.select(urlrules.tokens_of(F.col("url")).alias("t")).collect()]
    counts, with_bad = {}, {}
    for own, (_, bad) in zip(tokens, rows):
        frequent = sorted(t for t in own if not re.fullmatch(r"p:\d+", t))
        for size in range(1, len(frequent) + 1):
            for c in itertools.combinations(frequent, size):
                counts[c] = counts.get(c, 0) + 1
                with_bad[c] = with_bad.get(c, 0) + bad
    least = max(urlrules.MIN_SUPPORT * len(rows), urlrules.LEAST_URLS)
    expected = {c: n / counts[c] for c, n in with_bad.items() if n >= least and n / counts[c] >= urlrules.MIN_CONFIDENCE}
    known = frame.select(urlrules.tokens_of(F.col("url")).alias("tokens"), "bad")
    found = {tuple(r.tokens): r.confidence for r in urlrules.mined_rules(known, Scratch(spark, "t")).collect()}
    assert found.keys() == expected.keys() and all(abs(found[k] - v) < 1e-9 for k, v in expected.items())
    assert expected
    # every page is blocked exactly if all tokens of some rule are its own
    pages = spark.createDataFrame([(n, u) for n, (u, _) in enumerate(rows)], "page_id LONG, url STRING")
    for r in urlrules.judge(pages, frame).collect():
        hit = [v for k, v in expected.items() if set(k) <= tokens[r.page_id]]
        rule, verdict = fixed(r.host, r.path)
        assert r.verdict == (verdict or ("block" if hit else "allow"))
        assert (r.confidence is None) == (not hit) and (not hit or abs(r.confidence - max(hit)) < 1e-9)


def test_empty_pages(spark):
    assert urlrules.judge(spark.createDataFrame([], "page_id LONG, url STRING"), no_labels(spark)).count() == 0
