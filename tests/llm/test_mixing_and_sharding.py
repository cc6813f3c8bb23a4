import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fieldtally.llm import sharding
from fieldtally.llm.mixing import Mixture, leaf_budgets

WEIGHTS = {("a",): 3, ("b",): 1, ("a", "x"): 2, ("b", "z"): 0}


def water_fill(budget, children):
    """Shares of (capacity, weight) children by weight, none above its capacity."""
    budget = min(budget, sum(c for c, w in children if w > 0))
    got, open_ = [0.0] * len(children), [i for i, (c, w) in enumerate(children) if w > 0 and c > 0]
    left = budget
    while open_ and left > 1e-9:
        per = left / sum(children[i][1] for i in open_)
        full = [i for i in open_ if got[i] + per * children[i][1] >= children[i][0]]
        if not full:
            for i in open_:
                got[i] += per * children[i][1]
            break
        for i in full:
            left -= children[i][0] - got[i]
            got[i] = children[i][0]
            open_.remove(i)
    return got


def test_budgets_equal_water_filling(spark):
    rng = random.Random(4)
    for budget in (0, 50, 700, 2500, 10**9):
        leaves = [(d, x, rng.randrange(1, 500)) for d in "abc" for x in "xyz" if rng.random() < 0.8]
        frame = spark.createDataFrame(leaves, "d STRING, x STRING, tokens LONG")
        found = {(r.d, r.x): r.alloc for r in leaf_budgets(frame, ["d", "x"], WEIGHTS, F.lit(budget), 2).collect()}
        domains = sorted({d for d, *_ in leaves})
        caps = [sum(2 * t for d, _, t in leaves if d == name) for name in domains]
        shares = water_fill(budget, [(c, WEIGHTS.get((d,), 1)) for c, d in zip(caps, domains)])
        for domain, share in zip(domains, shares):
            own = [(x, 2 * t) for d, x, t in leaves if d == domain]
            got = water_fill(share, [(c, WEIGHTS.get((domain, x), 1)) for x, c in own])
            for (x, _), value in zip(own, got):
                assert abs(found.get((domain, x), 0) - value) <= len(leaves)
        assert sum(found.values()) <= budget


def documents(spark):
    rng = random.Random(9)
    rows = []
    for n in range(400):
        source = "big" if n % 3 == 0 else f"s{rng.randrange(5)}"
        rows.append((n, " ".join(["w"] * rng.randrange(0, 40)), rng.choice(["en", "de", None]), source, 0))
    rows += [(500, None, "en", None, 0), (501, "", None, None, 0), (7, rows[7][1], rows[7][2], rows[7][3], 0)]
    return rows, spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, rem INT")


def test_leaves_get_their_budgets_and_epochs_are_whole(spark):
    rows, frame = documents(spark)
    levels = {"source": F.col("source"), "lang": F.col("lang")}
    weights = {("big",): 1, ("s0",): 9, ("s1",): 4}
    mix = Mixture(frame, levels, weights, F.lit(5000), max_epochs=3)
    found = mix.assign(frame).collect()
    assert len(found) == len(rows)
    got, budget, tokens = Counter(), {}, Counter()
    copies = defaultdict(set)
    for r in found:
        leaf = (r.mix_source, r.mix_lang)
        budget[leaf] = r.leaf_budget
        got[leaf] += r.copies * r.n_tokens - ((r.n_tokens - r.partial_tokens) if r.partial_tokens else 0)
        tokens[leaf] += r.n_tokens
        copies[leaf].add(r.copies)
        assert r.n_tokens == len((r.doc.text or "").split())
    for leaf, value in budget.items():
        slack = 40 if leaf == (rows[7][3], rows[7][2] or "") else 0  # a repeated row shares what either of the two gets
        assert value <= got[leaf] <= value + slack
        assert value <= 3 * tokens[leaf] and max(copies[leaf]) - min(copies[leaf]) <= 1
    assert 4900 <= sum(budget.values()) <= 5000
    mixed = mix.mixed(frame)
    assert mixed.columns == frame.columns and mixed.count() == sum(r.copies for r in found)


def test_seeds_give_other_prefixes_and_equal_seeds_equal_ones(spark):
    _, frame = documents(spark)

    def chosen(seed):
        found = Mixture(frame, {"source": F.col("source")}, {}, F.lit(1500), 1, seed=seed).assign(frame)
        return {r.doc.doc_id for r in found.where("copies > 0").collect()}

    assert chosen(1) == chosen(1) != chosen(2)


def test_empty_table(spark):
    _, frame = documents(spark)
    none = frame.limit(0)
    assert Mixture(none, {"source": F.col("source")}, {}).assign(none).count() == 0
    assert sharding.shard_rows(none).count() == 0


def test_shards_have_exact_sizes_and_gapless_slots(spark):
    rng = random.Random(2)
    rows = [(rng.choice([n, n, None, 5]), rng.choice([None, "", "é", "same", f"text {n}"]), n) for n in range(1003)]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING, slot INT")
    found = sharding.shard_rows(frame, blocks=16, buckets=8).collect()
    shards = defaultdict(list)
    for r in found:
        shards[r.shard].append(r.slot)
    assert sorted(map(len, shards.values())) == [125] * 5 + [126] * 3
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    digests = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == digests


def test_matrix_has_its_sums_and_hypergeometric_means():
    blocks = [10, 0, 25, 7, 1, 57]
    total = [[0] * 8 for _ in blocks]
    for seed in range(400):
        m = sharding.matrix(blocks, 8, seed)
        assert [sum(r) for r in m] == blocks
        assert sorted(sum(c) for c in zip(*m)) == [12] * 4 + [13] * 4
        for r, own in zip(total, m):
            for s in range(8):
                r[s] += own[s]
    for n, r in zip(blocks, total):
        assert all(abs(x / 400 - n / 8) < 0.25 + 0.05 * n / 8 for x in r)


@pytest.mark.parametrize("scale", [1, 10**7])
def test_large_draws_have_the_right_spread(scale):
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(1))
    good, bad, drawn = 300 * scale, 700 * scale, 100 * scale
    found = np.array([sharding.hypergeometric(rng, good, bad, drawn) for _ in range(2000)], dtype=float)
    spread = (drawn * 0.3 * 0.7 * (1000 * scale - drawn) / (1000 * scale - 1)) ** 0.5
    assert abs(found.mean() - 0.3 * drawn) < 0.1 * spread and 0.9 < found.std() / spread < 1.1


def test_epochs_take_the_documents_that_their_seeded_order_says(spark):
    """A replay: whole epochs, then the prefix of the next one in the order of its hashes, cut inside a document."""
    from hashlib import md5

    rows, frame = documents(spark)
    frame = frame.where("doc_id != 7")
    levels = {"source": F.col("source"), "lang": F.col("lang")}
    for budget, seed in ((900, 1), (5000, 1), (5000, 2), (12_345, 3)):
        found = Mixture(frame, levels, {("big",): 1, ("s0",): 9}, F.lit(budget), max_epochs=3, seed=seed).assign(frame).collect()
        leaves, cut = defaultdict(list), 0
        for r in found:
            leaves[r.mix_source, r.mix_lang].append(r)
        for own in leaves.values():
            tokens, alloc = sum(r.n_tokens for r in own), own[0].leaf_budget
            epochs, left = divmod(alloc, tokens) if tokens else (0, 0)
            for r in sorted(own, key=lambda r: md5(f"{seed}:{epochs + 1}:{r.doc.doc_id}".encode()).hexdigest()):
                part = min(r.n_tokens, left)
                left -= part
                assert (r.copies, r.partial_tokens) == (epochs + (part > 0), part if part < r.n_tokens else 0)
                cut += 0 < part < r.n_tokens
        assert cut > 2


def chi_square(pairs, rows, columns):
    """Of a table of independent uniform numbers: about its degrees of freedom."""
    n = Counter(pairs)
    expected = sum(n.values()) / (rows * columns)
    return sum((n[i, j] - expected) ** 2 / expected for i in range(rows) for j in range(columns))


@pytest.mark.parametrize(("blocks", "buckets"), [(1024, 4096), (7, 5), (1, 1)])
def test_rows_land_uniformly(spark, blocks, buckets):
    """Neither the shard nor the place in it tells where a row stood, nor does its neighbour's."""
    n = 8000
    frame = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same").alias("text"))
    found = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(frame, blocks=blocks, buckets=buckets).collect()}
    group, tenth = lambda i: i * 16 // n, lambda slot: slot * 10 // (n // 8)
    tables = [
        chi_square([(group(i), s) for i, (s, _) in found.items()], 16, 8),
        chi_square([(group(i), tenth(x)) for i, (_, x) in found.items()], 16, 10),
        chi_square([(s, found[i + 1][0]) for i, (s, _) in found.items() if i + 1 in found], 8, 8),
        chi_square([(tenth(x), tenth(found[i + 1][1])) for i, (_, x) in found.items() if i + 1 in found], 10, 10),
        chi_square([(i % 3, s) for i, (s, _) in found.items() if i < n // 3 * 3], 3, 8),
    ]
    freedom = [15 * 7, 15 * 9, 63, 99, 14]
    assert all(abs(x - f) < 4.5 * (2 * f) ** 0.5 for x, f in zip(tables, freedom))
