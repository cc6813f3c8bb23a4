"""The pipeline's stages, each against brute force on the table it is given."""

import random
from collections import Counter

import pytest
from test_decontam import brute as leaks
from test_neardup import brute as families
from test_languages_and_quality import sentence

import corpus_pipeline
from fieldtally.llm import queries

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, kept STRING"


def documents():
    rng = random.Random(12)
    rows = []
    for n in range(120):
        lang = rng.choice(["en", "de", "fr", "es"])
        rows.append((n, sentence(rng, lang, rng.randrange(30, 90)), lang, f"src{n % 6 if n % 3 else 0}"))
    rows += [(200 + n, rows[n][1], rows[n][2], rows[n][3]) for n in range(10)]  # exact copies
    rows += [(300 + n, rows[n][1] + " end", rows[n][2], rows[n][3]) for n in range(5)]  # near copies
    items = [(n, sentence(rng, "en", 20)) for n in range(5)]
    rows += [(400 + n, rows[40 + n][1] + " " + items[n][1], "en", "src1") for n in range(5)]  # leaks
    rows += [(500, None, "en", "src0"), (501, "", None, None), (502, "## $$ 1", "de", "src2"), (3, rows[3][1], rows[3][2], rows[3][3])]
    return [(i, t, lang, s, len(t or ""), "own") for i, t, lang, s in rows], items


def test_stages(spark, tmp_path):
    rows, items = documents()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id LONG, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    given, after = [tuple(r) for r in docs.collect()], {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after[name] = [tuple(r) for r in docs.collect()]
        if name != "shard":
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
            assert not Counter(after[name]).keys() - Counter(given).keys()
    told = after["language_id"]
    assert Counter(told) == Counter(r for r in given if r[0] not in (500, 501, 502))
    texts = {r[0]: r[1] for r in told}
    component = {i: c for i, (_, c) in families(list(texts.items()), corpus_pipeline.NEAR).items()}
    assert sorted(r[0] for r in after["near_dedup"]) == sorted(set(component.values()))
    bad = {r[0] for r in leaks([(r[0], r[1]) for r in after["near_dedup"]], items) if r[5]}
    assert bad >= {400, 401, 402, 403, 404} & set(component.values()) >= {400, 401, 402, 403}
    assert Counter(after["decontaminate"]) == Counter(r for r in after["near_dedup"] if r[0] not in bad)
    tokens = sum(len(r[1].split()) for r in after["decontaminate"])
    got = sum(len(r[1].split()) for r in after["mix_sources"])
    assert 0.9 * tokens < got < 1.2 * tokens and max(Counter(after["mix_sources"]).values()) == 2
    assert Counter(r[0] for r in after["shard"]) == Counter(r[0] for r in after["mix_sources"])
    sizes = Counter(r[3] for r in after["shard"])
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 1
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(after["shard"])


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix_sources", "shard"]
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert queries.oracle_sql().keys() <= queries.queries().keys()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_twins(spark, tmp_path, name):
    """Query and SQL agree on a small fixture with copies, leaks, NULLs and a repeated row's absence."""
    duckdb = pytest.importorskip("duckdb")
    rows, items = documents()
    rows = [r for r in rows if r[0] != 3 or r is rows[3]]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id LONG, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
    rng = random.Random(7)
    vectors = [(n, n % 10, [rng.uniform(-1, 1) if n % 5 else 0.25 for _ in range(8)]) for n in range(300)] + [(300, 1, None), (301, None, [1.0])]
    spark.createDataFrame(vectors, "vec_id LONG, label INT, embedding ARRAY<FLOAT>").write.parquet(str(tmp_path / "embeddings.parquet"))
    pages = [(n, f"http://h/{n}", [None, "", f"<b>{n % 9}</b>", "é" * n][n % 4]) for n in range(60)]
    spark.createDataFrame(pages, "page_id LONG, url STRING, html STRING").write.parquet(str(tmp_path / "pages.parquet"))
    found = queries.queries()[name](spark, str(tmp_path))
    with duckdb.connect() as con:
        for t in ("documents", "benchmark", "embeddings", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        answer = con.execute(queries.oracle_sql()[name])
        names, expected = [d[0] for d in answer.description], answer.fetchall()
    columns = sorted(found.columns)
    assert columns == sorted(names)
    expected = [tuple(row[names.index(c)] for c in columns) for row in expected]
    assert sorted(map(str, (tuple(r) for r in found.select(columns).collect()))) == sorted(map(str, expected)) and expected
