"""The pieces of op9's sharded counts, and the model over splits, chunks, shards and odd languages."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldtally.llm import perplexity, word_model
from test_languages_and_quality import frame
from test_word_perplexity import plain, texts

WIDE = st.integers(0, (1 << word_model.KEY_BITS) - 1)


@settings(max_examples=100, deadline=None)
@given(st.sets(WIDE, min_size=1), st.lists(st.integers(0, (1 << 62)), min_size=0))
def test_packing_round_trips(keys, values):
    keys = np.array(sorted(keys), dtype=np.uint64)
    assert (word_model.unpacked_keys(word_model.packed_keys(keys)) == keys).all()
    assert word_model.unpacked(word_model.packed(np.array(values, dtype=np.int64))).tolist() == values
    five = [np.array(values, dtype=np.int64) % m for m in (5, 1 << 60, 9, 7, 2)]
    assert [c.tolist() for c in word_model.unpacked_columns(word_model.packed_columns(five), 5)] == [c.tolist() for c in five]
    assert word_model.unpacked_columns(word_model.packed_columns(five[1:2]), 1)[0].tolist() == five[1].tolist()
    some = np.array([v % 7 for v in values], dtype=np.uint64)
    own, place, at = word_model.distinct(some)
    assert own.tolist() == sorted(set(some.tolist())) and (own[at] == some).all() and (some[place] == own).all()
    for shards in (1, 3, 100):
        found = list(word_model.pieces(keys, 2, shards))
        assert np.concatenate([keys[p] for _, p in found]).tolist() == keys.tolist()
        assert all(2 * shards <= s < 3 * shards for s, _ in found) and [s for s, _ in found] == sorted({s for s, _ in found})


def test_keys_take_few_bytes():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << word_model.KEY_BITS, 300_000, dtype=np.uint64))
    assert len(word_model.packed_keys(keys)) < 5.1 * len(keys)


def test_quick_hashes():
    """Equal words have equal hashes wherever they stand, others differ."""
    from fieldtally.llm import words

    rng = np.random.default_rng(3)
    own = ["x" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 20)] + ["é", "e\u0301", "中" * 5] + [rng.bytes(6).hex() for _ in range(300)]
    texts = [" ".join(rng.permutation(own)) for _ in range(3)] + ["", None, "ab"]
    found = {}
    for run in words.runs(pa.array(texts), words.SPACED, lower=False):
        for s, e, h in zip(run.starts, run.ends, words.quick_hashes(run), strict=True):
            assert found.setdefault(bytes(run.data[s:e]), int(h)) == int(h)
    assert len(set(found.values())) == len(found) == len(set(own))


@pytest.mark.parametrize("cuts", [[1], [3, 4], [7, 1, 1, 90]])
def test_chunks_do_not_depend_on_batches(monkeypatch, cuts):
    monkeypatch.setattr(word_model, "CHUNK_BYTES", 50)
    rows = [(n // 40, "x" * (n * 7 % 23) if n % 5 else None) for n in range(99)]
    table = pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})
    whole = [(c.block, c.number, c.rows.to_pylist()) for c in word_model.chunks(iter(table.to_batches()))]
    batches, first = [], 0
    for n in cuts * 99:
        batches += table.slice(first, n).to_batches()
        first += n
    assert [(c.block, c.number, c.rows.to_pylist()) for c in word_model.chunks(iter(batches))] == whole
    assert [r for _, _, c in whole for r in c] == table.to_pylist() and len(whole) > 6
    assert {b for b, _, _ in whole} == {0, 1, 2} and all(len({r["block"] for r in c}) == 1 for _, _, c in whole)


def expected(rows, good, languages=("en", "de")):
    models = {k: plain([t for i, t, lang, _ in rows if i in good and lang == k]) for k in languages}
    out = {}
    for i, text, lang, _ in rows:
        w = ["", "", *(text or "").split()]
        if lang in models and len(w) > 2:
            out[i] = np.exp(-np.mean([np.log(models[lang](tuple(w[k - 2 : k + 1]))) for k in range(2, len(w))]))
    return out


def agrees(found, rows, good, languages=("en", "de")):
    wanted = expected(rows, good, languages)
    assert len(found) == len(rows)
    for r in found:
        assert (r.perplexity is None) == (r.doc_id not in wanted)
        assert r.perplexity is None or r.perplexity == pytest.approx(wanted[r.doc_id], rel=1e-9)


def test_one_file_in_several_splits_chunks_and_shards(spark, tmp_path, monkeypatch):
    """Each split of a file is a block of its own; nothing depends on how texts lie in splits, chunks and shards."""
    monkeypatch.setattr(perplexity, "HELD_OUT", 10**9)
    monkeypatch.setattr(word_model, "SHARD_BYTES", 4000)
    monkeypatch.setattr(word_model, "CHUNK_BYTES", 2500)  # of the driver's plan only: workers cut by their own value
    rows = texts(400) + [(900, " ".join(["word1 word7"] * 9000), "en", "s")]
    path = str(tmp_path / "docs")
    frame(spark, rows).coalesce(1).write.option("parquet.block.size", 20_000).option("parquet.page.row.count.limit", 20).parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "12k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        docs = spark.read.parquet(path)
        assert docs.rdd.getNumPartitions() > 2 and len(docs.inputFiles()) == 1
        good = [i for i, *_ in rows if i % 2]
        found = perplexity.score_words(docs, spark.createDataFrame([(i,) for i in good], "doc_id LONG")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    agrees(found, rows, good)


def test_shuffled_input_is_written_first(spark, tmp_path, monkeypatch):
    """Rows that come from files but not in their order have no place that a second pass would find again."""
    monkeypatch.setattr(perplexity, "HELD_OUT", 10**9)
    rows = texts(60)
    frame(spark, rows).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs")).repartition(5)
    assert docs.inputFiles() and not perplexity._from_files(docs)
    agrees(perplexity.score_words(docs, spark.createDataFrame([(i,) for i in range(30)], "doc_id LONG")).collect(), rows, set(range(30)))


@pytest.mark.parametrize("good", [[], [1, 2, 4], [0, 3], [900, 901]])
def test_null_language_has_no_perplexity(spark, monkeypatch, good):
    """Neither with trusted texts of other languages, nor without any, nor where only texts without a language are trusted."""
    monkeypatch.setattr(perplexity, "HELD_OUT", 10**9)
    rows = texts(9) + [(900, texts(1)[0][1], None, "s"), (901, "word1 word2", None, None), (902, None, None, None), (903, "", "en", None)]
    docs, trusted = frame(spark, rows), spark.createDataFrame([(i,) for i in good], "doc_id LONG")
    found = {r.doc_id: r for r in perplexity.score_words(docs, trusted).collect()}
    languages = {r[2] for r in rows if r[0] in good} - {None}
    agrees(found.values(), rows, good, languages)
    assert found[900].perplexity is None and found[900].kept and found[901].kept and not found[902].kept and not found[903].kept


def test_repeated_rows_and_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(perplexity, "HELD_OUT", 10**9)
    rows = texts(12) + [(50, " ".join(t for _, t, _, _ in texts(300)), "en", "s")]
    good = [1, 2, 3]
    found = perplexity.score_words(frame(spark, rows + [rows[4]] * 3), spark.createDataFrame([(i,) for i in good * 2], "doc_id LONG")).collect()
    assert len(found) == len(rows) + 3 and len({tuple(r) for r in found}) == len(rows)
    agrees({tuple(r): r for r in found}.values(), rows, good)
