import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldtally.llm import packing, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def piece(row, n):
    return packing.Piece(row, row, 0, n, np.arange(n, dtype="<u4"))


def run(lengths, size, n_open):
    packer, full = packing.Packer(size, n_open), []
    for row, n in enumerate(lengths):
        full += packer.place(piece(row, n))
        assert len(packer.windows) == len(packer.gaps) <= n_open
    return packer, full


def spans(windows):
    found = defaultdict(list)
    for w in windows:
        for p in w:
            assert p.ids.tolist() == list(range(p.start, p.start + len(p.ids)))
            found[p.row].append((p.start, p.start + len(p.ids)))
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=60), st.integers(1, 32), st.integers(1, 6))
def test_every_token_lies_in_one_piece_and_windows_are_full(lengths, size, n_open):
    packer, full = run(lengths, size, n_open)
    full += packer.close()
    assert all(sum(len(p.ids) for p in w) == size for w in full) and len(packer.windows) <= 1
    last = list(packing.powers_of_two(packer.left()))
    sizes = [sum(len(p.ids) for p in w) for w in last]
    assert all(s & (s - 1) == 0 for s in sizes) and sizes == sorted(set(sizes), reverse=True)
    found = spans(full + last)
    for row, n in enumerate(lengths):
        own = sorted(found[row])
        assert [x for s in own for x in s][1:-1:2] == [x for s in own for x in s][2::2]  # gapless
        assert (own[0][0], own[-1][1]) == (0, n) if n else not own
    cuts = sum(len(v) - 1 for v in found.values())
    assert cuts <= len(full) + len(last) + n_open


def test_best_fit_and_the_fullest_goes_first():
    packer, full = run([6, 7, 3], 10, 2)
    assert [[p.row for p in w] for w in full] == [[1, 2]] and packer.gaps == [(4, 0)]  # gap 3 holds 3 better than gap 4
    packer, full = run([6, 8, 3], 10, 2)  # 3 fits only into the first
    assert [p.row for p in packer.windows[0]] == [0, 2] and not full
    packer, full = run([6, 8, 5], 10, 2)  # none fits: the fullest (8) is completed with 2 of the 5, the other 3 go to the first
    assert [[p.row for p in w] for w in full] == [[1, 2]] and [len(p.ids) for p in packer.windows[0]] == [6, 3]
    packer, full = run([25], 10, 2)
    assert [len(w[0].ids) for w in full] == [10, 10] and packer.gaps == [(5, 0)]


def checked(pieces, documents, size):
    """Holds the pieces against the documents' ids; returns the lengths of the sequences."""
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0
        by_row[r.row].append((r.start, ids, r))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    got = []
    for parts in by_row.values():
        parts.sort(key=lambda x: x[0])
        ids = np.concatenate([x[1] for x in parts])
        assert [x[0] for x in parts] == np.cumsum([0, *[len(x[1]) for x in parts]])[:-1].tolist()
        assert {(x[2].doc_id, x[2].doc_tokens) for x in parts} == {(parts[0][2].doc_id, len(ids))}
        got.append((parts[0][2].doc_id, ids.tolist()))
    assert sorted(got, key=str) == sorted(documents, key=str)
    lengths = []
    for parts in by_sequence.values():
        parts.sort()
        assert [p[0] for p in parts] == np.cumsum([0, *[p[1] for p in parts]])[:-1].tolist()
        lengths.append(sum(p[1] for p in parts))
    assert max(lengths, default=0) <= size and all(n == size or n & (n - 1) == 0 for n in lengths)
    return lengths


@pytest.mark.parametrize(("parts", "size", "n_open", "fan"), [(1, 64, 4, 2), (9, 64, 4, 2), (9, 50, 1, 3), (9, 4096, 64, 16)])
def test_packed_table(spark, parts, size, n_open, fan):
    from tokenizers import Tokenizer

    library, rng = Tokenizer.from_file(VOCABULARY), random.Random(4)
    texts = [" ".join(rng.choices(["the", "Été", "x1", "don't", "ß"], k=rng.randrange(60))) for _ in range(120)] + [None, "", "long word " * 700]
    docs = [(n, t, -1) for n, t in enumerate(texts)] + [(5, texts[5], -1), (5, "another", -1), (None, "no id", -1), (None, None, -1)]
    frame = spark.createDataFrame(docs, "doc_id LONG, text STRING, row LONG").repartition(parts)
    pieces = packing.pack(frame, VOCABULARY, size=size, n_open=n_open, fan=fan).collect()
    documents = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, _ in docs]
    lengths = checked(pieces, documents, size)
    assert len([n for n in lengths if n < size]) <= size.bit_length()


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id LONG, text STRING"), VOCABULARY).collect() == []


def test_query_digests(spark, tmp_path):
    docs = [(n, "Some words " * (n * 400)) for n in range(12)] + [(90, None)]
    spark.createDataFrame(docs, "doc_id LONG, text STRING").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.queries()["op11_bounded_packing"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = found.collect()
    end = zlib.crc32(np.array([2], "<u4").tobytes())
    assert [(r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id in (0, 90)] == [(0, 1, end, 1)] * 2
    totals = found.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(r.n for r in totals) == sum(2 * n * 400 + 1 for n in range(12)) + 1
