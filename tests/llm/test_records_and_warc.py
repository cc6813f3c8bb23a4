import base64
import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldtally.llm import records, shared_files, warc
from fieldtally.llm.scratch import Scratch

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


ALPHABET = "aAbzZé'ÀßÿñİΣς0９ \t\n\x0b\x85\u00a0\u2028_-.,!?#$<|>startofxe\u0301中🙂×÷"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=60))
def test_word_encoder_equals_the_library(library, text):
    own = records.encoder(VOCABULARY)
    assert np.frombuffer(own.encode(text), own.width).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["<|endoftext|> x<|startoftext|>y", "I'll can't 'S 'sx", "THÉ Ünïted", "1234 5a6", "x" * 3000, "café cafe\u0301"])
def test_word_encoder_on_special_texts(library, text):
    own = records.encoder(VOCABULARY)
    assert np.frombuffer(own.encode(text), own.width).tolist() == library.encode(text, add_special_tokens=False).ids


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(records, "CACHED_WORDS", 3)
    monkeypatch.setattr(records, "CACHED_PARTS", 2)
    own = records.WordEncoder(VOCABULARY)
    text = "one two three four, five two one six two three"
    assert np.frombuffer(own.encode(text), own.width).tolist() == library.encode(text, add_special_tokens=False).ids


def test_frames_detect_damage():
    record = records.frame(b"some payload")
    assert records.unframe(record) == b"some payload" and records.unframe(records.frame(b"")) == b""
    for at in range(len(record)):
        with pytest.raises((ValueError, records.struct.error)):
            records.unframe(record[:at] + bytes([record[at] ^ 4]) + record[at + 1 :])


def test_records_round_trip(spark, library, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "Été", "x1", "don't", "\n", "ßx"]) for _ in range(rng.randrange(40))) for _ in range(90)]
    docs = [(n * 7 % 90, t, "mine") for n, t in enumerate(texts)] + [(91, None, "mine"), (92, "", "mine"), (50, "again", "mine"), (None, "no id", "mine")]
    frame = spark.createDataFrame(docs, "doc_id LONG, text STRING, file STRING").repartition(5)
    index = records.write_records(frame, VOCABULARY, str(tmp_path / "out"))
    scratch = Scratch(spark, "t")
    found = sorted(records.token_starts(records.read_records(index), scratch).collect(), key=lambda r: r.start)
    assert [-1 if r.doc_id is None else r.doc_id for r in found] == sorted(-1 if i is None else i for i, *_ in docs)
    start, left = 0, [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, _ in docs]
    for r in found:
        ids = next(x for x in left if x[0] == r.doc_id and zlib.crc32(np.array(x[1], "<u4").tobytes()) == r.ids_crc32)
        left.remove(ids)
        assert (r.start, r.n_tokens) == (start, len(ids[1]))
        start += r.n_tokens
    assert not left
    # any few records can be read in any order
    few = index.where("doc_id in (92, 3, 50)").orderBy(F.desc("doc_id"))
    assert sorted(r.doc_id for r in records.read_records(few).collect()) == [3, 50, 50, 92]


def test_empty_table_gives_no_records(spark, tmp_path):
    index = records.write_records(spark.createDataFrame([], "doc_id LONG, text STRING"), VOCABULARY, str(tmp_path / "none"))
    assert records.token_starts(records.read_records(index), Scratch(spark, "t")).count() == 0


PAGES = "page_id LONG, url STRING, html STRING, sha1 STRING"


def archives(spark, tmp_path, pages):
    frame = spark.createDataFrame([(*p, "mine") for p in pages], PAGES).repartition(3)
    return warc.write_archives(frame, str(tmp_path / "archives"), Scratch(spark, "t"))


def expected(pages):
    least = {}
    for i, _, h in pages:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    out = []
    for i, _, h in pages:
        body = (h or "").encode()
        first = least.get(h or "")
        kind = "response" if i == first else "revisit"
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), kind, None if kind == "response" else first))
    return sorted(out, key=str)


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    long = "<p>é\r\n\r\nWARC/1.1 " * 40_000
    pages = [(n, f"http://h/{n}", f"<b>{n % 7}</b>" if n % 3 else f"<i>{n}</i>\r\n") for n in range(40)]
    pages += [(50, None, None), (51, "", ""), (52, "u\r\nWARC-Type: x", long), (53, "v", long), (3, "again", "<b>3</b>")]
    manifest = archives(spark, tmp_path, pages)
    chunks = warc.read_chunks(manifest)
    assert sorted((tuple(r) for r in warc.page_digests(chunks).collect()), key=str) == expected(pages)
    body = [r for r in chunks.where("record_id = '52'").orderBy("chunk").collect()]
    assert len(body) == -(-len(long.encode()) // warc.CHUNK) and b"".join(r.data for r in body) == long.encode()
    so_far = hashlib.sha1()
    for n, r in enumerate(body):
        so_far.update(r.data)
        assert (r.chunk, r.sha1_so_far, r.last) == (n, so_far.hexdigest(), n == len(body) - 1) and len(r.data) <= warc.CHUNK
    assert chunks.where("record_type = 'revisit' and bytes_so_far > 0").count() == 0


def test_archive_files_are_cut_and_are_gzip(spark, tmp_path, monkeypatch):
    import gzip

    monkeypatch.setattr(warc, "FILE_BYTES", 500)
    uris = []

    class Batch:
        pass

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({
        "page_id": list(range(9)), "url": ["u"] * 9, "payload": [bytes([65 + n]) * 50 for n in range(9)],
        "sha1": [hashlib.sha1(bytes([65 + n]) * 50).hexdigest() for n in range(9)], "refers_to": pa.array([None] * 9, pa.int64()),
    })
    for out in warc._write(str(tmp_path / "cut"))(iter([batch])):
        uris += out.to_pylist()
    assert len(uris) > 2 and sum(u["records"] for u in uris) == 9
    text = b"".join(gzip.decompress(Path(u["file"]).read_bytes()) for u in uris)
    assert text.count(b"WARC/1.1\r\n") == 9 and text.count(b"Content-Length: 50\r\n") == 9


def test_damaged_archive_is_an_error(spark, tmp_path):
    manifest = archives(spark, tmp_path, [(1, "u", "x" * 300_000)])
    uri = manifest.first()["file"]
    whole = Path(uri).read_bytes()
    Path(uri).write_bytes(whole[: len(whole) // 2])
    with shared_files.open_file(uri) as source, pytest.raises(ValueError, match="ends inside"):
        list(warc.record_chunks(source))


def test_no_pages(spark, tmp_path):
    manifest = archives(spark, tmp_path, [])
    assert manifest.count() == 0 and warc.page_digests(warc.read_chunks(manifest)).count() == 0


def test_base32_of_known_values(spark):
    rows = [(hashlib.sha1(bytes([n])).hexdigest(),) for n in range(50)]
    found = spark.createDataFrame(rows, "h STRING").select("h", warc.base32_column(F.col("h")).alias("b")).collect()
    assert all(r.b == base64.b32encode(bytes.fromhex(r.h)).decode() for r in found)


def test_column_encoder_equals_the_library(library):
    import pyarrow as pa

    rng = random.Random(5)
    texts = [None, "", "  \n", "x" * 5000, "a " * 3000] + ["".join(rng.choices(ALPHABET, k=rng.randrange(200))) for _ in range(300)]
    own = records.batch_encoder(VOCABULARY)
    assert own.wordwise
    for _ in range(2):  # once with new words, once with known ones
        found = [x.tolist() for x in records.column_ids(own, pa.array(texts))]
        assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_column_encoder_with_full_tables_and_one_hash_for_all(library, monkeypatch):
    import pyarrow as pa

    from fieldtally.llm import tokens, words

    rng = random.Random(6)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randrange(9))) for _ in range(50)]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    one = records.WordEncoder(VOCABULARY)
    make = lambda: tokens.BatchEncoder(one.word, lambda t: np.array(library.encode(t, add_special_tokens=False).ids, one.width).tobytes(), one.width)
    with monkeypatch.context() as patch:
        patch.setattr(tokens, "TABLE_BYTES", 0)
        patch.setattr(tokens, "RECENT", 2)
        patch.setattr(words, "RUN_BYTES", 20)
        assert [x.tolist() for x in records.column_ids(make(), pa.array(texts))] == expected
    monkeypatch.setattr(tokens, "quick_hashes", lambda run: np.zeros(len(run.starts), dtype=np.uint64))
    assert [x.tolist() for x in records.column_ids(make(), pa.array(texts))] == expected


def test_records_of_other_vocabularies(spark, tmp_path):
    """Case, white space and cuts of a file are its own; the width of ids comes from the index."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not records.cuts_are_known(path) and records.cuts_are_known(VOCABULARY)
    plain = Tokenizer.from_file(path)
    texts = ["The Cat sat on  12 Hats.", "", None, "é\n\nÀ  x", "  lead"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    index = records.write_records(frame, path, str(tmp_path / "other"), end_id=7)
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in records.read_records(index).collect()}
    assert found == {n: [*plain.encode(t or "", add_special_tokens=False).ids, 7] for n, t in enumerate(texts)}


def test_width_of_ids_is_read_from_the_index(spark, tmp_path, monkeypatch):
    texts = ["some words here", "and more"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").coalesce(1)
    index = records.write_records(frame, VOCABULARY, str(tmp_path / "narrow"))
    row = index.where("doc_id = 0").first()
    ids = np.frombuffer(next(r.ids for r in records.read_records(index).collect() if r.doc_id == 0), "<u4")
    wide = records.frame(ids.astype("<u4").tobytes())
    (tmp_path / "wide").write_bytes(wide)
    one = spark.createDataFrame([(0, 0, str(tmp_path / "wide"), 0, len(wide), len(ids), 4)], index.schema)
    assert row.width == 2 and records.read_records(one).first().ids == ids.tobytes()
