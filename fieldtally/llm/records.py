"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A record is framed as in common record files of training data::

    uint64 length | uint32 masked crc of length | payload | uint32 masked crc of payload

all little-endian, the checksum being CRC-32 rotated right by 15 bits plus a constant. The payload is one document's ids,
two bytes each while the vocabulary has at most 65,536 ids, else four. Files hold the documents in ascending order
of id, file after file; the index is a separate table (file, number of the file, offset, length, number of tokens, first
token), so any record can be read on its own and in any order.

Documents are range-partitioned by id; a task encodes its part in batches and streams one file to the
shared folder. The index is written by Spark, and only files named in it exist for readers.

Encoding keeps the ids of words that it has seen (``tokens``) where the vocabulary's file cuts texts as ``KNOWN_CUTS`` does: white space
separates words there, and no merge crosses it. Texts for any other file go through the library's tokenizer whole.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm import shared_files
from fieldtally.llm.scratch import Scratch
from fieldtally.llm.tokens import BatchEncoder, column_ids

MASK = 0xA282EAD8
END_ID = 1
CACHED_WORDS = 1 << 17  #: in each worker, cleared when full
CACHED_PARTS = 1 << 19

# How the public file word_bpe_49k.json normalizes and cuts texts.
KNOWN_CUTS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}

_PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile("[a-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^0-9a-zÀ-ÖØ-öø-ÿ]+")
_SPACE = re.compile("[\x20\x09-\x0d]+")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(record: bytes) -> bytes:
    """The payload of one framed record; ValueError if a length or checksum is wrong."""
    length, crc = struct.unpack_from("<QI", record)
    payload = record[12 : 12 + length]
    if masked_crc(record[:8]) != crc or len(record) != length + 16 or struct.unpack_from("<I", record, 12 + length)[0] != masked_crc(payload):
        raise ValueError("damaged record")
    return payload


class WordEncoder:
    """``tokenizer.encode(text, add_special_tokens=False)`` word by word, remembering words.

    Words of ASCII and Latin-1 letters, digits and signs go straight to the model, cut as the pre-tokenizer of
    ``word_bpe_49k.json`` cuts them; all others (apostrophes, other scripts, special tokens) go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: spelled.pre_tokenize_str(chr(c))[0][0] for c in (*range(0xC0, 0x100),) if chr(c) not in "×÷"}
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.width).tobytes()

    def part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            spelled = part if part.isascii() else part.translate(self.letters)
            found = self.packed([t.id for t in self.tokenizer.model.tokenize(spelled)])
            if len(self.parts) >= CACHED_PARTS:
                self.parts.clear()
            if len(part) <= 64:
                self.parts[part] = found
        return found

    def fresh(self, word: str) -> bytes:
        """A word's ids, which are not remembered."""
        if len(word) <= 256 and _PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join(map(self.part, _PARTS.findall(word.lower())))
        return self.packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        found = self.fresh(word)
        if len(self.words) >= CACHED_WORDS:
            self.words.clear()
        if len(word) <= 64:
            self.words[word] = found
        return found

    def encode(self, text: str) -> bytes:
        known, word = self.words.get, self.word
        return b"".join([w for x in _SPACE.split(text) if x for w in (known(x) or word(x),)])


def cuts_are_known(path: str) -> bool:
    """Whether a vocabulary's file lets words be encoded one by one: cut as in ``KNOWN_CUTS``, and no added token holds white space."""
    with open(path, encoding="utf-8") as source:
        found = json.load(source)
    words = not any(_SPACE.search(t["content"]) or t["lstrip"] or t["rstrip"] for t in found["added_tokens"])
    return words and all(found[k] == v for k, v in KNOWN_CUTS.items())


_BATCH: dict[str, BatchEncoder] = {}


def batch_encoder(path: str) -> BatchEncoder:
    """One encoder of whole columns per worker and vocabulary, so that its words outlive a task."""
    if path not in _BATCH:
        one = encoder(path)
        _BATCH[path] = BatchEncoder(one.fresh, lambda text: one.packed(one.tokenizer.encode(text, add_special_tokens=False).ids), one.width, cuts_are_known(path))
    return _BATCH[path]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker and vocabulary, so that its caches outlive a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _write(folder: str, path: str, end_id: int) -> Callable:
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = batch_encoder(path)
        end = np.array([end_id], dtype=encode.width).tobytes()
        step = len(end)
        uri, out, offset = None, None, 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    uri, out = shared_files.create(folder, ".records")
                offsets, lengths, tokens = [], [], []
                for ids in column_ids(encode, batch.column("text")):
                    payload = ids.tobytes() + end
                    record = frame(payload)
                    out.write(record)
                    offsets.append(offset)
                    lengths.append(len(record))
                    tokens.append(len(payload) // step)
                    offset += len(record)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("part"), pa.array([uri] * len(offsets)),
                        pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), pa.array(tokens, pa.int64()),
                        pa.array(np.full(len(offsets), step, dtype=np.int32)),
                    ],
                    ["doc_id", "part", "file", "offset", "length", "n_tokens", "width"],
                )
        finally:
            if out is not None:
                out.close()

    return run_batches


def write_records(docs: DataFrame, vocabulary: str, folder: str, text: str = "text", doc_id: str = "doc_id", end_id: int = END_ID) -> DataFrame:
    """Writes the records below ``folder`` and returns the index, written there as ``index``:
    (doc_id, part, file, offset, length, n_tokens, width: bytes of an id). ``vocabulary`` is a tokenizer file that every worker can open.

    NULL and empty texts are a record of the end id alone. Rows with equal ids are records of their own, in the order of
    their texts' hashes; NULL ids come first. An empty table gives an empty index and no file.
    """
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("h"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))
    schema = T.StructType().add("doc_id", rows.schema["doc_id"].dataType).add("part", "integer").add("file", "string")
    schema = schema.add("offset", "long").add("length", "long").add("n_tokens", "long").add("width", "integer")
    index = rows.mapInArrow(_write(f"{folder}/files", vocabulary, end_id), schema)
    index.write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(index.schema).parquet(f"{folder}/index")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uri, source = None, None
    try:
        for batch in batches:
            ids = []
            for name, offset, length, width in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length", "width")), strict=True):
                if name != uri:
                    if source is not None:
                        source.close()
                    uri, source = name, shared_files.open_file(name)
                source.seek(offset)
                ids.append(np.frombuffer(unframe(source.read(length)), dtype=f"<u{width}").astype("<u4").tobytes())
            keep = [batch.column(c) for c in ("doc_id", "part", "offset")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(ids, pa.binary())], ["doc_id", "part", "offset", "ids"])
    finally:
        if source is not None:
            source.close()


def read_records(index: DataFrame) -> DataFrame:
    """Rows (doc_id, part, offset, ids: little-endian uint32) of the records named by ``index``, in any order and number."""
    schema = T.StructType().add("doc_id", index.schema["doc_id"].dataType).add("part", "integer").add("offset", "long").add("ids", "binary")
    return index.select("doc_id", "part", "file", "offset", "length", "width").mapInArrow(_read, schema)


def token_starts(records: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from read records: ``start`` counts the ids of all documents before."""
    n = (F.octet_length("ids") / 4).cast("long")
    rows = scratch.written(records.select("doc_id", "part", "offset", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32")), "digests")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row per file
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = W.partitionBy("part").orderBy("offset").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    rows = rows.join(totals.select("part", before.alias("before")), "part")
    return rows.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
