"""Counts of an interpolated modified Kneser-Ney model of word 3-grams, in shards, and scores of texts by them.

Texts are cut into chunks of about ``CHUNK_BYTES``, which every pass finds anew in the same place: a block is a split of an input file, and its rows come
in the same order each time. A pass over the texts lists each chunk's distinct n-grams of one order, sorted, in pieces by range of their keys;
a shard joins the pieces of one range from all chunks, sums what the trained texts of the chunks contribute, and answers each piece with
the sums for its n-grams. Answers carry no keys: the next pass lists the same n-grams again and reads the answers beside them. So an n-gram
costs some five bytes in the shuffle (sorted keys, low bytes and packed steps of the rest) and a fraction of a byte on disk.

There is one pass per order, from the longest to words (for the longer ones one per part of the shards). With its answer for an n-gram a chunk learns the count and whether it is the first
chunk to have it trained; that one chunk passes the n-gram on to the next shorter order: it adds one to the distinct words to the left of its last words, and
its count to the totals of its context. A last pass has the sums of all orders for its texts and adds up their log probabilities.

Rows of a pass are chunks times shards, and both follow the text; a shard holds the distinct n-grams of about ``SHARD_BYTES`` of text, however often they occur.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs

from fieldtally.llm import shared_files
from fieldtally.llm.words import SPACED, distinct, mixed, quick_hashes, runs, texts_of

CHUNK_BYTES = 8 << 20
SHARD_BYTES = 16 << 20
ORDERS = (3, 2, 1)
PARTS = {3: 2, 2: 2, 1: 1}  #: shares of the shards that are asked one after the other, so that less lies in the shuffle at a time
COLUMNS = {3: 1, 2: 5, 1: 5}  #: numbers that a chunk contributes, and is answered, for each n-gram of an order
KEY_BITS = 56  #: two of ten thousand million n-grams are taken for one about seven hundred times, and a text's n-gram for another once in seven million
LOW_BYTES = 4
REQUEST = "shard int, block long, chunk int, keys binary, sums binary"
ANSWER = "block long, chunk int, shard int, found binary, n1 long, n2 long, n3 long, n4 long, types long, total long"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_DROPPED = np.uint64(64 - KEY_BITS)
_CODEC = "zstd"


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on: their number of bytes, and the compressed bytes."""
    width = next(w for w in (1, 2, 4, 8) if int(values.max(initial=0)) < 1 << (8 * w) - (w == 8))
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(values.astype(f"<u{width}").tobytes(), codec=_CODEC, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    return np.frombuffer(pa.decompress(data[9:], decompressed_size=n * width, codec=_CODEC, asbytes=True), dtype=f"<u{width}").astype(np.int64)


def joined(parts: Sequence[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def parted(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(data[at + 8 : at + 8 + n])
        at += 8 + n
    return out


#: How many bits each of so many columns has in the bytes that hold them.
LAYOUT = {1: ((8,),), 5: ((3, 3, 2), (2, 2))}


def packed_columns(columns: Sequence[np.ndarray]) -> bytes:
    """Columns of mostly small numbers, which go together: some share a byte, and those too large for their bits follow."""
    parts, rest = [], iter(columns)
    for bits in LAYOUT[len(columns)]:
        byte, at = np.zeros(len(columns[0]), dtype=np.uint8), 0
        for b in bits:
            column, most = next(rest), (1 << b) - 1
            byte |= np.minimum(column, most).astype(np.uint8) << np.uint8(at)
            parts.append(packed(column[column >= most]))
            at += b
        parts.append(packed(byte))
    return joined(parts)


def unpacked_columns(data: bytes, n: int) -> list[np.ndarray]:
    parts, out = parted(data), []
    for bits in LAYOUT[n]:
        byte, at = unpacked(parts[len(bits)]), 0
        for k, b in enumerate(bits):
            column = byte >> at & (1 << b) - 1
            column[column == (1 << b) - 1] = unpacked(parts[k])
            out.append(column)
            at += b
        parts = parts[len(bits) + 1 :]
    return out


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys: low bytes as they are, and the steps of what is above them."""
    low = np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES])
    high = (keys >> np.uint64(8 * LOW_BYTES)).astype(np.int64)
    return joined([low.tobytes(), packed(high[:1]), packed_columns([np.diff(high)])])


def unpacked_keys(data: bytes) -> np.ndarray:
    low, first, steps = parted(data)
    high = np.cumsum(np.concatenate((unpacked(first), *unpacked_columns(steps, 1)))).astype(np.uint64)
    out = np.zeros((len(low) // LOW_BYTES, 8), dtype=np.uint8)
    out[:, :LOW_BYTES] = np.frombuffer(low, dtype=np.uint8).reshape(-1, LOW_BYTES)
    return out.reshape(-1).view("<u8") + (high << np.uint64(8 * LOW_BYTES))


@dataclass
class Chunk:
    """Some consecutive rows of a block."""

    block: int
    number: int
    rows: pa.RecordBatch


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Cuts rows (block, text, ...) into chunks that depend on nothing but the block's rows."""
    block, number, size, held = None, 0, 0, []

    def out() -> Chunk:
        return Chunk(block, number, pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    for batch in batches:
        if not batch.num_rows:
            continue
        blocks = batch.column("block").to_numpy()
        sizes = np.diff(texts_of(batch.column("text"))[1])
        first = 0
        for row in range(batch.num_rows):
            if blocks[row] != block or size >= CHUNK_BYTES:
                if row > first:
                    held.append(batch.slice(first, row - first))
                if held:
                    yield out()
                number = number + 1 if blocks[row] == block else 0
                block, size, held, first = int(blocks[row]), 0, [], row
            size += int(sizes[row])
        held.append(batch.slice(first))
    if held:
        yield out()


class Grams:
    """The n-grams of one language's texts in a chunk."""

    def __init__(self, words: np.ndarray, place: np.ndarray, text: np.ndarray, trained: np.ndarray, lang: int):
        """``words``: a hash of each word; ``place``: its number in its text; ``text``: which text; ``trained``: whether to learn from it."""
        seed = mixed(np.array([lang + 1], dtype=np.uint64))[0]
        self.text, self.trained = text, trained
        self.start = mixed(np.array([seed], dtype=np.uint64))
        word = mixed(words ^ seed)
        before = self._shifted(word, place, self.start)
        pair = mixed(before * _STEP + word)
        self.start_pair = mixed(self.start * _STEP + self.start)
        before_pair = self._shifted(pair, place, self.start_pair)
        # of each order: the n-gram that ends at each word; its context is the shorter one that ends at the word before
        self.key = {n: key >> _DROPPED for n, key in ((1, word), (2, pair), (3, mixed(before_pair * _STEP + word)))}
        self.first_words, self._known = place == 0, {}

    @staticmethod
    def _shifted(keys: np.ndarray, place: np.ndarray, start: np.ndarray) -> np.ndarray:
        out = np.concatenate((start, keys[:-1]))[: len(keys)]
        out[place == 0] = start[0]
        return out

    def keys(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct n-grams, ascending, with those that only begin texts; where each n-gram of the texts is among
        them; and a place where each occurs in the texts (0 for those that do not)."""
        if order not in self._known:
            own = self.key[order]
            more = {1: self.start >> _DROPPED, 2: self.start_pair >> _DROPPED, 3: own[:0]}[order] if len(own) else own
            keys, first, at = distinct(np.concatenate((own, more)))
            self._known[order] = keys, at[: len(own)], np.where(first < len(own), first, 0)
        return self._known[order]

    def contexts(self, order: int) -> np.ndarray:
        """Where each word's context is among the distinct n-grams of the next shorter order."""
        keys, at, _ = self.keys(order - 1)
        start = {2: self.start, 3: self.start_pair}[order] >> _DROPPED
        out = np.concatenate((np.searchsorted(keys, start), at[:-1]))[: len(at)]
        out[self.first_words] = out[:1]
        return out

    def occurrences(self) -> list[np.ndarray]:
        """How often the trained texts have each n-gram of the longest order."""
        keys, at, _ = self.keys(ORDERS[0])
        return [np.bincount(at[self.trained], minlength=len(keys))]

    def passed_on(self, order: int, found: list[np.ndarray]) -> list[np.ndarray]:
        """What this chunk's first n-grams add to the next shorter ones: distinct words to the left; and for
        contexts the total, and how many n-grams have counts of 1, 2 and more."""
        _, _, first = self.keys(order)
        count, own = found[0] >> 1, found[0] & 1 == 1
        shorter, _, _ = self.keys(order - 1)
        count, first = count[own], first[own]
        left, context = self.keys(order - 1)[1][first], self.contexts(order)[first]
        n = len(shorter)
        tally = lambda at, weights=None: np.bincount(at, weights=weights, minlength=n).astype(np.int64)
        classes = [tally(context[count == 1]), tally(context[count == 2]), tally(context[count > 2])]
        return [tally(left), tally(context, count), *classes]

    def logs(self, found: dict[int, list[np.ndarray]], model: dict[int, Level]) -> np.ndarray:
        """The log probability of each word."""
        level = model[1]
        count = found[1][0] >> 1
        taken = level.discounts @ np.array([level.n1, level.n2, level.types - level.n1 - level.n2])
        p = (level.reduced(count) + taken / (level.types + 1)) / level.total
        for order in (2, 3):
            level, first = model[order], self.keys(order)[2]
            at_shorter = self.keys(order - 1)[1][first]  # of each n-gram: its last words
            context = self.contexts(order)[first]
            total, classes = found[order - 1][1][context], [x[context] for x in found[order - 1][2:]]
            lower, taken = p[at_shorter], sum(d * x for d, x in zip(level.discounts, classes, strict=True))
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.where(total > 0, (level.reduced(found[order][0] >> 1) + taken * lower) / total, lower)
        return np.log(p)[self.keys(3)[1]]


@dataclass
class Level:
    """One order of one language's model."""

    n1: int
    n2: int
    n3: int
    n4: int
    types: int
    total: int

    @property
    def discounts(self) -> np.ndarray:
        """Missing counts of counts give the usual fallback of 0.5, 1, 1.5."""
        if not (self.n1 and self.n2 and self.n3):
            return np.array([0.5, 1.0, 1.5])
        y = self.n1 / (self.n1 + 2 * self.n2)
        found = [1 - 2 * y * self.n2 / self.n1, 2 - 3 * y * self.n3 / self.n2, 3 - 4 * y * self.n4 / self.n3]
        return np.maximum(found, 0.05)

    def reduced(self, count: np.ndarray) -> np.ndarray:
        """Counts less their discounts."""
        return np.maximum(count - np.append(0.0, self.discounts)[np.minimum(count, 3)], 0.0)


class Answers:
    """What shards have answered to the chunks of a block, by order; the last block's rows are kept."""

    def __init__(self, folders: dict[int, str], shards: int):
        self.folders, self.shards, self.block, self.rows = folders, shards, None, {}

    def _read(self, block: int) -> None:
        self.block, self.rows = block, {}
        for order, folder in self.folders.items():
            system, path = shared_files.resolve(f"{folder}/block={block}")
            for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if info.base_name.endswith(".parquet"):
                    with system.open_input_file(info.path) as source:
                        table = pq.ParquetFile(source).read(columns=["chunk", "shard", "found"])
                    columns = (table.column(c).to_pylist() for c in ("chunk", "shard", "found"))
                    self.rows.update({(order, c, s): f for c, s, f in zip(*columns, strict=True)})

    def of(self, chunk: Chunk, lang: int, order: int, keys: np.ndarray) -> list[np.ndarray]:
        if chunk.block != self.block:
            self._read(chunk.block)
        found = [[] for _ in range(COLUMNS[order])]
        for shard, piece in pieces(keys, lang, self.shards):
            parts = unpacked_columns(self.rows[order, chunk.number, shard], COLUMNS[order])
            if len(parts[0]) != piece.stop - piece.start:
                raise ValueError("the rows of a block have changed between two passes")
            for own, part in zip(found, parts, strict=True):
                own.append(part)
        return [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in found]


def pieces(keys: np.ndarray, lang: int, shards: int) -> Iterator[tuple[int, slice]]:
    """Shards of a language are ranges of equal width of its keys."""
    shard = ((keys >> np.uint64(KEY_BITS - 32)) * np.uint64(shards)) >> np.uint64(32)
    borders = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
    for n in np.flatnonzero(np.diff(borders)).tolist():
        yield lang * shards + n, slice(int(borders[n]), int(borders[n + 1]))


def chunk_grams(chunk: Chunk, trained: np.ndarray, languages: Sequence[str]) -> Iterator[tuple[int, Grams]]:
    """The n-grams of each language's texts. Texts without a language of ``languages`` have none."""
    place_of = {name: k for k, name in enumerate(languages)}
    label = np.array([place_of.get(x, -1) if x is not None else -1 for x in chunk.rows.column("lang").to_pylist()], dtype=np.int64)
    words, counts = [], []
    for run in runs(chunk.rows.column("text"), SPACED):
        words.append(quick_hashes(run))
        counts.append(run.counts())
    words, counts = np.concatenate(words), np.concatenate(counts)
    text = np.repeat(np.arange(len(label)), counts)
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    for lang in np.unique(label[label >= 0]).tolist():
        own = np.flatnonzero((label == lang)[text])
        yield lang, Grams(words[own], place[own], text[own], trained[text[own]], lang)


class Trusted:
    """Which rows of a chunk to learn from: by the hashes of trusted rows that were dealt to the blocks."""

    def __init__(self, folder: str):
        self.folder, self.block, self.hashes = folder, None, None

    def of(self, chunk: Chunk) -> np.ndarray:
        if chunk.block != self.block:
            self.block, found = chunk.block, [np.zeros(0, np.int64)]
            system, path = shared_files.resolve(f"{self.folder}/block={chunk.block}")
            for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if info.base_name.endswith(".parquet"):
                    with system.open_input_file(info.path) as source:
                        found.append(pq.ParquetFile(source).read(columns=["th"]).column("th").to_numpy())
            self.hashes = np.concatenate(found)
        return np.isin(chunk.rows.column("th").to_numpy(), self.hashes)


def ask(order: int, languages: Sequence[str], shards: int, trusted_folder: str, folders: dict[int, str], part: int = 0) -> Callable:
    """A pass over the texts: pieces of each chunk's n-grams of one order, with what they contribute, for one part of the shards."""

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trusted, answers = Trusted(trusted_folder), Answers(folders, shards)
        for chunk in chunks(batches):
            for lang, grams in chunk_grams(chunk, trusted.of(chunk), languages):
                if order == ORDERS[0]:
                    sums = grams.occurrences()
                else:
                    sums = grams.passed_on(order + 1, answers.of(chunk, lang, order + 1, grams.keys(order + 1)[0]))
                keys, rows = grams.keys(order)[0], []
                for shard, piece in pieces(keys, lang, shards):
                    if shard % PARTS[order] == part:
                        rows.append((shard, chunk.block, chunk.number, packed_keys(keys[piece]), packed_columns([s[piece] for s in sums])))
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else None
                if columns:
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "block", "chunk", "keys", "sums"])

    return run_batches


def answer(order: int) -> Callable:
    """One shard: the sums of all chunks, given back to each chunk for its n-grams. The lowest bit of the first sum marks the first
    chunk that adds to it."""

    def run_group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _answers(key[0].as_py(), table, COLUMNS[order])

    return run_group


def _answers(shard: int, table: pa.Table, columns: int) -> pa.Table:
    table = table.sort_by([("block", "ascending"), ("chunk", "ascending")])
    keys = [unpacked_keys(x.as_py()) for x in table.column("keys")]
    sums = [unpacked_columns(x.as_py(), columns) for x in table.column("sums")]
    _, _, at = distinct(np.concatenate(keys))
    n, sizes = int(at.max()) + 1, np.array([len(k) for k in keys])
    totals = []
    for parts in zip(*sums, strict=True):
        total = np.zeros(n, dtype=np.int64)
        np.add.at(total, at, np.concatenate(parts))
        totals.append(total)
    adds = np.flatnonzero(np.concatenate([s[0] for s in sums]))
    owner = np.full(n, -1, dtype=np.int64)
    owner[at[adds][::-1]] = adds[::-1]
    first = np.zeros(len(at), dtype=np.int64)
    first[owner[owner >= 0]] = 1
    borders = np.concatenate(([0], np.cumsum(sizes)))
    found = []
    for k in range(len(keys)):
        own = slice(borders[k], borders[k + 1])
        parts = [total[at[own]] for total in totals]
        parts[0] = parts[0] * 2 + first[own]
        found.append(packed_columns(parts))
    classes = [int((totals[0] == c).sum()) for c in (1, 2, 3, 4)]
    stats = [*classes, int((totals[0] > 0).sum()), int(totals[0].sum())]
    rest = len(keys) - 1
    return pa.table(
        {
            "block": table.column("block"), "chunk": table.column("chunk"), "shard": pa.array([shard] * len(keys), pa.int32()),
            "found": pa.array(found, pa.binary()),
            **{name: pa.array([x] + [0] * rest, pa.int64()) for name, x in zip(("n1", "n2", "n3", "n4", "types", "total"), stats, strict=True)},
        }
    )


def score(languages: Sequence[str], shards: int, folders: dict[int, str], models: dict[int, dict[int, Level]]) -> Callable:
    """The last pass: log perplexities per word, for texts with words in a language that has a model."""

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(folders, shards)
        for chunk in chunks(batches):
            n = chunk.rows.num_rows
            total, n_words, judged = np.zeros(n), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
            for lang, grams in chunk_grams(chunk, np.zeros(n, dtype=bool), languages):
                if lang not in models:
                    continue
                logs = grams.logs({order: answers.of(chunk, lang, order, grams.keys(order)[0]) for order in ORDERS}, models[lang])
                total += np.bincount(grams.text, weights=logs, minlength=n)
                n_words += np.bincount(grams.text, minlength=n)
                judged |= np.bincount(grams.text, minlength=n) > 0
            size = np.diff(texts_of(chunk.rows.column("text"))[1])
            keep = [chunk.rows.column(c) for c in ("doc_id", "th", "lang", "block")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(size), pa.array(-total / np.maximum(n_words, 1), mask=~judged)], ["doc_id", "th", "lang", "block", "n_bytes", "log_perplexity"]
            )

    return run_batches
