"""Packing of tokenized documents into sequences, online and in bounded space.

Each task keeps at most ``OPEN`` open windows. A piece (a document, or what is left of one longer than a window) goes into the
window with the smallest gap that holds it. If none does and no more windows may be opened, the fullest one is completed
with the head of the piece and emitted, and the rest of the piece is placed anew; so an emitted window has no padding,
and there is at most one cut for each. At its end a task closes its windows in the same way, the fullest being completed with
pieces of the emptiest, until one window is left.

The windows left by the tasks are merged in rounds: those of ``FAN`` tasks meet in one group, which again
leaves one window, until one group is left. So no task ever holds more than ``FAN`` windows besides its open
ones, however many tasks there are. The very last window is cut into sequences whose lengths are powers of two, which need no padding.

A text is tokenized once, where Spark reads it, and is never shuffled; only the few leftover windows are. The pieces carry their ids.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm.records import batch_encoder
from fieldtally.llm.scratch import Scratch
from fieldtally.llm.tokens import column_ids

SEQUENCE = 4096  #: tokens of a sequence at most
END_ID = 2
OPEN = 64  #: windows that a task keeps open
FAN = 16  #: tasks whose leftover windows meet in one group
EMITTED = 256  #: full windows that are handed on at once
COLUMNS = ("doc_id", "row", "start", "length", "doc_tokens", "sequence_id", "offset", "closed", "ids")
PART_BITS = 33  #: a sequence's number is its round, its task or group, and its number there in so many bits
ROUND_BITS = 58


@dataclass
class Piece:
    """Some consecutive ids of one document."""

    doc_id: object
    row: int
    start: int
    doc_tokens: int
    ids: np.ndarray

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.row, self.start, self.doc_tokens, self.ids[:n])
        return head, Piece(self.doc_id, self.row, self.start + n, self.doc_tokens, self.ids[n:])


@dataclass
class Packer:
    """Best fit into a bounded number of open windows."""

    size: int = SEQUENCE
    n_open: int = OPEN
    gaps: list[tuple[int, int]] = field(default_factory=list)  #: (free tokens, window), ascending
    windows: dict[int, list[Piece]] = field(default_factory=dict)
    opened: int = 0

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        """Places one piece; yields the windows that become full."""
        while len(piece.ids):
            n = len(piece.ids)
            if n >= self.size:
                head, piece = piece.cut(self.size)
                yield [head]
                continue
            at = bisect_left(self.gaps, (n, -1))
            if at < len(self.gaps):
                gap, window = self.gaps.pop(at)
            elif len(self.gaps) < self.n_open:
                gap, window = self.size, self.opened
                self.opened += 1
                self.windows[window] = []
            else:  # none fits: the fullest is completed and emitted
                gap, window = self.gaps.pop(0)
                head, piece = piece.cut(gap)
                yield [*self.windows.pop(window), head]
                continue
            self.windows[window].append(piece)
            if gap == n:
                yield self.windows.pop(window)
            else:
                insort(self.gaps, (gap - n, window))
            return

    def close(self) -> Iterator[list[Piece]]:
        """Completes the fullest windows with the emptiest ones' pieces until one is left, which stays open."""
        while len(self.gaps) > 1:
            _, emptiest = self.gaps.pop()
            pieces = self.windows.pop(emptiest)
            while pieces and self.gaps:
                gap, window = self.gaps[0]
                piece = pieces.pop()
                if len(piece.ids) > gap:
                    piece, rest = piece.cut(gap)
                    pieces.append(rest)
                self.windows[window].append(piece)
                self.gaps.pop(0)
                if gap == len(piece.ids):
                    yield self.windows.pop(window)
                else:
                    insort(self.gaps, (gap - len(piece.ids), window))
            if pieces:
                self.windows[emptiest] = pieces
                insort(self.gaps, (self.size - sum(len(p.ids) for p in pieces), emptiest))

    def left(self) -> list[Piece]:
        return next(iter(self.windows.values()), [])


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces cut into windows whose lengths are the powers of two that add up to their number of tokens, largest first."""
    left = sum(len(p.ids) for p in pieces)
    pieces = pieces[::-1]
    while left:
        size = gap = 1 << (left.bit_length() - 1)
        window = []
        while gap:
            piece = pieces.pop()
            if len(piece.ids) > gap:
                piece, rest = piece.cut(gap)
                pieces.append(rest)
            window.append(piece)
            gap -= len(piece.ids)
        left -= size
        yield window


class Emitter:
    """Rows of windows in one round's task or group."""

    def __init__(self, id_type: pa.DataType, step: int, part: int):
        self.id_type, self.next = id_type, (step << ROUND_BITS) + (part << PART_BITS)

    def batch(self, windows: list[list[Piece]], closed: bool) -> pa.RecordBatch:
        sequence = np.arange(len(windows)) + self.next
        self.next += len(windows)
        pieces = [p for w in windows for p in w]
        lengths = np.array([len(p.ids) for p in pieces], dtype=np.int64)
        sizes = np.array([len(w) for w in windows], dtype=np.int64)
        before = np.cumsum(lengths) - lengths
        offsets = before - np.repeat(before[np.cumsum(sizes) - sizes], sizes)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p.doc_id for p in pieces], self.id_type), pa.array([p.row for p in pieces], pa.int64()),
                pa.array([p.start for p in pieces], pa.int64()), pa.array(lengths), pa.array([p.doc_tokens for p in pieces], pa.int64()),
                pa.array(np.repeat(sequence, sizes), pa.int64()), pa.array(offsets), pa.array(np.full(len(pieces), closed)),
                pa.array([p.ids.tobytes() for p in pieces], pa.binary()),
            ],
            list(COLUMNS),
        )


def _pack(vocabulary: str, end_id: int, size: int, n_open: int) -> Callable:
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer, emitter, row = Packer(size, n_open), None, part << PART_BITS
        for batch in batches:
            if not batch.num_rows:
                continue
            emitter = emitter or Emitter(batch.column("doc_id").type, 0, part)
            full = []
            texts = column_ids(batch_encoder(vocabulary), batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.append(ids.astype("<u4"), np.uint32(end_id)).astype("<u4")  # a copy: the batch's ids can go
                full += packer.place(Piece(doc_id, row, 0, len(ids), ids))
                row += 1
                if len(full) >= EMITTED:
                    yield emitter.batch(full, True)
                    full = []
            if full:
                yield emitter.batch(full, True)
        if emitter:
            if full := list(packer.close()):
                yield emitter.batch(full, True)
            if left := packer.left():
                yield emitter.batch([left], False)

    return run_batches


def _merge(step: int, size: int, n_open: int, last: bool) -> Callable:
    def run_group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        pieces = [Piece(r["doc_id"], r["row"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4")) for r in table.to_pylist()]
        packer, emitter = Packer(size, n_open), Emitter(table.schema.field("doc_id").type, step, key[0].as_py())
        full = [w for p in sorted(pieces, key=lambda p: -len(p.ids)) for w in packer.place(p)]
        full += packer.close()
        left = [packer.left()] if packer.left() else []
        if last:
            full, left = full + [w for x in left for w in powers_of_two(x)], []
        out = [emitter.batch(w, closed) for w, closed in ((full, True), (left, False)) if w]
        return pa.Table.from_batches(out)

    return run_group


def pack(
    docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id", end_id: int = END_ID, size: int = SEQUENCE, n_open: int = OPEN, fan: int = FAN,
) -> DataFrame:
    """Pieces (doc_id, row, start, length, doc_tokens, sequence_id, offset, ids: little-endian uint32) of all documents, each followed by ``end_id``.

    A sequence's pieces have gapless offsets and ``size`` tokens in all; only the last few sequences are shorter, and have
    a power of two of tokens. NULL and empty texts are the end id alone. Rows with equal ids, and repeated rows, are documents of their own, told apart by
    ``row``, a number of the input row; NULL ids stay NULL. Ties between windows go to the older one. An empty table gives no
    sequence. Other columns are not read. ``vocabulary`` is a tokenizer file that every worker can open.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kinds = {"doc_id": rows.schema["doc_id"].dataType, "closed": T.BooleanType(), "ids": T.BinaryType()}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.LongType())) for c in COLUMNS])
    tables = [scratch.written(rows.mapInArrow(_pack(vocabulary, end_id, size, n_open), schema), "packed")]
    part = F.shiftright(F.col("sequence_id").bitwiseAND(F.lit((1 << ROUND_BITS) - 1)), PART_BITS)
    n, step = (tables[0].where("not closed").agg(F.max(part)).first()[0] or 0) + 1, 0
    while True:
        n, step = -(-n // fan), step + 1
        group = F.floor(part / fan).cast("long").alias("group")
        merged = tables[-1].where("not closed").groupBy(group).applyInArrow(_merge(step, size, n_open, n == 1), schema)
        tables.append(scratch.written(merged, f"merged-{step}"))
        if n == 1:
            break
    out = tables[0].where("closed")
    for t in tables[1:]:
        out = out.unionByName(t.where("closed"))
    return out.drop("closed")
