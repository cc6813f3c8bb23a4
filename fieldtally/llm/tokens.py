"""Token ids of whole Arrow batches, each distinct word encoded once.

A word's ids do not depend on its neighbours for a vocabulary that is cut at white space, so a batch is cut into words
with numpy, its distinct words are looked up in a table of words seen before, and only new ones are encoded.
The ids of the texts are then gathered from the table. The table is a few flat arrays per worker: sorted hashes, where each word's
letters and ids lie, the letters and the ids. Each occurrence's letters are compared with the table's, so two words
with one hash cannot be mistaken for each other; a text with such a word is encoded as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from fieldtally.llm.words import SPACED, Run, distinct, quick_hashes, runs

TABLE_BYTES = 64 << 20  #: of a worker's table, which starts anew when it is full
RECENT = 1 << 16  #: words that are kept apart before they are merged into the sorted table


def ragged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places ``start, start + 1, ...`` of each of some spans, one after the other, and each one's number inside its span."""
    begin = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
    return np.repeat(starts, lengths) + inside, inside


class _Growing:
    """A flat array to which pieces are appended."""

    def __init__(self, kind: str):
        self.data, self.n = np.empty(1 << 12, dtype=kind), 0

    def append(self, piece: np.ndarray) -> None:
        if self.n + len(piece) > len(self.data):
            self.data = np.concatenate((self.data[: self.n], np.empty(max(self.n, len(piece)), self.data.dtype)))
        self.data[self.n : self.n + len(piece)] = piece
        self.n += len(piece)


class WordTable:
    """Words with their letters and ids: a large sorted part and a small one, both searched."""

    def __init__(self, width: str):
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.letters, self.ids = _Growing("u1"), _Growing(self.width)
        self.borders = [_Growing("i8") for _ in range(4)]  # first letter, letters, first id, ids
        self.sorted = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2

    def nbytes(self) -> int:
        return self.letters.n + self.ids.n * self.ids.data.itemsize + 48 * self.borders[0].n

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's row, or -1."""
        row = np.full(len(hashes), -1, dtype=np.int64)
        for known, rows in self.sorted:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                row[hit] = rows[at[hit]]
        return row

    def add(self, hashes: np.ndarray, letters: np.ndarray, letter_sizes: np.ndarray, ids: list[bytes]) -> np.ndarray:
        """Appends words with ascending new hashes; returns their rows."""
        rows = np.arange(len(hashes)) + self.borders[0].n
        packed = np.frombuffer(b"".join(ids), dtype=self.width)
        id_sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // packed.itemsize
        for part, values, sizes, (first, size) in ((self.letters, letters, letter_sizes, (0, 1)), (self.ids, packed, id_sizes, (2, 3))):
            self.borders[first].append(part.n + np.cumsum(sizes) - sizes)
            self.borders[size].append(sizes)
            part.append(values)
        large, small = self.sorted
        small = _merged(small, (hashes, rows))
        if len(small[0]) > RECENT:
            large, small = _merged(large, small), (small[0][:0], small[1][:0])
        self.sorted = [large, small]
        return rows


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.concatenate((a[0], b[0]))
    order = np.argsort(hashes, kind="stable")  # two ascending runs are merged
    return hashes[order], np.concatenate((a[1], b[1]))[order]


class BatchEncoder:
    """Encodes whole columns. ``word`` gives one word's packed ids and ``text`` a whole text's; with ``wordwise`` off, only ``text`` is used."""

    def __init__(self, word: Callable[[str], bytes], text: Callable[[str], bytes], width: str, wordwise: bool = True):
        self.word, self.text, self.width, self.wordwise = word, text, width, wordwise
        self.table = WordTable(width)

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For runs of texts: index of the first, all their ids, and the borders of each text's. NULL is empty."""
        if not self.wordwise:
            for n, text in enumerate(column):
                ids = np.frombuffer(self.text(text.as_py() or ""), dtype=self.width)
                yield n, ids, np.array([0, len(ids)])
            return
        for run in runs(column, SPACED, lower=False):
            yield run.first, *self._run(run)

    def _run(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        if not len(run.starts):
            return np.zeros(0, dtype=self.width), np.zeros(run.n_texts + 1, dtype=np.int64)
        hashes, first, inverse = distinct(quick_hashes(run))
        if self.table.nbytes() > TABLE_BYTES:
            self.table.clear()
        row = self.table.find(hashes)
        new = np.flatnonzero(row < 0)
        if len(new):
            data, starts, ends, word = run.data.tobytes(), run.starts[first[new]], run.ends[first[new]], self.word
            ids = [word(data[s:e].decode()) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            row[new] = self.table.add(hashes[new], run.data[ragged(starts, ends - starts)[0]], ends - starts, ids)
        row = row[inverse]
        letter, letters, at, n = (b.data[: b.n][row] for b in self.table.borders)
        borders = np.concatenate(([0], np.cumsum(n)))[run.words]
        ids = self.table.ids.data[ragged(at, n)[0]]
        if (same := self._same(run, letter, letters)).all():
            return ids, borders
        parts = [ids[borders[k] : borders[k + 1]] for k in range(run.n_texts)]
        for k in np.unique(run.text_of_word()[~same]):
            parts[k] = np.frombuffer(self.text(run.data[run.offsets[k] : run.offsets[k + 1]].tobytes().decode()), dtype=self.width)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def _same(self, run: Run, letter: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Which words have the letters that the table has for them."""
        lengths = run.ends - run.starts
        same = lengths == letters
        some = np.flatnonzero(same)
        own, inside = ragged(run.starts[some], lengths[some])
        differs = run.data[own] != self.table.letters.data[inside + np.repeat(letter[some], lengths[some])]
        if differs.any():
            same[some[np.unique(np.searchsorted(np.cumsum(lengths[some]), np.flatnonzero(differs), "right"))]] = False
        return same


def column_ids(encode: BatchEncoder, column: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each text of a column."""
    for _first, ids, borders in encode.encode(column):
        for k in range(len(borders) - 1):
            yield ids[borders[k] : borders[k + 1]]
