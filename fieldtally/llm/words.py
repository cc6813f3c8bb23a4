"""Words and word hashes of whole Arrow batches, computed with numpy on the UTF-8 bytes.

Everything here is a small per-batch helper: Spark cuts the data into batches, and a batch is
worked through in runs of whole texts of about ``RUN_BYTES`` bytes, so memory follows the batch
and its longest text. Word hashes are 64 bits wide; equal words have equal hashes, and different
ones are taken to differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20
SPACES = [0x20, *range(0x09, 0x0E)]

_RNG = np.random.Generator(np.random.PCG64(20261))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = 1 << 12
_POWER = np.cumprod(np.full(_PLACES, 0x9E3779B97F4A7C15, dtype=np.uint64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_class(excluded: list[int]) -> np.ndarray:
    """True for every byte value that belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[excluded] = False
    return table


#: Words of ``[^\x20\x09-\x0D]+``.
SPACED = byte_class(SPACES)
#: Words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` in lower-cased text: digits, a-z and all that is not ASCII.
ALNUM = byte_class([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def mixed(x: np.ndarray) -> np.ndarray:
    """The bits of ``x`` spread over all 64 places."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Run:
    """Some whole texts: their bytes and the borders between texts, and the same of words."""

    first: int  #: index of the first text in its batch
    data: np.ndarray  #: bytes
    offsets: np.ndarray  #: where each text begins, and the end
    starts: np.ndarray  #: where each word begins
    ends: np.ndarray
    words: np.ndarray  #: index of each text's first word, and the number of words

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.words)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.counts())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        total = int(lengths.sum())
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(total) - np.repeat(begin, lengths)
        letters = self.data[place + np.repeat(self.starts, lengths)]
        parts = _BYTE[letters] * _POWER[place & (_PLACES - 1)]
        if lengths.max() > _PLACES:
            parts *= (place >> 12).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        return mixed(np.add.reduceat(parts, begin) + lengths.astype(np.uint64))


_TAILS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def quick_hashes(run: Run) -> np.ndarray:
    """As ``Run.hashes``, other values, from eight bytes of each word at once."""
    lengths = run.ends - run.starts
    out = mixed(lengths.astype(np.uint64))
    if not len(lengths):
        return out
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate((run.data, np.zeros(8, np.uint8))), 8)
    here, at, left = slice(None), run.starts, lengths
    while len(at):
        letters = np.ascontiguousarray(eight[at]).view("<u8").ravel() & _TAILS[np.minimum(left, 8)]
        out[here] = mixed((out[here] ^ letters) * _STEP)
        more = np.flatnonzero(left > 8)
        here = more if isinstance(here, slice) else here[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, ascending, a place of each, and where each key is among them."""
    order = np.argsort(keys)
    ascending = keys[order]
    new = np.append(True, ascending[1:] != ascending[:-1])[: len(keys)]
    at = np.empty(len(keys), dtype=np.int64)
    at[order] = np.cumsum(new) - 1
    return ascending[new], order[new], at


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words, across the borders of texts too."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    size = len(words) - n + 1
    out = np.zeros(size, dtype=np.uint64)
    for k in range(n):
        out *= _STEP
        out += words[k : k + size]
    return mixed(out)


def grams_inside(run_words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text, from its word borders: first window of ``n`` words and number of windows."""
    return run_words[:-1], np.maximum(np.diff(run_words) - n + 1, 0)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and borders of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    if column.null_count:  # the buffer may hold anything below a NULL
        lengths = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        if (lengths != np.diff(offsets)).any():
            column = column.fill_null("")
            return texts_of(column)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(column: pa.Array, letters: np.ndarray, lower: bool = True) -> Iterator[Run]:
    """The texts of ``column`` in runs of about ``RUN_BYTES`` bytes, cut into words."""
    data, offsets = texts_of(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + RUN_BYTES, "right")) - 1)
        part = data[offsets[first] : offsets[last]]
        yield cut_words(first, LOWER[part] if lower else part, offsets[first : last + 1] - offsets[first], letters)
        first = last


def cut_words(first: int, data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> Run:
    inside = letters[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    border = offsets[1:-1]
    border = border[border < len(data)]
    begins[border] = inside[border]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    border = border[border > 0]
    finish[border - 1] = inside[border - 1]
    starts = np.flatnonzero(begins)
    return Run(first, data, offsets, starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets))
