"""Words of whole batches of texts as NumPy arrays: bounds and 64-bit hashes, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII letters and every byte of a longer UTF-8 character
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(column: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column of about max_bytes each; a longer text makes a range of its own."""
    size = np.diff(utf8(column)[1])
    at, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > max_bytes:
            yield at, i
            at, held = i, 0
        held += n
    if len(size):
        yield at, len(size)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and len + 1 offsets into them; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of a class within each text: starts, ends, and the number of words before each text."""
    member = inside[data]
    begins = member.copy()
    begins[1:] &= ~member[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = member[first]
    ends = member.copy()
    ends[:-1] &= ~member[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = member[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        size = max(n + 1, 1 << 21)
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0][: n + 1], _powers[1][: n + 1]


def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; memory of one that is done goes back to the system, so idle workers stay small."""
    for b in batches:
        yield b
        del b
        pa.default_memory_pool().release_unused()


class Hasher:
    """64-bit hashes of any byte ranges of one batch, from prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def shingles(hashes: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashed shingles of `width` words of each text, sorted, once each, and len + 1 offsets into them.

    A text of fewer words has one shingle of all its words; a text without words has none.
    """
    n = np.diff(before)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    starts = np.repeat(before[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    out = np.zeros(len(starts), np.uint64)
    left = np.repeat(before[1:], count) - starts
    padded = np.append(hashes, np.zeros(width, np.uint64))
    for k in range(width):
        word = padded[starts + k]
        out = mix(out * _BASE + np.where(left > k, word, np.uint64(k + 1)))
    text = np.repeat(np.arange(len(n)), count)
    order = np.lexsort((out, text))
    out, text = out[order], text[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    out, text = out[new], text[new]
    return out, np.searchsorted(text, np.arange(len(n) + 1))
