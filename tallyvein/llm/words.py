"""Words and hashes of whole Arrow text columns: array work over the UTF-8 bytes, text by text.

The helpers never cut a text. Texts are taken in slices of a few megabytes so that the arrays beside
them stay small; one text longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SLICE_TEXTS = 1024
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words; one to one."""
    x = np.array(x, np.uint64, ndmin=1)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets): consecutive texts of a column, nulls as empty texts."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), first + SLICE_TEXTS, len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Powers:
    """Powers of an odd number modulo 2^64 and their inverses, grown on demand."""

    def __init__(self, base: np.uint64 = _BASE):
        self.base, self.inverse = int(base), pow(int(base), -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, size, 1 << 64))])


_POWERS = Powers()


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hashes`` turns two of them into the hash of a span."""
    _POWERS.upto(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(values)], out=out[1:])
    return out


def span_hashes(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((running[end] - running[start]) * _POWERS.down[start])


def word_names(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per word: the sum of its (place in the word, byte) pairs, each spread on its own.

    Unlike a polynomial modulo 2^64, no pattern of letters cancels, however long the word is.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    pairs = (place.astype(np.uint64) << np.uint64(8)) | values[place + np.repeat(starts, lengths)]
    pairs += np.uint64(1)
    return mix(np.add.reduceat(mix(pairs * _BASE), first) + lengths.astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words between spacing bytes; no word crosses a text."""
    inside = ~space[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] |= inside[edges]
    stops[edges - 1] |= inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): one hash per word, A-Z taken as a-z; words bounds[i]:bounds[i+1] are text i's."""
    starts, ends = word_spans(data, offsets)
    hashes = word_names(_LOWER[data], starts, ends)
    return hashes, np.searchsorted(starts, offsets)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` words, in order of their starts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, width):
        out *= _BASE
        out += hashes[j : j + n]
    return mix(out + np.uint64(width))


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted set of its shingle hashes; the whole text is one if it has fewer words."""
    for _, data, offsets in text_slices(column):
        hashes, bounds = word_hashes(data, offsets)
        shingles = window_hashes(hashes, width)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= width:
                own = np.sort(shingles[a : b - width + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            else:
                yield window_hashes(hashes[a:b], b - a)
