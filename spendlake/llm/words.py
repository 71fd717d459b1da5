"""White-space words of many texts at once: numpy over the bytes of an Arrow column, no object per word.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D; hashes are 64 bits wide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes hashed in one go; a longer word is hashed alone.
STRIDE = 1 << 22


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(count: int, salt: int) -> np.ndarray:
    """``count`` odd constants that look random."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


_OF_BYTE = seeds(256, 11)
_BASE = np.uint64(0x9E3779B97F4A7C13)
_powers = np.ones(1, np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 2 * len(_powers)) - 1, _BASE)]), dtype=np.uint64)
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after the other, and where each text begins and ends; null is empty."""
    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the range of its words (one entry more than texts).

    With ``kinds`` (a small number per byte value, 0: as its neighbours) words are cut further between two different ones.
    """
    inside = ~SEPARATOR[data]
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    if kinds is not None and len(data):
        kind = kinds[data]
        cut = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        first[1:] |= cut
        last[:-1] |= cut
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; spans do not overlap and are in order."""
    out = np.empty(len(starts), np.uint64)
    begin = 0
    while begin < len(starts):
        end = max(begin + 1, int(np.searchsorted(ends, starts[begin] + STRIDE)))
        low, high = int(starts[begin]), int(ends[end - 1])
        own, lengths = starts[begin:end] - low, ends[begin:end] - starts[begin:end]
        powers = _powers_to(int(lengths.max()) + 1)
        gaps = np.diff(np.append(own, high - low))
        place = np.arange(high - low) - np.repeat(own, gaps)
        values = _OF_BYTE[data[low:high]] * powers[np.minimum(place, len(powers) - 1)]
        values[place >= np.repeat(lengths, gaps)] = 0
        out[begin:end] = mix(np.add.reduceat(values, own) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        begin = end
    return out


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every text, A-Z lower-cased, and for each text the range of its words."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, ranges = spans(data, offsets)
    return hashes(data, starts, ends), ranges


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its ``size``-word shingles.

    Fewer words than that: the whole sequence as one. No words or null: none.
    """
    words, ranges = word_hashes(column)
    factors = seeds(size, 23)
    windows = max(0, len(words) - size + 1)
    joined = np.zeros(windows, np.uint64)
    for i in range(size):
        joined += words[i : i + windows] * factors[i]
    joined = mix(joined)
    out = []
    for begin, end in zip(ranges[:-1], ranges[1:]):
        if end - begin >= size:
            out.append(np.unique(joined[begin : end - size + 1]))
        elif end > begin:
            whole = (words[begin:end] * factors[: end - begin]).sum(dtype=np.uint64) + np.uint64(end - begin)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
