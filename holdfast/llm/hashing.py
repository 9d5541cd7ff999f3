"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

The bytes of a batch of texts are hashed together: each byte has a random value,
a word's hash is the sum of its bytes' values times powers of an odd number, and
sums over any stretch are differences of one running total.  A text costs memory
in proportion to its own length; batches are cut to half a megabyte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are hashed together; a longer text is hashed alone.
CHUNK = 1 << 19
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a hash over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_LOWER = _VALUES.copy()
_LOWER[65:91] = _VALUES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes between terms: ASCII without letters and digits.  Bytes of other characters are all above.
NO_TERM = np.zeros(256, bool)
NO_TERM[:128] = True
NO_TERM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        ones = np.ones(size, np.uint64)
        up, down = ones.copy(), ones.copy()
        up[1:], down[1:] = np.uint64(_BASE), np.uint64(_INVERSE)
        _powers[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _powers[0], _powers[1]


def _chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First text, bytes, and where texts begin, of stretches of the array; a null is an empty text."""
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    texts = texts.fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def words(texts: pa.Array, lower: bool, between: np.ndarray = _SPACE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First text, hashes of all words of a stretch of texts, and where each text's words begin.

    Words are parted by the bytes ``between``, else by ASCII white space; ``lower`` takes A-Z as a-z.
    """
    for first, data, begin in _chunks(texts):
        inside = ~between[data]
        start, stop = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        edges = begin[:-1][begin[:-1] < begin[1:]]
        start[edges] = inside[edges]
        edges = begin[1:][begin[:-1] < begin[1:]] - 1
        stop[edges] = inside[edges]
        starts, stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
        up, down = _tables(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_LOWER if lower else _VALUES)[data] * up[:len(data)], out=total[1:])
        yield first, _mixed((total[stops] - total[starts]) * down[starts]), np.searchsorted(starts, begin)


def folded(parts: list[np.ndarray], count: int) -> np.ndarray:
    """One hash of ``count`` values each of several arrays."""
    out = np.full(count, np.uint64(len(parts)), np.uint64)
    for part in parts:
        out ^= part
        out *= np.uint64(_BASE)
        out ^= out >> np.uint64(29)
    return _mixed(out)


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on, as long as there are so many."""
    count = max(len(codes) - n + 1, 0)
    return folded([codes[k:k + count] for k in range(n)], count)


def shingle_sets(texts: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct ``n``-word shingles of each text; of fewer words, the whole sequence; of none, nothing."""
    for _, codes, begin in words(texts, lower=True):
        every = grams(codes, n)
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
            if b - a >= n:
                yield np.unique(every[a:b - n + 1])
            else:
                yield grams(codes[a:b], b - a) if b > a else codes[:0]


def places(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Shingles of each text in the order of their words; none if it has fewer than ``n`` words."""
    for _, codes, begin in words(texts, lower=True):
        every = grams(codes, n)
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
            yield every[a:max(a, b - n + 1)]
