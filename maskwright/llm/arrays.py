"""Words of whole Arrow batches as numpy arrays, without a Python object per word.

A word is 64 bits of its bytes: a sum of byte values times powers of an odd number, taken
as a difference of running sums, then mixed. Two different words meet with a probability
of about 2^-64, which the operators accept for words and runs of words.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Text worked on at a time; bounds the temporary arrays. A longer text is one block.
BLOCK_BYTES = 1 << 20

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd ``base`` modulo 2^64, and those of its inverse."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        have = _powers[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (a fixed bijection), so that orders and buckets look random."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _kinds(spaces: bool) -> np.ndarray:
    byte = np.arange(256)
    if spaces:
        return ~((byte == 32) | ((byte >= 9) & (byte <= 13)))
    letter = ((byte | 32) >= 97) & ((byte | 32) <= 122) & (byte < 128)
    return letter | ((byte >= 48) & (byte <= 57)) | (byte >= 128)


#: Bytes of words between white space, and of words of letters, digits and non-ASCII.
BETWEEN_SPACES = _kinds(spaces=True)
ALPHANUMERIC = _kinds(spaces=False)
#: A value for every byte; A-Z as a-z.
_LOWER = np.arange(256)
_LOWER[65:91] += 32
BYTE_VALUE = mix((_LOWER + 1).astype(np.uint64) * np.uint64(_WORD_BASE))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], whole[offsets[0] : offsets[-1]]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one longer text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words(offsets: np.ndarray, data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of the texts of one block, A-Z as a-z: their hashes, and per text the
    index of its first word (one more entry than texts)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    inside = is_word[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.append(False, inside[:-1])
    after = np.append(inside[1:], False)
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    up, down = powers(_BYTE_BASE, n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[data] * up, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` hashes, in order; crossing texts is the caller's concern."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(_WORD_BASE, n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up, out=total[1:])
    return mix((total[k:] - total[:-k]) * down[: n - k + 1])


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(first) - 1), first[1:] - first[:-1])
