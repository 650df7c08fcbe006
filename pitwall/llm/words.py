"""Words of many texts at once: positions and 64-bit hashes, from Arrow columns without a loop over words.

A word's hash is a polynomial over its bytes, modulo 2**64, with a final mix. Two different words get the same hash
with a chance of about 2**-60 a pair, so equal hashes stand for equal words wherever only equality counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# An odd multiplier has an inverse modulo 2**64, so a word's hash follows from two prefix sums.
_MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Any byte but space and the control characters 09 to 0D.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[32, *range(9, 14)]] = False

# Digits, ASCII letters and every byte of a character beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; kept and grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        size = 1 << max(16, int(n).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.cumprod(have, dtype=np.uint64)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power over all prefixes; slices of it give hashes of substrings."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(_MULTIPLIER, len(data))[: len(data)]
    np.cumsum(terms, out=out[1:])
    return out


def substring_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unmixed hashes of data[start:end]; equal bytes give equal hashes wherever they stand."""
    inverse = powers(INVERSE, len(prefix))
    return (prefix[end] - prefix[start]) * inverse[start]


def raw_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and the offsets of each; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(column) else data[:0], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (mixed, ASCII lower case) of all words in order, and the word offsets of each text."""
    inside = kind[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False  # a text never goes on in the next one
    start = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    end = np.flatnonzero(inside & ~after[1:]) + 1
    hashes = mix(substring_hash(prefix_hash(LOWER[data]), start, end))
    return hashes, np.searchsorted(start, offsets)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words; a run of fewer words at the end of the array is left out."""
    if len(hashes) < n:
        return hashes[:0]
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += hashes[k : len(hashes) - n + 1 + k]
        out ^= out >> np.uint64(31)
    return mix(out)


def whole(hashes: np.ndarray) -> np.ndarray:
    """One hash for a whole sequence of words, told apart from the hashes of full shingles by its length."""
    return shingles(hashes, len(hashes)) ^ np.uint64(len(hashes))
