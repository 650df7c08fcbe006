"""Arrays of numbers as compressed bytes, for rows that carry many of them."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays of 8-byte, 4-byte or 1-byte numbers, compressed; bytes of equal weight stand together."""
    parts = []
    for a in arrays.values():
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else np.zeros((a.itemsize, 0), np.uint8)
        parts += [np.array([len(a), ord(a.dtype.kind), a.itemsize], np.int64).tobytes(), planes.tobytes()]
    return zstandard.compress(b"".join(parts), 3)


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Starts and ends of the runs of equal neighbours."""
    cuts = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]).tolist() if len(values) else []
    return list(zip(cuts, cuts[1:]))  # noqa: B905 - the last has no successor


def unpack(blob: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.decompress(blob), 0, []
    while at < len(data):
        n, kind, size = (int(x) for x in np.frombuffer(data, np.int64, 3, at))
        planes = np.frombuffer(data, np.uint8, n * size, at + 24).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(np.dtype(f"{chr(kind)}{size}")) if n else np.zeros(0, f"{chr(kind)}{size}"))
        at += 24 + n * size
    return out
