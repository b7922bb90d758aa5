"""Sorted 64-bit keys on the move: a block of rows sends each hash range one
packed array of its distinct keys, and a range adds up what all blocks sent.

This replaces a shuffle of one row per key: a key costs about six bytes, and a
frequent one is one entry per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(x: np.ndarray, delta: bool = False) -> bytes:
    """Unsigned integers, byte plane by byte plane, which shuffles compress."""
    x = x.astype("<u8")
    if delta and len(x):
        x = np.concatenate([x[:1], x[1:] - x[:-1]])
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(b: bytes, delta: bool = False) -> np.ndarray:
    x = np.frombuffer(b, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()
    return np.cumsum(x, dtype=np.uint64) if delta else x


def squeeze(b: bytes) -> bytes:
    """Compressed bytes behind their size, for rows that hold megabytes: the JVM then
    reads, copies and writes less of them."""
    return len(b).to_bytes(8, "little") + pa.compress(b, "zstd", asbytes=True)


def unsqueeze(b) -> memoryview:
    b = memoryview(b)
    return memoryview(pa.decompress(b[8:], int.from_bytes(b[:8], "little"), "zstd"))


def range_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Hash range of each key, monotone in the key."""
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def cuts(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each range begins among sorted keys, and the end."""
    return np.searchsorted(range_of(keys, n), np.arange(n + 1, dtype=np.uint64))


def totals(keys: list[np.ndarray], counts: list[np.ndarray]):
    """For concatenated (keys, counts): each entry's total over equal keys,
    whether it is the first of them with a count, and the distinct keys seen."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    if not len(k):
        return c, np.zeros(0, bool), 0
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    size = np.diff(np.append(start, len(k)))
    total = np.add.reduceat(c, start)
    first = np.minimum.reduceat(np.where(c > 0, np.arange(len(k)), len(k)), start)
    out, own = np.empty_like(c), np.zeros(len(k), bool)
    out[order] = np.repeat(total, size)
    own[order[first[first < len(k)]]] = True
    return out, own, int((total > 0).sum())
