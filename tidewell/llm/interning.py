"""Interning byte strings in an open-addressed NumPy table.

Keys are xxhash64 values of ranges of one buffer; a slot is taken by the first range
that meets it free, and a range belongs to a slot only if hash, length and all bytes
equal its owner's (linear probing otherwise), so no two strings ever share a slot.
All ranges probe together: a round settles every range whose slot agrees.
"""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

#: fixed values: the odd multipliers of xxHash64
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

#: strings of this many bytes and more are hashed by the library, one by one
_LONG = 32


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every place of ``data`` as a little-endian number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def _low(lanes: np.ndarray, n) -> np.ndarray:
    """The first ``n`` (1 to 8) bytes of lanes."""
    return lanes & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (8 - n).astype(np.uint64)))


def xxhash64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of every ``data[start:end]``."""
    lanes, size = _lanes(data), ends - starts
    h = _P5 + size.astype(np.uint64)
    short = np.flatnonzero(size < _LONG)
    for k in range(0, _LONG, 8):
        at = short[size[short] >= k + 8]
        if not len(at):
            break
        h[at] = _turned(h[at] ^ _turned(lanes[starts[at] + k] * _P2, 31) * _P1, 27) * _P1 + _P4
    done = size & ~7
    at = short[(size[short] & 4) > 0]
    h[at] = _turned(h[at] ^ (lanes[starts[at] + done[at]] & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
    done = size & ~3
    for k in range(3):
        at = short[(size[short] & 3) > k]
        h[at] = _turned(h[at] ^ (lanes[starts[at] + done[at] + k] & np.uint64(0xFF)) * _P5, 11) * _P1
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size >= _LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes())
    return h


class Interned:
    """Distinct strings among ``data[start:end]``: ``slot`` of every range, and per
    slot in use (``used``) its ``owner`` range, ``count`` and crc32 ``bucket``."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int,
                 keys: np.ndarray | None = None) -> None:
        n = len(starts)
        cells = 1 << max(4, int(2 * n - 1).bit_length())
        key = xxhash64(data, starts, ends) if keys is None else keys
        lanes, size = _lanes(data), ends - starts
        owner = np.full(cells, -1, np.int64)
        self.slot = np.empty(n, np.int64)
        at = (key & np.uint64(cells - 1)).astype(np.int64)
        left = np.arange(n)
        while len(left):
            free = owner[at] < 0
            owner[at[free]] = left[free]
            held = owner[at]
            same = (key[held] == key[left]) & (size[held] == size[left])
            same[same] = _equal(data, lanes, starts[left[same]], starts[held[same]], size[left[same]])
            self.slot[left[same]] = at[same]
            left, at = left[~same], (at[~same] + 1) & (cells - 1)
        self.used = np.flatnonzero(owner >= 0)
        self.owner = owner
        self.count = np.bincount(self.slot, minlength=cells)
        raw, first = data.tobytes(), owner[self.used]
        self.bucket = np.zeros(cells, np.int64)
        self.bucket[self.used] = [zlib.crc32(raw[a:b]) % buckets
                                  for a, b in zip(starts[first].tolist(), ends[first].tolist())]


def _equal(data: np.ndarray, lanes: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes at ``a`` equal those at ``b``, per pair."""
    same = np.ones(len(a), bool)
    left = np.flatnonzero(a != b)
    for i in left[size[left] > 256].tolist():
        same[i] = np.array_equal(data[a[i]:a[i] + size[i]], data[b[i]:b[i] + size[i]])
    left = left[size[left] <= 256]
    k = 0
    while len(left):
        n = np.minimum(8, size[left] - k)
        agree = _low(lanes[a[left] + k] ^ lanes[b[left] + k], n) == 0
        same[left[~agree]] = False
        k += 8
        left = left[agree & (size[left] > k)]
    return same
