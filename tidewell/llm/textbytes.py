"""Vectorised helpers over the UTF-8 bytes of Arrow string batches.

Used inside ``mapInArrow`` tasks: a batch is cut into slices of whole documents
holding about ``SLICE_BYTES`` bytes, so a task's memory does not follow the
Arrow batch. A document longer than that is a slice of its own.

Hashes are polynomial over a random 64-bit table (one value per byte), read off
prefix sums in uint64 arithmetic, then mixed; two seeds give 128 bits.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: fixed values: odd multipliers of the splitmix64 finaliser
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def lut(chars: bytes | range) -> np.ndarray:
    """Boolean table of 256 entries, true for the given byte values."""
    t = np.zeros(256, dtype=bool)
    t[np.frombuffer(bytes(chars), dtype=np.uint8)] = True
    return t


#: bytes of a word: all but space and the controls 0x09 to 0x0D
SPACED_WORD = ~lut(b"\x20\x09\x0a\x0b\x0c\x0d")
#: bytes of a word once A-Z are lower case: digits, a-z and everything above ASCII
ALNUM_WORD = lut(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX_A
    x ^= x >> np.uint64(27)
    x *= _MIX_B
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Hash values as doubles in the open interval (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def column_slices(batch: pa.RecordBatch, column: int = 0,
                  slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)`` per slice; a null is empty."""
    arr = batch.column(column)
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    n = len(arr)
    if n == 0:
        return
    _, off_buf, data_buf = arr.buffers()
    offs = np.frombuffer(off_buf, dtype=np.int64, count=n + 1 + arr.offset)[arr.offset:]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None and data_buf.size \
        else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + slice_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        o = offs[lo:hi + 1] - offs[lo]
        yield lo, hi, data[offs[lo]:offs[hi]], o
        lo = hi


def word_bounds(data: np.ndarray, offs: np.ndarray,
                is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of word bytes; runs end with the row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    m = is_word[data]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first = m.copy()
    first[1:] &= ~m[:-1]
    first[cut] = m[cut]
    last = m.copy()
    last[:-1] &= ~m[1:]
    last[cut - 1] = m[cut - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    rows = np.searchsorted(offs, starts, side="right") - 1
    return starts, ends, rows


class PolyHash:
    """Hashes of byte ranges from one pass of prefix sums."""

    def __init__(self, seed: int) -> None:
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(0, 2**64, size=256, dtype=np.uint64)
        self.mult = int(rng.integers(0, 2**63)) * 8 + 5 & (2**64 - 1)
        self.inv = pow(self.mult, -1, 2**64)
        self._pow = self._ipow = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._pow) < n:
            size = max(n, 1 << 16)
            for name, base in (("_pow", self.mult), ("_ipow", self.inv)):
                f = np.full(size, base, dtype=np.uint64)
                f[0] = 1
                np.multiply.accumulate(f, out=f)
                setattr(self, name, f)
        return self._pow, self._ipow

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of bytes, or of 64-bit values standing for themselves."""
        p, _ = self._powers(len(data) + 1)
        s = np.empty(len(data) + 1, dtype=np.uint64)
        s[0] = 0
        x = self.table[data] if data.dtype == np.uint8 else data.copy()
        x *= p[:len(data)]
        np.cumsum(x, out=s[1:])
        return s

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mixed hash of ``data[start:end]`` per range; the length takes part."""
        _, ip = self._powers(len(prefix))
        h = prefix[ends]
        h -= prefix[starts]
        h *= ip[starts]
        h += (ends - starts).astype(np.uint64) * _GOLDEN
        return mix64(h)


def runs(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets (n + 1) of each row's entries in an array sorted by row."""
    return np.searchsorted(rows, np.arange(n + 1), side="left")


def give_back() -> None:
    """Returns freed memory to the system at the end of a task: workers live on
    between tasks, and what they still hold is lost to the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):   # a C library without it
        pass
