"""Arrow text columns as numpy arrays: words, word hashes and shingles of many rows at once.

Every function works on one *slice* of a batch: about half a megabyte of UTF-8, however
many rows that is (one very long text is a slice of its own), so temporary arrays
stay small whatever the rows hold.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
_M64 = (1 << 64) - 1


def give_back() -> None:
    """Let large freed blocks go back to the system at once.

    Python workers live on between tasks, several beside each other; what each keeps of its
    largest batch would add up. Only where the C library has these settings.
    """
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:
        for setting, value in ((-3, 8 << 20), (-1, 32 << 20), (-8, 2)):  # mmap threshold, trim threshold, arenas
            mallopt(setting, value)
        pa.set_memory_pool(pa.system_memory_pool())


give_back()


def unlike(keep: tuple[str, ...], made: tuple[str, ...]) -> None:
    """Refuse columns to keep that are called like a column that is made, case aside: the result would hold two of that name."""
    if same := sorted({c for c in keep if c.lower() in {m.lower() for m in made}}):
        raise ValueError(f"columns to keep are called like results: {', '.join(same)}; rename them first")


def lower_ascii_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_ascii_table()


@dataclass
class Slice:
    """Rows ``lo`` to ``hi`` of a column; ``bounds[i]:bounds[i+1]`` are row i's bytes in ``data``."""

    lo: int
    hi: int
    data: np.ndarray
    bounds: np.ndarray


def slices(col: pa.Array | pa.ChunkedArray, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices; a null counts as the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if not n:
        return
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1)
        yield Slice(lo, hi, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


def word_spans(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the runs of word bytes, and row i's words as ``first[i]:first[i+1]``.

    A run never crosses a row's end.
    """
    n = len(data)
    inside = is_word[data]
    opens, closes = inside.copy(), inside.copy()
    if n:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        full = bounds[:-1] < bounds[1:]
        at = bounds[:-1][full]
        opens[at] = inside[at]
        at = bounds[1:][full] - 1
        closes[at] = inside[at]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, bounds)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, as many as were asked for."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            size = max(n + 1, SLICE_BYTES + 2)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                out, have = np.ones(size, np.uint64), 1
                while have < size:  # doubling: out[have:2*have] = out[:have] * base**have
                    more = min(have, size - have)
                    out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
                    have += more
                setattr(cls, name, out)
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from one running sum over the slice."""
    n = len(data)
    up, down = _Powers.upto(n)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=acc[1:])
    return mix((acc[ends] - acc[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every k consecutive words of a row: (hash, index of its first word, row)."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(row[: n - k + 1] == row[k - 1 :])
    h = words[at].copy()
    for j in range(1, k):
        h = h * _STEP + words[at + j]
    return mix(h), at, row[at]
