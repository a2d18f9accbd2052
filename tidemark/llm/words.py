"""Words of whole texts as numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D.  Those six are
ASCII, so splitting the UTF-8 bytes equals splitting the text; ``bytes.split()``
uses the same six separators.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_U = np.uint64
BASE = _U(0x9E3779B97F4A7C15)
WORD_BASE = _U(0xD6E8FEB86659FD93)


@lru_cache(maxsize=8)
def _byte_values(turn: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(20240611 + turn)).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64's finaliser)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def powers(n: int, base=BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """hash per word; first word index per document (one more entry than documents)."""
    hashes: np.ndarray
    first: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def word_hashes(col, turn: int = 0) -> Words:
    """64-bit polynomial hash of every word of every text of ``col``; another family of hashes per ``turn``."""
    data, offs = text_buffers(col)
    if len(data) == 0:
        return Words(np.zeros(0, np.uint64), np.zeros(len(offs), np.int64))
    space = SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offs] = True
    start = ~space
    start[1:] &= space[:-1] | edge[1:-1]
    starts = np.flatnonzero(start)
    keep = np.flatnonzero(~space)
    where = np.searchsorted(keep, starts)
    lens = np.diff(np.append(where, len(keep)))
    place = np.arange(len(keep)) - np.repeat(where, lens)
    pw = powers(int(lens.max()) if len(lens) else 1)
    h = np.add.reduceat(_byte_values(turn)[data[keep]] * pw[place], where) if len(where) else np.zeros(0, np.uint64)
    return Words(mix(h + lens.astype(np.uint64)), np.searchsorted(starts, offs))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Order-sensitive hash of every k consecutive entries (crossing documents too)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= WORD_BASE
        out += hashes[j:j + n]
    return mix(out)


def within(first: np.ndarray, k: int, n_words: int) -> np.ndarray:
    """True where a window of k words starting here stays inside one document."""
    ok = np.ones(max(n_words - k + 1, 0), dtype=bool)
    for end in first[1:-1]:
        ok[max(0, end - k + 1):end] = False
    return ok


def slices(offsets: np.ndarray, limit: int):
    """(a, b) document ranges whose texts hold about ``limit`` bytes at most (one document at least)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b
