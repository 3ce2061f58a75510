"""Words of an Arrow batch of texts as numpy arrays: places, hashes, windows.

Runs inside Spark tasks.  A batch is worked on in pieces of half a MB of text,
so memory stays bounded by one piece or by the longest single text.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 19
MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def separators(spec: str) -> np.ndarray:
    """256 flags: which bytes separate words.  ``space``: x20 and x09-x0D;
    ``alnum``: every ASCII byte but digits and letters."""
    flags = np.zeros(256, bool)
    if spec == "space":
        flags[[0x20, *range(0x09, 0x0E)]] = True
    else:
        flags[:0x80] = True
        for lo, hi in (("0", "9"), ("a", "z"), ("A", "Z")):
            flags[ord(lo):ord(hi) + 1] = False
    return flags


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    inverse = pow(MULTIPLIER, -1, 1 << 64)
    out = []
    for base in (MULTIPLIER, inverse):
        p = np.ones(n, np.uint64)
        p[1:] = np.uint64(base)
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(2 * PIECE_BYTES, 1 << (int(n) + 1).bit_length()))


def mixed(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _range_hash(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[lo:hi] for each pair, equal for equal content."""
    power, inverse = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:len(values)], out=total[1:], dtype=np.uint64)
    return mixed((total[hi] - total[lo]) * inverse[lo] + (hi - lo).astype(np.uint64))


@dataclass
class Grid:
    """Words of texts first..first+n: ``ptr[d]:ptr[d+1]`` are the words of text d."""

    first: int
    n: int
    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    ptr: np.ndarray
    offs: np.ndarray

    def hashes(self) -> np.ndarray:
        return _range_hash(self.buf.astype(np.uint64) + np.uint64(1), self.starts, self.ends)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.ptr))

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]].tobytes()



def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words (runs across texts; mask by ptr)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    lo = np.arange(n)
    return _range_hash(words, lo, lo + size)


def window_ok(ptr: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Which of the windows starting at each word lie inside one text."""
    n = max(0, n_words - size + 1)
    room = np.repeat(ptr[1:], np.diff(ptr))[:n]
    return np.arange(n) + size <= room


def grids(texts: pa.Array, sep: np.ndarray, lower: bool = False, piece: int = PIECE_BYTES) -> Iterator[Grid]:
    """The grids of an Arrow string array; a null text counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None and offs[-1] else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + piece, side="right")) - 1)
        buf = data[offs[lo]:offs[hi]]
        buf = LOWER[buf] if lower else buf
        yield grid(buf, offs[lo:hi + 1] - offs[lo], sep, lo)
        lo = hi


def grid(buf: np.ndarray, offs: np.ndarray, sep: np.ndarray, first: int = 0) -> Grid:
    inside = ~sep[buf]
    n = len(buf)
    new = inside.copy()
    new[1:] &= ~inside[:-1]
    edge = offs[:-1][offs[:-1] < n]
    new[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = offs[1:][offs[1:] > 0] - 1
    last[edge] = inside[edge]
    starts, ends = np.flatnonzero(new), np.flatnonzero(last) + 1
    return Grid(first, len(offs) - 1, buf, starts, ends, np.searchsorted(starts, offs), offs)


def text_grid(texts: list[bytes], sep: np.ndarray, lower: bool = False) -> Grid:
    """The grid of a list of UTF-8 texts, whole."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    return grid(LOWER[buf] if lower else buf, offs, sep)
