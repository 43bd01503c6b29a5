"""Words and shingles of whole Arrow batches as numpy arrays: no Python loop over words.

A word is a maximal run of bytes of a class.  Its hash is a polynomial in the bytes modulo 2**64 read off one running
sum over the buffer, then mixed; a shingle's hash is a polynomial in its words' hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes of text handled at once; a longer text is handled whole
_rng = np.random.default_rng(20240229)
_TABLES = [_rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
_BASES = [0x9E3779B97F4A7C15, 0xD1B54A32D192ED03]
_MULT = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]

_SPACE = np.ones(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x61:0x7B] = _ALNUM[0x41:0x5B] = _ALNUM[0x80:] = True
CLASSES = {"space": _SPACE, "alnum": _ALNUM}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(k: int, inverse: bool, n: int) -> np.ndarray:
    """base**i (or its inverse) for i < n, modulo 2**64; kept, and grown when a longer buffer comes."""
    have = _powers.get((k, inverse))
    if have is None or len(have) < n:
        base = _BASES[k] if not inverse else pow(_BASES[k], -1, 2**64)
        p = np.full(max(n, CHUNK + 1), base, np.uint64)
        p[0] = 1
        _powers[k, inverse] = have = np.cumprod(p)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (all bits of the input reach all bits of the output)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Chunk:
    """Rows lo..hi of a batch: their bytes, and words as ``start``, ``end`` (in ``buf``), ``row`` (0 = lo)."""

    def __init__(self, lo: int, hi: int, buf: np.ndarray, offsets: np.ndarray, kind: str, lower: bool):
        self.lo, self.hi, self.buf, self.offsets = lo, hi, buf, offsets
        if lower:
            self.buf = buf = _LOWER[buf]
        inside = CLASSES[kind][buf]
        first = np.zeros(len(buf) + 1, bool)
        first[offsets] = True  # a word ends with its row
        before = np.empty(len(buf), bool)
        if len(buf):
            before[0], before[1:] = False, inside[:-1]
        self.start = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.zeros(len(buf), bool)
        after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.row = np.searchsorted(offsets[1:], self.start, side="right")
        self.count = np.bincount(self.row, minlength=hi - lo)
        self.bound = np.concatenate([[0], np.cumsum(self.count)])  # words of row r: bound[r]..bound[r+1]

    def hashes(self, k: int = 0) -> np.ndarray:
        n = len(self.buf)
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLES[k][self.buf] * _power(k, False, n), out=run[1:])
        return mix((run[self.end] - run[self.start]) * _power(k, True, n + 1)[self.start] + (self.end - self.start).astype(np.uint64))

    def shingles(self, word_hash: np.ndarray, n: int, k: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each position, and whether they lie in one row; both as long as the words."""
        m = len(word_hash)
        out, fits = np.zeros(m, np.uint64), np.zeros(m, bool)
        if m >= n:
            acc = np.zeros(m - n + 1, np.uint64)
            for i in range(n):
                acc = acc * _MULT[k] + word_hash[i:m - n + 1 + i]
            out[:m - n + 1] = mix(acc)
            fits[:m - n + 1] = self.row[:m - n + 1] == self.row[n - 1:]
        return out, fits

    def word_bytes(self, r: int) -> list[bytes]:
        b = self.buf.tobytes() if not hasattr(self, "_raw") else self._raw
        self._raw = b
        return [b[s:e] for s, e in zip(self.start[self.bound[r]:self.bound[r + 1]].tolist(), self.end[self.bound[r]:self.bound[r + 1]].tolist())]


def chunks(column: pa.Array, kind: str, lower: bool, size: int = CHUNK):
    """Cut a string column into chunks of about ``size`` bytes; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if n and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield Chunk(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], kind, lower)
        lo = hi


def slide_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of a[i:i+width], for every full frame, in about log2(width) vector steps."""
    have, cur = 1, a
    while have < width:
        step = min(have, width - have)
        cur = np.minimum(cur[:len(cur) - step], cur[step:])
        have += step
    return cur
