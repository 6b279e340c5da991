"""Words of many texts at once as numpy arrays: bounds, owners and 64-bit hashes.

A word is ``[^\\x20\\x09-\\x0D]+``. Hashes are polynomial sums modulo 2^64 over random byte values, taken from prefix
sums, so any byte range has its hash in constant time; a final mix spreads them. With ``fold`` the letters A-Z
hash as a-z.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_RAW = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_FOLDED = _RAW.copy()
_FOLDED[65:91] = _RAW[97:123]
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The first n powers of the base or of its inverse; kept and doubled when short."""
    have = _powers[kind]
    step = _BASE if kind == "up" else _INVERSE
    while len(have) < n:
        factor = np.uint64(pow(int(step), len(have), 1 << 64))
        have = np.concatenate([have, have * factor])
    if len(have) <= 1 << 23:  # the tables of one very long text are not kept
        _powers[kind] = have
    return have


class Words:
    """start and end (bytes in ``buf``), doc (index of the text) and hash of every word; first[d]:first[d+1] are those of text d."""

    def __init__(self, texts: list[bytes], fold: bool = True, hashes: bool = True):
        self.n_docs = len(texts)
        raw = b"\n" + b"\n".join(texts) + b"\n"
        self.raw = raw
        self.buf = np.frombuffer(raw, np.uint8)
        lengths = np.fromiter((len(x) for x in texts), np.int64, len(texts))
        self.doc_start = 1 + np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
        self.doc_end = self.doc_start + lengths
        self.space = SPACE[self.buf]
        edges = np.flatnonzero(self.space[1:] != self.space[:-1]) + 1
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.start, np.append(self.doc_start, len(raw)))
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(self.first))
        if hashes:
            self.prefix = prefix_sums(self.buf, _FOLDED if fold else _RAW)
            self.hash = range_hash(self.prefix, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-word runs inside one text, and the index of the first word of each."""
        at = np.flatnonzero(self.doc[n - 1 :] == self.doc[: len(self.doc) - n + 1]) if len(self) >= n else np.zeros(0, np.int64)
        h = np.zeros(len(at), np.uint64)
        for k in range(n):
            h = mix(h * np.uint64(3) + self.hash[at + k])
        return h, at


def prefix_sums(buf: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(values[buf] * _power("up", len(buf))[: len(buf)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range; equal bytes give equal hashes wherever they stand. Never 0 in practice."""
    down = _power("down", len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i+1]], 0 for empty ranges."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def code_points(buf: np.ndarray) -> np.ndarray:
    """prefix[i]: code points that begin before byte i."""
    return np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])


class Lookup:
    """Integer keys to non-negative values as an open hash table that takes arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int64)
        at, left = (mix(keys) >> self.shift).astype(np.int64), np.arange(len(keys))
        while left.size:
            free = left[self.values[at[left]] < 0]
            self.keys[at[free]], self.values[at[free]] = keys[free], values[free]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self.mask

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        keys = keys.astype(np.uint64, copy=False)
        at = (mix(keys) >> self.shift).astype(np.int64)
        out = self.values[at]
        wrong = np.flatnonzero((out >= 0) & (self.keys[at] != keys))
        while wrong.size:
            at[wrong] = (at[wrong] + 1) & self.mask
            out[wrong] = self.values[at[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.keys[at[wrong]] != keys[wrong])]
        return out
