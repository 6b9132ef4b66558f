"""Word shingles of whole texts as sets of 64-bit hashes, vectorised with numpy.

A text is handled as its UTF-8 bytes.  Words are the maximal runs of bytes other than space
and 0x09-0x0D; only A-Z is lower-cased.  No byte of a multi-byte character equals one of
these, so bytes and characters give the same words.

A word's hash is a polynomial over its bytes taken from one running sum over the text, so a
text costs a fixed number of vector operations whatever its number of words.
"""

from __future__ import annotations

import numpy as np

# Odd multiplier of the running polynomial (mod 2**64) and the finalizer's constants.
_BASE = 0x9E3779B97F4A7C15
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective, so it never merges two hashes)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the multiplier and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.n = 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 1 << 14)
            self.up = _powers(_BASE, self.n)
            self.down = _powers(pow(_BASE, -1, 1 << 64), self.n)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_hashes(text: bytes) -> np.ndarray:
    """The hash of each word of a text in order."""
    if len(text) <= _BLOCK:
        return _word_hashes(text)
    # Very long texts go block by block, each block ending at white space where there is any.
    out, at = [], 0
    raw = np.frombuffer(text, dtype=np.uint8)
    while at < len(text):
        end = min(len(text), at + _BLOCK)
        while end < len(text):
            spaces = np.flatnonzero(_SPACE[raw[max(at, end - _BLOCK):end]])
            if len(spaces):
                end = max(at, end - _BLOCK) + int(spaces[-1]) + 1
                break
            end = min(len(text), end + _BLOCK)
        out.append(_word_hashes(text[at:end]))
        at = end
    return np.concatenate(out)


def _word_hashes(text: bytes) -> np.ndarray:
    raw = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    word = np.empty(len(raw) + 2, dtype=bool)
    word[0] = word[-1] = False
    np.logical_not(_SPACE[raw], out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    if not len(edges):
        return np.empty(0, dtype=np.uint64)
    start, end = edges[::2], edges[1::2]
    up, down = _POWERS.get(len(raw) + 1)
    total = np.empty(len(raw) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _M2)


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of a text's k-word shingles.

    Fewer than k words: the whole sequence is one shingle.  No word or no text: empty.
    """
    words = word_hashes(text) if text else np.empty(0, dtype=np.uint64)
    if not len(words):
        return words
    width = min(k, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = mix(out * np.uint64(_BASE) + words[i:i + n])
    return np.unique(out)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


class MinHash:
    """Signatures of ``size`` 32-bit minima under multiply-add-mix functions of one seed."""

    def __init__(self, size: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.mul = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        self.size = size

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.empty(self.size, dtype=np.uint64)
        for i in range(self.size):
            out[i] = (hashes * self.mul[i] + self.add[i]).min()
        return (out >> np.uint64(32)).astype(np.uint32)
