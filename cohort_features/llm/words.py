"""Words, shingles and their 64-bit hashes inside a task.

A word's hash is a polynomial over its bytes, taken from prefix sums over the
whole text; shingle hashes are mixed from word hashes. All of it is numpy,
nothing loops over words in Python. All hashes are fixed functions of the
bytes: every worker gets the same.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (other letters kept).

    ``bytes.lower`` and ``bytes.split`` touch ASCII only, which is exactly
    that rule on UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 15
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse (mod 2^64), n + 1 of each."""
    if not _powers or len(_powers[0]) <= n:
        size = max(_BLOCK, n) + 1
        new = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            new.append(np.cumprod(p, dtype=np.uint64))
        if n > _BLOCK:  # one word longer than a block: not kept
            return new
        _powers[:] = new
    return _powers


def _block_word_hashes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block of bytes, and where they start."""
    edge = np.empty(len(b) + 1, dtype=bool)
    space = _SPACE[b]
    edge[0], edge[-1] = not space[0], not space[-1]
    np.not_equal(space[1:], space[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    start, end = at[::2], at[1::2]
    power, inverse = _power_tables(len(b))
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[b] * power[: len(b)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] ^ (end - start).astype(np.uint64)), start


def _byte_word_hashes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_block_word_hashes`` for any number of bytes, A-Z lower-cased."""
    out, at, i = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)], 0
    while i < len(b):
        j = i + _BLOCK
        if j < len(b):
            gaps = np.flatnonzero(_SPACE[b[i:j]])
            if len(gaps):
                j = i + int(gaps[-1]) + 1
            else:  # a word longer than a block
                gaps = np.flatnonzero(_SPACE[b[j:]])
                j = j + int(gaps[0]) if len(gaps) else len(b)
        h, start = _block_word_hashes(b[i:j])
        out.append(h)
        at.append(start + i)
        i = j
    return (out[1], at[1]) if len(out) == 2 else (np.concatenate(out), np.concatenate(at))


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text in order, A-Z
    lower-cased (``bytes.lower`` touches ASCII only). Long texts go in blocks
    that end at white space, so memory stays in proportion to the text."""
    return _byte_word_hashes(np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8))[0]


def word_hashes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of several texts, one after the other, and how many
    words each has. Short texts take less time so than one by one."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    h, start = _byte_word_hashes(np.frombuffer(b"\n".join(parts).lower(), dtype=np.uint8))
    ends = np.cumsum([len(p) + 1 for p in parts])
    return h, np.diff(np.searchsorted(start, ends), prepend=0)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order, repeats included; the
    whole sequence as one shingle when there are fewer words; empty if none."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(size, n)
    out = hashes[: n - k + 1].copy()
    for i in range(1, k):
        out = mix(out) * U(0x9E3779B97F4A7C15) + hashes[i : n - k + 1 + i]
    return mix(out ^ U(k))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(shingles(word_hashes(text), size))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers drawn by rule from ``seed``."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


def minima(hashes: np.ndarray, multipliers: np.ndarray, block: int = 512) -> np.ndarray:
    """Minimum of ``multiplier * hash`` (mod 2^64) per multiplier, in blocks,
    so that memory stays bounded for very long texts. Mergeable by minimum."""
    low = np.full(len(multipliers), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), block):
        np.minimum(low, (multipliers[:, None] * hashes[None, i : i + block]).min(axis=1), out=low)
    return low


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as the signed longs that Spark holds."""
    return x.view(np.int64)
