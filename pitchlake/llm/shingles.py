"""Word shingles of texts as sorted sets of 64-bit hashes, vectorised with numpy.

A word is a run of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z.  A text of
``WIDTH`` words or more has its distinct ``WIDTH``-word shingles; a shorter
one has its whole word sequence as one shingle; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WIDTH = 5
#: Texts are hashed together up to so many bytes (a longer text alone).
CHUNK_BYTES = 1 << 20

_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts, and the number of words of each text."""
    a = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    solid = ~_BREAK[a]
    b = a[solid]
    ends = np.cumsum([len(t) + 1 for t in texts])
    if not len(b):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    at = np.flatnonzero(first)                          # byte where a word begins
    start = np.flatnonzero(first[solid])                # the same, among solid bytes
    length = np.diff(np.append(start, len(b)))
    place = np.arange(len(b)) - np.repeat(start, length)
    h = np.add.reduceat(_BYTE[b] * powers(int(length.max()))[place], start)
    counts = np.diff(np.append(0, np.searchsorted(at, ends)))
    return mix(h + length.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), counts


def _chunks(texts: Iterable[str | None]) -> Iterator[list[bytes]]:
    chunk, n = [], 0
    for t in texts:
        b = (t or "").encode("utf-8", "surrogatepass").lower()
        if chunk and n + len(b) > CHUNK_BYTES:
            yield chunk
            chunk, n = [], 0
        chunk.append(b)
        n += len(b)
    if chunk:
        yield chunk


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for chunk in _chunks(texts):
        h, counts = word_hashes(chunk)
        whole = np.zeros(len(h), np.uint64)
        padded = np.append(h, np.zeros(WIDTH, np.uint64))
        for k in range(WIDTH):
            whole += padded[k:k + len(h)] * _PLACE[k]
        whole = mix(whole)
        ends = np.cumsum(counts)
        for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
            if n >= WIDTH:
                yield np.unique(whole[end - n:end - WIDTH + 1])
            elif n:
                few = (h[end - n:end] * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
                yield mix(np.array([few], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
