"""Vectorised hashing of words and shingles over whole batches of texts (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of ASCII letters and of all other characters above 0x7F: what a word of letters is made of.
NOT_LETTER = np.ones(256, dtype=bool)
NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
SALTS = mix(np.arange(101, 133, dtype=U64)) | U64(1)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i < n; grown by doubling and kept."""
    kept = _powers.get(base)
    if kept is None:
        kept = np.ones(1, dtype=U64)
    while len(kept) < n:
        kept = np.concatenate([kept, kept * U64(pow(base, len(kept), 1 << 64))])
    _powers[base] = kept
    return kept[:n]


def chunks(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes together; a longer text is a range of its own."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def words(texts: list[bytes], breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lowered; cut at the bytes in ``breaks``) and where each text's words
    begin, with the end as last entry."""
    joined = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    ends_at = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    cut = breaks[joined]
    code = np.where(cut, U64(0), BYTE_CODE[LOWER[joined]])
    total = np.concatenate([[U64(0)], np.cumsum(code * powers(BASE, len(joined)), dtype=U64)])
    before = np.concatenate([[True], cut[:-1]])
    start = np.flatnonzero(~cut & before)
    after = np.concatenate([cut[1:], [True]])
    stop = np.flatnonzero(~cut & after) + 1
    hashed = mix((total[stop] - total[start]) * powers(INVERSE, len(joined))[start])
    return hashed, np.concatenate([[0], np.searchsorted(start, ends_at)])


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles; a shorter text is one shingle
    of its own length, a text without words none."""
    for first, last in chunks(texts):
        hashed, begin = words(texts[first:last])
        rolled = np.zeros(max(0, len(hashed) - size + 1), dtype=U64)
        for k in range(size):
            rolled += hashed[k:len(rolled) + k] * SALTS[k]
        rolled = mix(rolled)
        for low, high in zip(begin[:-1], begin[1:]):
            n = high - low
            if n >= size:
                yield np.unique(rolled[low:high - size + 1])
            elif n:
                one = (hashed[low:high] * SALTS[:n]).sum(dtype=U64, keepdims=True)
                yield mix(one + SALTS[31:] * U64(n))
            else:
                yield np.zeros(0, dtype=U64)
