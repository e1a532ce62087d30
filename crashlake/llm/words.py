"""Words of whole Arrow batches as 64-bit hashes, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; arrays of this many longs are the memory a batch takes.
CHUNK = 1 << 21
BASE = 0x9E3779B97F4A7C15 | 1
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
#: Bytes of words: anything but white space; or ASCII letters and digits and all else beyond ASCII.
PLAIN = ~SPACES
ALNUM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK + 2), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        _POWERS[base] = have
    return have[:n]


INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and the offsets of each; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def slices(texts: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes together; a longer text stands alone."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, at = text_bytes(texts)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(at, at[low] + most, "right")) - 1)
        yield low, high
        low = high


def word_hashes(texts: pa.Array, word: np.ndarray = PLAIN) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with A-Z lowered, and the offsets of each text's words among them."""
    data, at = text_bytes(texts)
    hashes, starts = [], []
    low, cuts = 0, at[:-1][np.diff(at) > 0]
    while low < len(data):
        high = min(len(data), low + CHUNK)
        while high < len(data):  # a chunk ends where no word does
            free = np.flatnonzero(~word[data[low:high]])
            if len(free):
                high = low + int(free[-1]) + 1
                break
            high = min(len(data), high + CHUNK)
        part = data[low:high]
        inside = np.zeros(len(part) + 2, bool)
        inside[1:-1] = word[part]
        own = cuts[np.searchsorted(cuts, low):np.searchsorted(cuts, high)] - low
        edge = np.zeros(len(part) + 1, bool)
        edge[own] = True
        begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((LOWER[part] + np.uint64(1)) * powers(len(part)), dtype=np.uint64, out=sums[1:])
        hashes.append(mix((sums[end] - sums[begin]) * powers(len(part) + 1, INVERSE)[begin]
                          + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts.append(begin + low)
        low = high
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), at)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    total = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        total = total * np.uint64(BASE) + hashes[k:k + len(total)]
    return mix(total + np.uint64(n))
