"""Word-shingle sets as arrays of 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np

WORDS = 4
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Fixed odd constants for hashing.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ODD = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: list[str | None], size: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles.

    A-Z are lower-cased; words are separated by blanks and U+0009 to U+000D. A
    text with fewer words than ``size`` has one shingle, without words none.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b"\n".join([b"", *encoded, b""]), np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin, end = edge[0::2], edge[1::2]
    summed = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), dtype=np.uint64)
    words = (summed[end - 1] - summed[begin - 1]) * _powers(_INVERSE, len(data))[begin]
    words = mixed(words + (end - begin).astype(np.uint64) * _ODD[0])
    ends = np.cumsum([len(e) + 1 for e in encoded]) if encoded else np.zeros(0, int)
    upto = np.searchsorted(begin, ends)
    odd = np.concatenate([_ODD, mixed(np.arange(4, max(size, 4), dtype=np.uint64) * _BASE) | np.uint64(1)])
    if len(words) >= size:
        whole = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            whole += words[k : len(words) - size + 1 + k] * odd[k]
        whole = mixed(whole)
    sets, low = [], 0
    for high in upto.tolist():
        n = high - low
        if n >= size:
            sets.append(np.unique(whole[low : high - size + 1]))
        elif n:
            sets.append(mixed(np.add.reduce(words[low:high] * odd[:n], keepdims=True) + np.uint64(n)))
        else:
            sets.append(np.zeros(0, np.uint64))
        low = high
    return sets


def sketch(items: np.ndarray, bins: int) -> np.ndarray:
    """A fast similarity sketch: ``bins`` values of which sets share a share equal to their similarity.

    Round i < bins hashes every item to a bin and a value; round i >= bins
    hashes every item into bin i - bins alone, so every bin fills. A bin keeps
    the smallest value of the first round that reaches it, tagged with it.
    ``bins`` is a power of two; ``items`` is not empty.
    """
    shift = np.uint64(64 - bins.bit_length() + 1)
    out = np.zeros(bins, np.uint64)
    empty = np.ones(bins, bool)
    at, left = 0, bins
    while left and at < bins:
        rounds = min(bins - at, max(1, 4096 // len(items)))
        tags = np.arange(at, at + rounds, dtype=np.uint64)
        hashed = mixed(items[None, :] ^ mixed(tags * _BASE + _ODD[1])[:, None])
        for tag, row in zip(tags, np.sort(hashed, axis=1)):
            place = (row >> shift).astype(np.intp)
            first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            first = first[empty[place[first]]]
            out[place[first]] = (row[first] << np.uint64(9)) | tag
            empty[place[first]] = False
            left -= len(first)
            if not left:
                break
        at += rounds
    for bin_ in np.flatnonzero(empty):
        tag = np.array([bins + bin_], np.uint64)
        out[bin_] = (mixed(items ^ mixed(tag * _BASE + _ODD[1])).min(keepdims=True) << np.uint64(9) | tag)[0]
    return out


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
