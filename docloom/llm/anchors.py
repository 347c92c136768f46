"""Cutting documents at anchors, so that equal 200-byte windows meet.

The anchor of a window is the place of its smallest hashed 32-byte gram, the
leftmost on ties. It depends on the window's bytes alone: equal windows have
equal anchors at equal distances. Consecutive windows with one anchor form a
segment, on average 85 windows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from docloom.llm.shingles import _BASE, _INVERSE, _ODD, _powers, mixed

WINDOW, GRAM = 200, 32
#: A segment's place: byte offset in the document times PLACE plus its number of windows.
PLACE = 512
_LOW = np.uint64((1 << 24) - 1)


@lru_cache(maxsize=1)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, n), _powers(_INVERSE, n)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(n - 1, 1 << 20).bit_length()
    return _tables(size)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    shape = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(shape, axis=1).ravel()
    back = np.minimum.accumulate(shape[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """``(text number, anchor hash, segment hash, place)`` of all segments of some texts.

    Texts together are to stay under 16 MB unless a single one is longer; that
    one is cut into overlapping stretches with the same segments.
    """
    out = []
    if len(texts) == 1 and len(texts[0]) > _LOW // 2:
        return _long_text(texts[0])
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    n = len(data)
    if n < WINDOW or not (lengths >= WINDOW).any():
        none = np.zeros(0, np.int64)
        return none, none, none, none
    powers, inverse = _power_tables(n + 1)
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=summed[1:])
    grams = mixed((summed[GRAM:] - summed[:-GRAM]) * inverse[: n + 1 - GRAM])
    tagged = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    least = (_sliding_min(tagged, WINDOW - GRAM + 1) & _LOW).astype(np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    # Windows inside a document, as runs [starts, starts + length - 199).
    count = np.maximum(lengths - WINDOW + 1, 0)
    inside = np.zeros(len(least) + 1, np.int8)
    np.add.at(inside, starts[count > 0], 1)
    np.add.at(inside, (starts + count)[count > 0], -1)
    valid = np.cumsum(inside[:-1]).astype(bool)
    opens = valid.copy()
    opens[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    begin = np.flatnonzero(opens)
    number = np.searchsorted(starts, begin, side="right") - 1
    end = np.minimum(np.append(begin[1:], n), (starts + count)[number])
    windows = end - begin
    hashed = mixed((summed[end + WINDOW - 1] - summed[begin]) * inverse[begin] + windows.astype(np.uint64) * _ODD[2])
    place = (begin - starts[number]) * PLACE + windows
    out = number, grams[least[begin]].view(np.int64), hashed.view(np.int64), place
    return out


def _long_text(text: bytes) -> tuple[np.ndarray, ...]:
    """Stretches overlap by one window less a byte: no window is lost or seen twice.

    A segment at a stretch's edge may come in two parts with their own hashes;
    that leaves the windows, and so the result, as they are.
    """
    step, parts = 1 << 22, []
    for low in range(0, len(text) - WINDOW + 1, step):
        _, anchor, hashed, place = segments([text[low : low + step + WINDOW - 1]])
        parts.append((anchor, hashed, place + low * PLACE))
    anchor, hashed, place = (np.concatenate(c) for c in zip(*parts))
    return np.zeros(len(anchor), np.int64), anchor, hashed, place
