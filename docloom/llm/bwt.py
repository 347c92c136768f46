"""Burrows-Wheeler transforms of shards, merged by refining their interleave.

A shard holds strings, each with an end mark, and the transform of its sorted
suffixes. Two transforms are merged without a look at the sorted suffixes: the
interleave starts as the runs of suffixes that agree on their first ``START``
symbols. Each round steps back once: a run that was cut off in the round before
goes, for each symbol its transform holds, to the run one symbol longer, by
counts of that symbol in both transforms. If the end of that run is not yet
marked, its neighbours share exactly as many symbols as rounds have passed:
that is their common prefix. Runs with a marked end are settled, so every place
between two suffixes is visited once. Runs of length ``depth`` are the repeated
intervals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols of 9 bits that fit one number: byte + 1, or 0 at a string's end.
START, BITS = 7, 9


@dataclass
class Shard:
    data: np.ndarray  # symbols of all strings, each with its end mark
    order: np.ndarray  # all places, by their first symbols up to the depth
    transform: np.ndarray  # symbol before each of them, 0 at a string's start
    keys: np.ndarray  # their first START symbols as one number


@dataclass
class Merged:
    shard: Shard
    interleave: np.ndarray  # for each suffix in merged order: False if it comes from the first shard
    common: np.ndarray  # symbols it shares with its predecessor; -1 for the depth or more


def _left(data: np.ndarray) -> np.ndarray:
    """Bytes from each place to the end of its string."""
    ends = np.flatnonzero(data == 0)
    return np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(len(data))


def _keys(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The first START symbols from each place as one number."""
    keys = np.zeros(len(data), np.int64)
    wide = data.astype(np.int64)
    for k in range(START):
        keys[: max(len(data) - k, 0)] |= wide[k:] << (BITS * (START - 1 - k))
    short = np.flatnonzero(left < START - 1)  # symbols of the next string do not count
    keys[short] &= np.int64(-1) << (BITS * (START - 1 - left[short]))
    return keys


def _fresh(values: np.ndarray) -> np.ndarray:
    """Where a value differs from its predecessor."""
    return np.append(True, values[1:] != values[:-1])[: len(values)]


def _sorting(values: np.ndarray, top: int) -> np.ndarray:
    """Stable order of values from 0 to ``top``; where value and place fit one number, numbers are sorted, which is faster."""
    bits = len(values).bit_length()
    if top.bit_length() + bits > 63:
        return np.argsort(values, kind="stable")
    packed = values.astype(np.int64) << bits
    packed |= np.arange(len(values))
    packed.sort()
    packed &= (1 << bits) - 1
    return packed


def shard(strings: list[bytes], depth: int) -> Shard:
    """Sort the suffixes of some strings by their first ``depth`` symbols and derive the transform."""
    marks = np.cumsum([len(s) + 1 for s in strings], dtype=np.int64) - 1
    data = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.uint16) + np.uint16(1)
    data[marks] = 0
    n, left = len(data), _left(data)
    keys = _keys(data, left)
    order = np.argsort(keys)
    keys = keys[order]
    fresh = _fresh(keys)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    open_ = np.flatnonzero(~(fresh & np.append(fresh[1:], True)[:n]))
    reached = START
    while reached < depth:
        open_ = open_[left[order[open_]] >= reached]  # equal suffixes that ended stay together
        if not len(open_):
            break
        jump = min(reached, depth - reached)
        here = order[open_]
        both = rank[here] * n + rank[here + jump]
        by = _sorting(both, n * n)
        here, both = here[by], both[by]
        order[open_] = here
        split = _fresh(both)
        rank[here] = np.maximum.accumulate(np.where(split, open_, 0))
        open_ = open_[~(split & np.append(split[1:], True))]
        reached += jump
    return Shard(data, order, data[order - 1], keys)


class _Steps:
    """Steps back in one shard: from rows of suffixes to rows of suffixes one symbol longer."""

    def __init__(self, part: Shard) -> None:
        self.symbols, self.n = part.transform, len(part.transform)
        by = np.argsort(self.symbols, kind="stable")
        self.back = np.empty(self.n, np.int32)
        self.back[by] = np.arange(self.n, dtype=np.int32)
        self.counted = self.symbols[by].astype(np.int64) * (self.n + 1) + by
        self.run = np.cumsum(_fresh(self.symbols), dtype=np.int32)

    def longer(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(run, symbol, low, high)`` of the non-empty runs one symbol longer, for runs of rows."""
        some = np.flatnonzero(high > low)
        a, z = low[some], high[some] - 1
        one = self.run[a] == self.run[z]
        run, symbol, lows, highs = some[one], self.symbols[a[one]].astype(np.int64), self.back[a[one]], self.back[z[one]]
        rest = some[~one]
        if len(rest):
            size = high[rest] - low[rest]
            rows = np.arange(size.sum()) + np.repeat(low[rest] - np.cumsum(size) + size, size)
            key = (np.repeat(rest, size) << BITS) | self.symbols[rows]
            by = _sorting(key, len(low) << BITS)
            key, rows = key[by], rows[by]
            begins = np.flatnonzero(_fresh(key))
            ends = np.append(begins[1:], len(key)) - 1
            run = np.concatenate([run, key[begins] >> BITS])
            symbol = np.concatenate([symbol, key[begins] & ((1 << BITS) - 1)])
            lows = np.concatenate([lows, self.back[rows[begins]]])
            highs = np.concatenate([highs, self.back[rows[ends]]])
        goes = symbol > 0
        return run[goes], symbol[goes], lows[goes], highs[goes] + 1

    def before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Row at which suffixes of ``symbol`` and then those from ``row`` on begin."""
        return np.searchsorted(self.counted, symbol * (self.n + 1) + row)


def _filled(steps: _Steps, keys: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the runs ``keys`` in one shard, which has those ``at`` some places; others are empty there."""
    lows, highs = np.full(len(keys), -1), np.full(len(keys), -1)
    lows[at], highs[at] = low, high
    none = np.flatnonzero(lows < 0)
    symbol, run = np.divmod(keys[none], len(parent))
    lows[none] = highs[none] = steps.before(symbol, parent[run])
    return lows, highs


def merge(a: Shard, b: Shard, depth: int) -> Merged:
    """The transform of both shards, with common prefixes below ``depth``."""
    first, second = _Steps(a), _Steps(b)
    n = first.n + second.n
    common = np.full(n + 1, -1, np.int16)
    taken = np.zeros(n + 1, np.int32)  # suffixes of the first shard before each marked place
    common[0] = common[n] = 0
    taken[n] = first.n

    starts = np.sort(np.concatenate([s.keys[_fresh(s.keys)] for s in (a, b)]))
    starts = starts[_fresh(starts)]
    high_a, high_b = (np.searchsorted(s.keys, starts, "right") for s in (a, b))
    low_a, low_b = np.append(0, high_a[:-1])[: len(starts)], np.append(0, high_b[:-1])[: len(starts)]
    apart = starts[1:] ^ starts[:-1]
    same = sum(((apart < (1 << (BITS * (START - k)))).astype(np.int16) for k in range(1, START)), np.zeros(len(apart), np.int16))
    at = (high_a + high_b)[:-1]
    common[at], taken[at] = same, high_a[:-1]
    fresh = np.flatnonzero(same == START - 1)

    reached = START
    while reached < depth and len(fresh):
        low_a, high_a, low_b, high_b = low_a[fresh], high_a[fresh], low_b[fresh], high_b[fresh]
        run_a, symbol_a, from_a, to_a = first.longer(low_a, high_a)
        run_b, symbol_b, from_b, to_b = second.longer(low_b, high_b)
        keys = np.concatenate([symbol_a, symbol_b]) * len(low_a) + np.concatenate([run_a, run_b])
        by = _sorting(keys, len(low_a) << BITS)
        new = _fresh(keys[by])
        place = np.empty(len(keys), np.int64)
        place[by] = np.cumsum(new) - 1
        keys = keys[by[new]]
        (low_a, high_a), (low_b, high_b) = (
            _filled(first, keys, place[: len(run_a)], from_a, to_a, low_a),
            _filled(second, keys, place[len(run_a) :], from_b, to_b, low_b),
        )
        at = high_a + high_b
        fresh = np.flatnonzero(common[at] < 0)
        common[at[fresh]], taken[at[fresh]] = reached, high_a[fresh]
        reached += 1

    marked = np.flatnonzero(common >= 0)
    of_a = np.diff(taken[marked])
    sizes = np.stack([of_a, np.diff(marked) - of_a], 1).ravel()
    interleave = np.repeat(np.tile([False, True], len(of_a)), sizes)
    order, transform, keys = np.empty(n, np.int64), np.empty(n, np.uint16), np.empty(n, np.int64)
    for part, mine, offset in ((a, ~interleave, 0), (b, interleave, first.n)):
        order[mine], transform[mine], keys[mine] = part.order + offset, part.transform, part.keys
    return Merged(Shard(np.concatenate([a.data, b.data]), order, transform, keys), interleave, common[:n])


def merge_all(shards: list[Shard], depth: int) -> Merged:
    """All shards, neighbours first; a single one is merged with an empty one."""
    if len(shards) == 1:
        return merge(shards[0], shard([], depth), depth)
    while len(shards) > 2:
        pairs = [shards[k : k + 2] for k in range(0, len(shards), 2)]
        shards = [merge(*p, depth).shard if len(p) == 2 else p[0] for p in pairs]
    return merge(*shards, depth)


def repeated_places(strings: list[bytes], depth: int, shard_bytes: int = 3 << 18) -> list[np.ndarray]:
    """For each string, the places whose next ``depth`` bytes occur at another place too; ``depth`` is START or more."""
    shards, some, held = [], [], 0
    for string in strings:
        some.append(string)
        held += len(string)
        if held >= shard_bytes:
            shards.append(shard(some, depth))
            some, held = [], 0
    if some:
        shards.append(shard(some, depth))
    if not shards:
        return []
    merged = merge_all(shards, depth)
    equal = merged.common < 0
    again = equal | np.append(equal[1:], False)
    order = merged.shard.order[again]
    order = np.sort(order[_left(merged.shard.data)[order] >= depth])
    ends = np.cumsum([len(s) + 1 for s in strings])
    cut = np.searchsorted(order, ends)
    return [found - end + len(s) + 1 for found, end, s in zip(np.split(order, cut[:-1]), ends, strings)]
