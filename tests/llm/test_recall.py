"""Share of planted pairs just above the limit that reach verification."""

from __future__ import annotations

import numpy as np

from docloom.llm.minhash import BAND, BINS, MIN_EQUAL
from docloom.llm.shingles import mixed, shared, sketch


def found(rng: np.random.Generator, size: int, percent: int) -> bool:
    """Whether a pair of sets of ``size`` with at least ``percent`` similarity shares a band and enough values."""
    both = -(-2 * size * percent // (100 + percent))
    items = mixed(rng.integers(0, 1 << 63, 2 * size - both, dtype=np.uint64))
    a, b = np.sort(items[:size]), np.sort(items[size - both :])
    assert 100 * shared(a, b) >= percent * len(items) and shared(a, b) == both
    x, y = sketch(a, BINS), sketch(b, BINS)
    band = (x == y).reshape(-1, BAND).all(1).any()
    return bool(band and (mixed(x).astype(np.uint16) == mixed(y).astype(np.uint16)).sum() >= MIN_EQUAL)


def recall(pairs: int) -> float:
    rng = np.random.default_rng(11)
    return float(np.mean([found(rng, int(rng.integers(40, 1500)), int(rng.integers(80, 86))) for _ in range(pairs)]))


def test_pairs_just_above_the_limit_are_verified():
    assert recall(3_000) >= 0.999
