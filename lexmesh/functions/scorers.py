"""Text scorers in 0..100 built on the longest common subsequence, applied to Arrow batches of pairs.

Nulls count as empty texts. Two empty texts score 0 in ``quick_ratio`` and
``weighted_ratio`` and 100 elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a word of bits for all of ``a`` at once."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & at.get(y, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths."""
    whole = len(a) + len(b)
    return 200.0 * common_length(a, b) / whole if whole else 100.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text with a window of the longer one, windows cut off at the ends included."""
    small, big = sorted((a, b), key=len)
    n = len(small)
    if not n:
        return 100.0 if not big else 0.0
    return max(ratio(small, big[max(0, i) : i + n]) for i in range(1 - n, len(big)))


def _tokens(text: str) -> list[str]:
    return sorted(text.split())


def token_sort_ratio(a: str, b: str, score: Callable[[str, str], float] = ratio) -> float:
    return score(" ".join(_tokens(a)), " ".join(_tokens(b)))


def token_set_ratio(a: str, b: str, score: Callable[[str, str], float] = ratio) -> float:
    """The best of comparing the shared words, and either side's words after the shared ones; 100 if one side's words are all shared."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    base, one, other = " ".join(both), " ".join([*both, *left]), " ".join([*both, *right])
    return max([score(one, other), *([score(base, one), score(base, other)] if both else [])])


def quick_ratio(a: str, b: str) -> float:
    return ratio(a, b) if a and b else 0.0


def weighted_ratio(a: str, b: str) -> float:
    """The best of the plain ratio and weighted word and window ratios; windows count where lengths differ by half or more."""
    if not a or not b:
        return 0.0
    far = max(len(a), len(b)) / min(len(a), len(b))
    words = max(token_sort_ratio(a, b), token_set_ratio(a, b))
    if far < 1.5:
        return max(ratio(a, b), 0.95 * words)
    scale = 0.9 if far < 8 else 0.6
    parts = max(token_sort_ratio(a, b, partial_ratio), token_set_ratio(a, b, partial_ratio))
    return max(ratio(a, b), scale * partial_ratio(a, b), 0.95 * scale * parts)


def jaro(a: str, b: str) -> float:
    """Jaro similarity times 100."""
    if a == b:
        return 100.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free, left = list(range(len(b))), []
    taken = []
    for i, x in enumerate(a):
        for j in free:
            if j > i + reach:
                break
            if j >= i - reach and b[j] == x:
                free.remove(j)
                taken.append(j)
                left.append(x)
                break
    if not left:
        return 0.0
    m = len(left)
    swaps = sum(x != b[j] for x, j in zip(left, sorted(taken), strict=True)) // 2
    return 100.0 * (m / len(a) + m / len(b) + (m - swaps) / m) / 3


SCORERS: dict[str, Callable[[str, str], float]] = {
    f.__name__: f for f in (ratio, partial_ratio, token_sort_ratio, token_set_ratio, quick_ratio, weighted_ratio, jaro)
} | {"partial_token_sort_ratio": lambda a, b: token_sort_ratio(a, b, partial_ratio), "partial_token_set_ratio": lambda a, b: token_set_ratio(a, b, partial_ratio)}


def scored(name: str, a: Column, b: Column) -> Column:
    """A scorer of SCORERS on two text columns."""
    score = SCORERS[name]

    @F.pandas_udf(T.DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([score(s or "", t or "") for s, t in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)
