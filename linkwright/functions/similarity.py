"""String and token-set similarities.

Token sets are Column expressions.  Jaro similarity is an Arrow function: a fold over the
characters of two strings is interpreted row by row in Spark, while a batch of pairs is
compared here one character position at a time, for all its pairs at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Characters of padded pairs compared at once.
CELLS = 1 << 20


def _padded(texts: list[str], width: int, fill: int) -> np.ndarray:
    """(texts, width) code points; what is beyond a text's end is fill."""
    whole = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<i4")
    size = np.array([len(t) for t in texts])
    out = np.full((len(texts), width), fill, dtype=np.int32)
    out[np.arange(width) < size[:, None]] = whole
    return out


def _jaro_block(a: list[str], b: list[str]) -> np.ndarray:
    n, m = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    x, y = _padded(a, int(n.max()), -1), _padded(b, int(m.max()), -2)
    reach = np.maximum(n, m) // 2 - 1
    place, row = np.arange(y.shape[1]), np.arange(len(a))
    free = np.ones(y.shape, dtype=bool)
    got = np.zeros(x.shape, dtype=bool)
    for i in range(x.shape[1]):  # from left to right each takes the first free equal one inside the window
        fits = (y == x[:, i : i + 1]) & free & (np.abs(place - i) <= reach[:, None])
        first = fits.argmax(axis=1)
        hit = fits[row, first]
        got[:, i] = hit
        free[row[hit], first[hit]] = False
    k = got.sum(axis=1)
    swaps = np.zeros(len(a), dtype=np.int64)
    owner = np.repeat(row, k)
    np.add.at(swaps, owner, x[got] != y[~free])  # either side row by row, in order of place
    hits = k.astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        rate = (hits / n + hits / m + (hits - swaps / 2.0) / hits) / 3.0
    return np.where(k == 0, 0.0, rate)


def jaro_of(a: list[str], b: list[str]) -> np.ndarray:
    """Jaro similarity of each pair; half the count of transposed characters, not rounded."""
    out = np.array([1.0 if x == y and x else 0.0 for x, y in zip(a, b)])
    open_ = sorted((max(len(x), len(y)), i) for i, (x, y) in enumerate(zip(a, b)) if x and y and x != y)
    at = 0
    while at < len(open_):  # pairs of like lengths together
        to = at + 1
        while to < len(open_) and (to - at + 1) * open_[to][0] <= CELLS:
            to += 1
        which = [i for _, i in open_[at:to]]
        out[which] = _jaro_block([a[i] for i in which], [b[i] for i in which])
        at = to
    return out


def _once(x: list[str], y: list[str]) -> tuple[list[str], list[str], np.ndarray]:
    """The different pairs, and for each pair which one it is."""
    seen: dict[tuple[str, str], int] = {}
    which = np.array([seen.setdefault(k, len(seen)) for k in zip(x, y)], dtype=np.int64)
    return [a for a, _ in seen], [b for _, b in seen], which


def _lists(a: pd.Series, b: pd.Series) -> tuple[list[str], list[str], np.ndarray]:
    none = (a.isna() | b.isna()).to_numpy()
    return a.fillna("").tolist(), b.fillna("").tolist(), none


@F.pandas_udf(DoubleType())
def _jaro(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y, none = _lists(a, b)
    return pd.Series(np.where(none, np.nan, jaro_of(x, y))).where(~none)


@F.pandas_udf(DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y, none = _lists(a, b)
    x, y, which = _once(x, y)
    j = jaro_of(x, y)
    same = np.array([next((k for k in range(min(4, len(u), len(v))) if u[k] != v[k]), min(4, len(u), len(v))) for u, v in zip(x, y)])
    return pd.Series(np.where(none, np.nan, (j + same * 0.1 * (1.0 - j))[which])).where(~none)


def jaro(a: Column, b: Column) -> Column:
    """Jaro similarity; null if either is null."""
    return _jaro(a, b)


def jaro_winkler(a: Column, b: Column) -> Column:
    """With a bonus of a tenth of what is missing for each of up to four equal first characters, at any Jaro value."""
    return _jaro_winkler(a, b)


def token_jaccard(x: Column, y: Column) -> Column:
    """x and y without repeats."""
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(both.cast("double") / (F.size(x) + F.size(y) - both))


def token_containment(x: Column, y: Column) -> Column:
    """x and y without repeats."""
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(both.cast("double") / F.least(F.size(x), F.size(y)))
