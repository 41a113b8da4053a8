"""Similarities: vectors by built-in functions; strings by published definitions in Arrow UDFs."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    """Null for a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_normalised(v: Column) -> Column:
    scaled = F.transform(F.array(norm(v)), lambda n: F.transform(v, lambda x: F.try_divide(x.cast("double"), n)))  # the norm once
    return F.get(scaled, F.lit(0))


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, bit-parallel over the characters of a."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel(a: str, b: str) -> float:
    """100 * (1 - insertions and deletions / total length); 100 for two empty texts."""
    return 100.0 * 2 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def partial(a: str, b: str) -> float:
    """Best indel similarity of the shorter text with any window of the longer one (shorter at its ends)."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0
    m = len(short)
    return max(indel(short, long[max(0, i) : i + m]) for i in range(1 - m, len(long)))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    one, two = ((both + " " + " ".join(sorted(s))).strip() for s in (x - y, y - x))
    return max(indel(one, two), *((indel(both, one), indel(both, two)) if both else ()))


def weighted(a: str, b: str) -> float:
    """The published weighted mix: plain, token and, for unequal lengths, partial similarities."""
    if not a or not b:
        return 0.0
    ratio = max(len(a), len(b)) / min(len(a), len(b))
    best = indel(a, b)
    if ratio < 1.5:
        return max(best, 0.95 * max(token_sort(a, b), token_set(a, b)))
    scale = 0.9 if ratio <= 8 else 0.6
    sorted_ = [" ".join(sorted(t.split())) for t in (a, b)]
    tokens = 100.0 if set(a.split()) & set(b.split()) else partial(*sorted_)
    return max(best, scale * partial(a, b), 0.95 * scale * max(partial(*sorted_), tokens))


def jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, left = [False] * len(b), []
    for i, c in enumerate(a):
        j = b.find(c, max(0, i - reach), i + reach + 1)
        while j >= 0 and used[j]:
            j = b.find(c, j + 1, i + reach + 1)
        if j >= 0:
            used[j] = True
            left.append(c)
    if not left:
        return 0.0
    right = [c for c, u in zip(b, used, strict=True) if u]
    half = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    m = len(left)
    return (m / len(a) + m / len(b) + (m - half) / m) / 3


def jaro_winkler(a: str, b: str, scaling: float = 0.1) -> float:
    base, prefix = jaro(a, b), 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return base + prefix * scaling * (1 - base)


def as_udf(f: Callable[[str, str], float]) -> Callable[[Column, Column], Column]:
    """A column function; null if either text is null. Equal pairs of a batch are worked out once."""

    @F.pandas_udf(DoubleType())
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a, b, strict=True):
            if pair[0] is None or pair[1] is None:
                out.append(None)
                continue
            if pair not in known:
                known[pair] = f(*pair)
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return scored


indel_ratio, token_sort_ratio, partial_ratio, weighted_ratio, jaro_winkler_ratio = map(as_udf, (indel, token_sort, partial, weighted, jaro_winkler))


def jaro_winkler_scaled(scaling: float) -> Callable[[Column, Column], Column]:
    """Jaro-Winkler with another weight of the common prefix."""
    return as_udf(lambda a, b: jaro_winkler(a, b, scaling))


def can_reach(a: Column, b: Column, least: float) -> Column:
    """Whether lengths allow an indel similarity of `least`: a filter before the UDF, since the LCS is no longer than the shorter text."""
    return 200.0 * F.least(F.length(a), F.length(b)) >= least * (F.length(a) + F.length(b))


def sorted_tokens(text: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")), " ")
