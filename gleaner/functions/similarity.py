"""String similarity: Indel ratio, its token variants, and their weighted best."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def indel(a: str, b: str) -> float:
    """200 * LCS / total length, by bit-parallel longest common subsequence."""
    if not a and not b:
        return 100.0
    if not a or not b:
        return 0.0
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        match = row & places.get(ch, 0)
        row = ((row + match) | (row - match)) & full
    lcs = len(a) - bin(row).count("1")
    return 200.0 * lcs / (len(a) + len(b))


_NOT_WORD = re.compile(r"[\W_]")


def folded(s: str) -> str:
    return _NOT_WORD.sub(" ", s or "").lower().strip()


@lru_cache(1 << 17)
def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    shared, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if shared and (not left or not right):
        return 100.0
    s, l, r = " ".join(shared), " ".join(shared + left), " ".join(shared + right)
    return max(indel(l, r), indel(s, l) if shared else 0.0, indel(s, r) if shared else 0.0)


def partial(a: str, b: str) -> float:
    """Best Indel ratio of the shorter string against windows of the longer one."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0
    n = len(a)
    return max(indel(a, b[max(0, i) : i + n]) for i in range(1 - n, len(b)))


@lru_cache(1 << 17)
def weighted_ratio(a: str, b: str) -> float:
    """Plain, token and, for unequal lengths, partial ratios, each scaled by its reliability."""
    a, b = folded(a), folded(b)
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    best = indel(a, b)
    if longer < 1.5:
        return max(best, 0.95 * max(token_sort(a, b), token_set(a, b)))
    scale = 0.9 if longer <= 8 else 0.6
    best = max(best, scale * partial(a, b))
    sa, sb = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    shared = set(a.split()) & set(b.split())
    return max(best, 0.95 * scale * (100.0 if shared else partial(sa, sb)))


_BUCKETS = 40


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts of characters by bucket, lengths)."""
    bags = np.zeros((len(texts), _BUCKETS), np.int16)
    for i, text in enumerate(texts):
        for ch in text:
            code = ord(ch)
            bags[i, code - 97 if 97 <= code < 123 else 26 + code % (_BUCKETS - 26)] += 1
    return bags, np.array([len(t) for t in texts], np.float32)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)), np.int16)
    for k in range(_BUCKETS):
        if a[:, k].any() and b[:, k].any():
            out += np.minimum.outer(a[:, k], b[:, k])
    return out.astype(np.float32)


def _most_indel(a: list[str], b: list[str]) -> np.ndarray:
    """What ``indel`` of each two texts can be at most, as their common characters are an upper bound of a common subsequence."""
    (x, n), (y, m) = _bags(a), _bags(b)
    total = np.add.outer(n, m)
    return np.where(total == 0, 100, 200 * _shared(x, y) / np.maximum(total, 1))


def _most_weighted(a: list[str], b: list[str]) -> np.ndarray:
    """What ``weighted_ratio`` can be at most, from common characters, common words and lengths without repeated spaces."""
    (x, _), (y, _) = _bags(a), _bags(b)
    n, m = (np.array([len(" ".join(t.split())) for t in side], np.float32) for side in (a, b))
    shared, short = _shared(x, y), np.minimum.outer(n, m)
    out = np.maximum(200 * shared / np.maximum(np.add.outer(n, m), 1), 0.9 * 200 * shared / np.maximum(short + shared, 1))
    words: dict[str, list[int]] = {}
    for j, text in enumerate(b):
        for w in set(text.split()):
            words.setdefault(w, []).append(j)
    for i, text in enumerate(a):
        for w in set(text.split()):
            if w in words:
                out[i, words[w]] = np.maximum(out[i, words[w]], 95)
    return np.where(short == 0, 0, np.minimum(out, 100))


def similar(left: list[tuple[str, str]], right: list[tuple[str, str]], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, company similarity, title similarity) of all pairs of (company, title) whose similarities are ``least`` or more in sum.

    Each distinct company and title is bounded once against each of the other side, and only pairs
    whose bounds suffice are scored, titles first.
    """
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
    if not left or not right:
        return empty
    (ca, c_left), (cb, c_right) = (np.unique([folded(c) for c, _ in side], return_inverse=True) for side in (left, right))
    (ta, t_left), (tb, t_right) = (np.unique([" ".join(sorted(folded(t).split())) for _, t in side], return_inverse=True) for side in (left, right))
    companies, titles = _Ratios(ca.tolist(), cb.tolist(), weighted_ratio, _most_weighted), _Ratios(ta.tolist(), tb.tolist(), indel, _most_indel)
    out = [empty]
    step = max(1, 4_000_000 // len(right))
    for first in range(0, len(left), step):
        cl, tl = c_left[first : first + step], t_left[first : first + step]
        i, j = np.nonzero(companies.most[np.ix_(cl, c_right)] + titles.most[np.ix_(tl, t_right)] >= least)
        t = titles.exact(tl[i], t_right[j])
        may = companies.most[cl[i], c_right[j]] + t >= least
        i, j, t = i[may], j[may], t[may]
        c = companies.exact(cl[i], c_right[j])
        may = c + t >= least
        out.append((i[may] + first, j[may], c[may], t[may]))
    return tuple(np.concatenate(x) for x in zip(*out))


class _Ratios:
    """Ratios of two lists of texts: an upper bound of each, and exact ones once they are asked for."""

    def __init__(self, a: list[str], b: list[str], ratio, bound):
        self.a, self.b, self.ratio = a, b, ratio
        self.most = bound(a, b) + 1e-3  # room for rounding
        self.known = np.full(self.most.shape, np.nan)

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        asked = np.unique((i.astype(np.int64) * len(self.b) + j)[np.isnan(self.known[i, j])])
        for k in asked.tolist():
            x, y = divmod(k, len(self.b))
            self.known[x, y] = self.ratio(self.a[x], self.b[y])
        return self.known[i, j]


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([indel(x or "", y or "") for x, y in zip(a, b)])


@F.pandas_udf(DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_sort(folded(x), folded(y)) for x, y in zip(a, b)])


@F.pandas_udf(DoubleType())
def wratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_ratio(x, y) for x, y in zip(a, b)])


def native_indel(a: Column, b: Column) -> Column:
    """The Indel ratio as nested folds over characters; for short strings."""
    letters = F.filter(F.split(a, ""), lambda c: c != "")
    start = F.transform(F.sequence(F.lit(0), F.length(b)), lambda _: F.lit(0))

    def row(previous: Column, ch: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.length(b)), F.array(F.lit(0)),
            lambda acc, j: F.concat(acc, F.array(
                F.when(F.substring(b, j, F.lit(1)) == ch, F.element_at(previous, j) + 1)
                .otherwise(F.greatest(F.element_at(previous, j + 1), F.element_at(acc, j))))),
        )

    lcs = F.element_at(F.aggregate(letters, start, row), -1)
    whole = F.length(a) + F.length(b)
    return F.when(whole == 0, 100.0).when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(200.0 * lcs / whole)
