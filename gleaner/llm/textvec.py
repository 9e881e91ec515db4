"""Vectorised text: code points, spans and 64-bit span hashes over whole batches.

All functions work on one concatenated code point array, so the cost per character is
a handful of numpy passes instead of Python objects per word.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_R_INVERSE = np.uint64(pow(int(_R), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _code_values() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n + 1:
        size = max(n + 1, 1 << 20)
        for i, base in enumerate((_R, _R_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), bool)


@lru_cache(1)
def folded() -> np.ndarray:
    """Lower case of each code point where that is one code point, else itself."""
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x20000):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    return table


def runs(member: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of each run of True that lies within one text, in order."""
    size = len(member)
    begins, ends = member.copy(), member.copy()
    begins[1:] &= ~member[:-1]
    ends[:-1] &= ~member[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < size)]
    begins[inner] = member[inner]
    ends[inner - 1] = member[inner - 1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(bounds, start, side="right") - 1


@lru_cache(1)
def _ascii_space() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


class Batch:
    """Texts laid end to end as code points. ``bounds[i]:bounds[i+1]`` is text i."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        self.joined = "".join(texts)
        self.codes = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.bounds = np.zeros(self.n + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=self.bounds[1:])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text) of each run free of ASCII white space, in order."""
        return runs(~_ascii_space()[self.codes], self.bounds)

    def sums(self, codes: np.ndarray | None = None) -> np.ndarray:
        """Running sums that ``span_hash`` reads; ``codes`` may be folded ones."""
        codes = self.codes if codes is None else codes
        power, self._inverse = _power_tables(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_code_values()[codes] * power[: len(codes)], out=sums[1:])
        return sums

    def span_hash(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each span's characters, the same wherever the span stands."""
        return mix((sums[end] - sums[start]) * self._inverse[start] + (end - start).astype(np.uint64))

    def hashes(self, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
        """``span_hash`` over the text itself, or with A-Z lower-cased."""
        codes = self.codes
        if lower:
            codes = codes + np.uint32(32) * ((codes >= 65) & (codes <= 90)).astype(np.uint32)
        return self.span_hash(self.sums(codes), start, end)


def chunks(texts: list[str], limit: int = 1_000_000):
    """(first, last) index ranges holding about ``limit`` characters each."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)
