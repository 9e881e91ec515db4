"""Byte-level BPE ids for whole batches.

Documents repeat words, so each batch is cut into pre-tokens with numpy, the distinct ones
are looked up in (or added to) a bounded cache, and ids are gathered back in one step. The
ids are those of the ``tokenizers`` library for the same file; texts with characters outside
the vectorised range go to that library itself.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd

from gleaner.llm.textvec import Batch, chunks

#: Code points below this are cut by table; the rest by the library.
TABLE_END = 0x0530
CACHE = 300_000
_GAP, _BLANK, _LETTER, _NUMBER, _OTHER, _UNKNOWN = range(6)


@lru_cache(1)
def _classes() -> np.ndarray:
    table = np.full(TABLE_END + 1, _OTHER, np.uint8)
    table[TABLE_END] = _UNKNOWN
    for c in range(TABLE_END):
        kind = unicodedata.category(chr(c))
        if kind == "Cn":
            table[c] = _UNKNOWN
        elif kind[0] == "L":
            table[c] = _LETTER
        elif kind[0] == "N":
            table[c] = _NUMBER
    table[[*range(9, 14), 0x85, 0xA0]] = _BLANK
    table[0x20] = _GAP
    return table


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins that byte-level vocabularies use, by the byte they mean."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pre_tokens(batch: Batch, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of each pre-token; ``kind`` has the class of each character."""
    codes, size = batch.codes, len(batch.codes)
    if not size:
        none = np.zeros(0, np.int64)
        return none, none, none
    group = np.maximum(kind, np.uint8(_BLANK))
    first = np.zeros(size + 1, bool)
    first[batch.bounds] = True
    starts = first[:size].copy()
    starts[1:] |= group[1:] != group[:-1]
    # The last white space of a run before something else stands alone, or leads it if a blank.
    lead = np.flatnonzero((group[:-1] == _BLANK) & (group[1:] != _BLANK) & ~first[1:size])
    starts[lead] = True
    starts[lead + 1] = kind[lead] != _GAP
    # English contractions.
    quote = np.flatnonzero((codes == 0x27) & starts)
    quote = quote[quote + 1 < size]
    quote = quote[~first[quote + 1]]
    if len(quote):
        one = codes[quote + 1]
        two = np.where((quote + 2 < size) & ~first[np.minimum(quote + 2, size)], codes[np.minimum(quote + 2, size - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for hit, length in ((short, 2), (long, 3)):
            at = quote[hit]
            starts[at + 1] = False
            after = at + length
            starts[after[after < size]] = True
    start = np.flatnonzero(starts)
    end = np.append(start[1:], size)
    return start, end, np.searchsorted(batch.bounds, start, side="right") - 1


class Encoder:
    """``encode(texts)`` gives (ids, counts): all ids end to end and how many each text has."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        byte = _byte_alphabet()
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.piece = tiktoken.Encoding(
            "piece", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={},
        )._encode_single_piece
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.known = array("I")
        self.offsets = array("q", [0])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, counts = [], []
        for a, b in chunks(texts):
            ids, n = self._chunk(texts[a:b])
            parts.append(ids)
            counts.append(n)
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(parts), np.concatenate(counts)

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        batch = Batch(texts)
        kind = _classes()[np.minimum(batch.codes, np.uint32(TABLE_END))]
        strange = kind == _UNKNOWN
        if strange.any():
            odd = np.zeros(batch.n, bool)
            odd[np.searchsorted(batch.bounds, np.flatnonzero(strange), side="right") - 1] = True
            plain_ids, plain_counts = self._chunk([t for t, o in zip(texts, odd) if not o])
            cut = np.split(plain_ids, np.cumsum(plain_counts))
            out, next_plain = [], 0
            for text, is_odd in zip(texts, odd):
                if is_odd:
                    out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32))
                else:
                    out.append(cut[next_plain])
                    next_plain += 1
            return np.concatenate(out), np.array([len(x) for x in out], np.int64)
        return self._plain(batch, kind)

    def _plain(self, batch: Batch, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, end, text = pre_tokens(batch, kind)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(batch.n, np.int64)
        if len(self.slots) > CACHE:
            self.forget()
        at, distinct = pd.factorize(batch.hashes(start, end))
        first = np.empty(len(distinct), np.int64)
        first[at[::-1]] = np.arange(len(at) - 1, -1, -1)
        slots, known, offsets, piece = self.slots, self.known, self.offsets, self.piece
        slot = np.array([slots.get(h, -1) for h in distinct.tolist()], np.int64)
        missing = np.flatnonzero(slot < 0)
        slot[missing] = np.arange(len(slots), len(slots) + len(missing))
        at_first = first[missing]
        for h, s, e in zip(distinct[missing].tolist(), start[at_first].tolist(), end[at_first].tolist()):
            slots[h] = len(slots)
            known.extend(piece(batch.joined[s:e]))
            offsets.append(len(known))
        offset = np.array(offsets)
        per = slot[at]
        length = (offset[1:] - offset[:-1])[per]
        to = np.cumsum(length)
        ids = np.array(known, np.uint32)[np.repeat(offset[per] - (to - length), length) + np.arange(to[-1])]
        return ids, np.bincount(text, weights=length, minlength=batch.n).astype(np.int64)
