"""Words of digits, letters and everything beyond ASCII, as 64-bit hashes of their lower-cased form."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from gleaner.llm.textvec import Batch, runs


@lru_cache(1)
def _member() -> np.ndarray:
    table = np.ones(0x110000, bool)
    table[:128] = [chr(c).isalnum() for c in range(128)]
    return table


class Words(Batch):
    """A batch whose words are told by ``hash``; ``start``, ``end`` are code points of the joined texts."""

    def __init__(self, texts: list[str]):
        super().__init__(texts)
        self.start, self.end, self.text = runs(_member()[self.codes], self.bounds)
        self.hash = self.hashes(self.start, self.end, lower=True)
        #: Words of each text.
        self.counts = np.bincount(self.text, minlength=self.n).astype(np.int64)

