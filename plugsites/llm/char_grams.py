"""Character n-grams of texts as exact 64-bit keys: four code units of 16 bits."""

from __future__ import annotations

import numpy as np

ORDER = 4
UNIT = 16
#: Stands before the first character. Code points above 0xFFFF share 4096 private units.
BEFORE = 1
PRIVATE, PRIVATE_MASK = 0xE000, 0xFFF


def gram_keys(text: str) -> np.ndarray:
    """One key per character: the three before it, and itself in the lowest bits."""
    units = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    large = units > 0xFFFF
    if large.any():
        units[large] = PRIVATE + (units[large] & np.uint64(PRIVATE_MASK))
    padded = np.concatenate([np.full(ORDER - 1, BEFORE, np.uint64), units])
    keys = np.zeros(len(units), np.uint64)
    for k in range(ORDER):
        keys = (keys << np.uint64(UNIT)) | padded[k : k + len(units)]
    return keys


class GramCounts:
    """Distinct keys of many texts with how often they occur in trusted ones."""

    #: Keys held before they are summed up.
    PENDING = 1_000_000

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, trusted: bool) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts if trusted else np.zeros_like(counts))
        self.held += len(found)
        if self.held > self.PENDING:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, place, np.concatenate(self.counts))
        self.keys, self.counts, self.held = [keys], [counts], 0
        return keys, counts
