"""Word shingles of whole texts as sorted sets of 64-bit hashes, in numpy."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

#: Bytes hashed at once; a longer word makes a longer slice.
SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: list[np.ndarray] = []


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE + 1)
        rows = []
        for factor in (BASE, INVERSE):
            row = np.full(size, factor, np.uint64)
            row[0] = 1
            rows.append(np.cumprod(row, dtype=np.uint64))
        _powers[:] = rows
    return _powers[0], _powers[1]


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a slice; A-Z count as a-z."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], blank, [True]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    values = data.astype(np.uint64)
    values[(data >= 65) & (data <= 90)] += np.uint64(32)
    up, down = _powers_up_to(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((values + np.uint64(1)) * up[: len(data)])])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return starts, mix(hashes ^ ((ends - starts).astype(np.uint64) * BASE))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and the number of words of each text."""
    encoded = [text.encode() for text in texts]
    sizes = np.array([len(one) + 1 for one in encoded], np.int64)
    data = np.frombuffer(b" ".join(encoded) + b" ", np.uint8)
    blanks = None
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = len(data)
        if end - at > SLICE:
            if blanks is None:
                blanks = np.flatnonzero((data == 32) | ((data >= 9) & (data <= 13)))
            before = np.searchsorted(blanks, at + SLICE)
            if before and blanks[before - 1] > at:
                end = int(blanks[before - 1]) + 1
            elif before < len(blanks):
                end = int(blanks[before]) + 1
        found, values = _hash_words(data[at:end])
        starts.append(found + at)
        hashes.append(values)
        at = end
    if not starts:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    owner = np.searchsorted(np.cumsum(sizes), np.concatenate(starts), side="right")
    return np.concatenate(hashes), np.bincount(owner, minlength=len(texts))


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Each text's distinct shingles of ``size`` words, sorted.

    A word is a run of characters other than space and 0x09-0x0D. A text with fewer words
    is one shingle of all of them; a text without words has an empty set.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    whole = max(0, len(words) - size + 1)
    combined = np.zeros(whole, np.uint64)
    for k in range(size):
        combined = mix(combined + words[k : k + whole] * np.uint64(2 * k + 3))
    sets = []
    for end, count in zip(ends.tolist(), counts.tolist()):
        first = end - count
        if count >= size:
            sets.append(np.unique(combined[first : end - size + 1]))
        elif count:
            one = np.array([count], np.uint64)
            for k in range(first, end):
                one = mix(one * BASE + words[k])
            sets.append(one)
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def set_digest(hashes: np.ndarray) -> tuple[int, int]:
    """Equal for equal sets: two signed 64-bit halves."""
    halves = np.frombuffer(blake2b(hashes.tobytes(), digest_size=16).digest(), "<i8")
    return int(halves[0]), int(halves[1])
