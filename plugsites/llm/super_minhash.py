"""SuperMinHash signatures: one random permutation of the components per element.

An element's value in the component that its permutation puts at rank j is j plus a
random fraction; a component's value is the least over all elements. As the ranks of an
element are all different, components are correlated so that estimates of similarity vary
less than with independent hashes. Ranks are drawn in rising order, so a set is finished as
soon as all of its components lie below the next rank.
"""

from __future__ import annotations

import numpy as np

from plugsites.llm.shingles import mix

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
RANK_SHIFT = np.uint64(56)
#: Elements whose permutations are held at once.
ELEMENTS = 200_000


def signatures(sets: list[np.ndarray], width: int) -> np.ndarray:
    """A row of ``width`` values per set (at most 255): the rank above, a fraction below.

    An empty set's values are all the largest there is.
    """
    out = np.full((len(sets), width), np.iinfo(np.uint64).max, np.uint64)
    first = 0
    while first < len(sets):
        last, held = first, 0
        while last < len(sets) and (last == first or held + len(sets[last]) <= ELEMENTS):
            held += len(sets[last])
            last += 1
        if held <= ELEMENTS:
            _fill(sets[first:last], out[first:last])
        else:  # one very large set: portions of it, and their least values
            for at in range(0, held, ELEMENTS):
                part = np.full((1, width), np.iinfo(np.uint64).max, np.uint64)
                _fill([sets[first][at : at + ELEMENTS]], part)
                np.minimum(out[first], part[0], out=out[first])
        first = last
    return out


def _fill(sets: list[np.ndarray], out: np.ndarray) -> None:
    width = out.shape[1]
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(one) for one in sets])
    places = np.tile(np.arange(width, dtype=np.uint8), (len(elements), 1))
    active = np.arange(len(elements))
    least = out.reshape(-1)
    for rank in range(width):
        if not len(active):
            return
        drawn = mix(elements[active] + np.uint64((rank + 1) * int(GOLDEN) % 2**64))
        other = rank + ((drawn >> np.uint64(32)) % np.uint64(width - rank)).astype(np.int64)
        place = places[active, other]
        places[active, other] = places[active, rank]
        value = (np.uint64(rank) << RANK_SHIFT) | (mix(drawn) >> np.uint64(8))
        np.minimum.at(least, owner[active] * width + place, value)
        open_ = out.max(axis=1) >= np.uint64(rank + 1) << RANK_SHIFT
        active = active[open_[owner[active]]]


def band_keys(rows: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band: a hash of its number and of its share of the values."""
    parts = rows.reshape(len(rows), bands, -1)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
    for k in range(parts.shape[2]):
        keys = mix(keys * GOLDEN + parts[:, :, k])
    return keys
