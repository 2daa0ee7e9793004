"""Fast similarity sketching of many weighted sets at once.

A sketch has ``t`` coordinates. In round i each element is hashed to a bin and a
value, and a bin keeps the smallest value of the first round that reaches it; in
the first t rounds the bin is drawn by hash, in the next t it is the round's own,
so every coordinate of a set that isn't empty fills after at most 2t rounds (a few
in practice). Two sketches agree in a coordinate with the probability of the sets'
Jaccard similarity. Rounds run over all elements of a batch in numpy, and sets
leave as soon as they are full.
"""

from __future__ import annotations

import numpy as np

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def sketch(elements: np.ndarray, owner: np.ndarray, sets: int, t: int) -> np.ndarray:
    """``sets`` x ``t`` values of the sets whose hashed elements (uint64) are listed with their owner; rows of empty sets stay at the maximum."""
    full = np.iinfo(np.uint64).max
    out = np.full(sets * t, full, np.uint64)
    elements, owner = elements.astype(np.uint64), owner.astype(np.int64)
    for i in range(2 * t):
        if not len(elements):
            break
        h = mix(elements + np.uint64((int(_A) * (i + 1)) & 0xFFFFFFFFFFFFFFFF))
        bins = (h >> np.uint64(40)).astype(np.int64) % t if i < t else np.full(len(h), i - t)
        at = owner * t + bins
        value = (np.uint64(i) << np.uint64(52)) | (mix(h) >> np.uint64(12))
        open_ = out[at] > (np.uint64(i) << np.uint64(52))
        np.minimum.at(out, at[open_], value[open_])
        lacking = (out.reshape(sets, t) == full).any(axis=1)
        go = lacking[owner]
        elements, owner = elements[go], owner[go]
    return out.reshape(sets, t)


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates; equal coordinates in the same band give equal keys."""
    parts = sketches[:, : bands * rows].reshape(len(sketches), bands, rows)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * _A), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key ^ parts[:, :, r]) * _B + _A
    return key.astype(np.int64)


def signature(elements: np.ndarray, owner: np.ndarray, sets: int, width: int) -> np.ndarray:
    """``sets`` x ``width`` bits, those of a set's elements set, packed in 64-bit integers."""
    bits = np.zeros((sets, width), np.uint8)
    bits[owner, (mix(elements + _C) % np.uint64(width)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1).view(">i8").astype(np.int64)
