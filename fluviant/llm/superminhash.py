"""Word shingles and SuperMinHash signatures of single texts (numpy, no Spark)."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words hashed before, in each Python worker; then the table starts anew.
CACHE_ENTRIES = 300_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_LOW = np.uint64(0xFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of hashed shingles of lower-case words."""

    def __init__(self, width: int = 5):
        self.width = width
        self.known: dict[bytes, int] = {}

    def _words(self, raw: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
        for w in set(raw).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, raw), np.uint64, len(raw))

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit shingle hashes of the whole text.

        A-Z are lower-cased and words end at ASCII white space, both by the methods
        of ``bytes``. Fewer words than ``width`` make one shingle; none make none."""
        raw = (text or "").encode().lower().split()
        if not raw:
            return np.zeros(0, np.uint64)
        h = self._words(raw)
        width = min(self.width, len(h))
        at = len(h) - width + 1
        rolled = np.full(at, width, np.uint64) * _GOLDEN
        for k in range(width):
            rolled = mix(rolled + h[k : k + at]) * _FACTORS[k % len(_FACTORS)]
        return np.unique(mix(rolled))


def super_min_hash(elements: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash signature of a set: m numbers (rank << 32 | uniform).

    Each element draws a permutation of the m slots and puts (rank j + uniform) in
    the j-th of its slots; a slot keeps its least value. The ranks of one element
    are thus all different, which is what lowers the variance. Elements advance
    together, rank by rank, so the pass stops at the first rank that can no longer
    lower any slot: at once for large sets. The empty set has no signature."""
    n = len(elements)
    if not n:
        return np.zeros(0, np.uint64)
    best = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    slots = rows = None
    for j in range(m):
        draw = mix(elements + np.uint64((j + 1) * int(_GOLDEN) & 0xFFFFFFFFFFFFFFFF))
        pick = (j + ((draw & _LOW) * np.uint64(m - j) >> np.uint64(32))).astype(np.int64)
        if j == 0:
            to = first = pick
        else:
            if slots is None:
                rows = np.arange(n)
                slots = np.tile(np.arange(m, dtype=np.int16), (n, 1))
                slots[rows, first], slots[:, 0] = 0, first
            to = slots[rows, pick].astype(np.int64)
            slots[rows, pick] = slots[:, j]
            slots[:, j] = to
        np.minimum.at(best, to, (np.uint64(j) << np.uint64(32)) | (draw >> np.uint64(32)))
        if best.max() >> np.uint64(32) <= j:
            break
    return best


def band_hashes(signature: np.ndarray, bands: int) -> np.ndarray:
    """One signed 64-bit hash for each band of the signature."""
    rows = signature.reshape(bands, -1)
    h = (np.arange(bands, dtype=np.uint64) + np.uint64(1)) * _GOLDEN
    for k in range(rows.shape[1]):
        h = mix(h + rows[:, k])
    return h.view(np.int64)
