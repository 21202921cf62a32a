"""Word shingles of whole texts as 64-bit hashes, for batches of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerlens.llm.arrow import bounds, hashed, mixed, words

WORDS = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words; runs may cross the ends of texts."""
    out = hashes[: max(len(hashes) - n + 1, 0)].copy()
    for k in range(1, n):
        out = out * _STEP + hashes[k : k + len(out)]
    return mixed(out)


def shingles(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each text, repeated ones too, and the bounds of each text's run.

    Letters A-Z count as lower case. A text with fewer than ``n`` words has all its words as its one shingle, one without words none.
    """
    counts, flat = words(pc.ascii_lower(texts))
    hashes = hashed(flat)
    starts = bounds(counts)
    runs = chained(hashes, n)
    long = counts >= n
    inside = np.ones(len(runs), bool)
    # Runs that start in the last n - 1 words of a text cross its end.
    for k in range(1, n):
        at = starts[1:] - k
        at = at[(at >= starts[:-1]) & (at < len(runs))]
        inside[at] = False
    kept = runs[inside]
    sizes = np.where(long, counts - n + 1, 0)
    short = np.flatnonzero((counts > 0) & ~long)
    if not len(short):
        return kept, bounds(sizes)
    sizes[short] = 1
    ends = bounds(sizes)
    out = np.empty(ends[-1], np.uint64)
    place = np.ones(len(out), bool)
    place[ends[short]] = False
    out[place] = kept
    for i in short:
        told = hashes[starts[i] : starts[i + 1]]
        whole = np.uint64(len(told))
        for h in told:
            whole = np.multiply(whole, _STEP) + h
        out[ends[i]] = mixed(np.array([whole + np.uint64(1)]))[0]
    return out, ends
