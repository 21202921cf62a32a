"""Small helpers for operators that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes worked on at once; a longer text is a piece of its own.
PIECE = 4 << 20


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes in ``column``, so that memory follows neither the number nor
    the mean length of rows."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def filled(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A text column, empty where it is null."""
    return pc.fill_null(batch.column(column), "")


def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of words of each text, and all words in order: the runs between ASCII white space."""
    split = pc.ascii_split_whitespace(texts)
    flat, owner = split.flatten(), pc.list_parent_indices(split)
    full = pc.greater(pc.binary_length(flat), 0)
    owner = owner.filter(full).to_numpy(zero_copy_only=False)
    return np.bincount(owner, minlength=len(texts)).astype(np.int64), flat.filter(full)


def bounds(counts: np.ndarray) -> np.ndarray:
    """Start of each run, and the end of the last."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def hashed(words_: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; each different word is hashed once."""
    import xxhash

    coded = pc.dictionary_encode(words_)
    names = coded.dictionary.cast(pa.binary() if coded.dictionary.type == pa.string() else pa.large_binary()).to_pylist()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    return table[coded.indices.to_numpy(zero_copy_only=False)] if len(table) else np.zeros(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values from 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
