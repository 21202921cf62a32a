"""Suffix dedup over bytes: stretches of fifty bytes or more that stand in an earlier document are removed.

Suffixes are ranked by growing prefixes. Spark sorts rows of rank and place, those whose rank is unique to a document drop out, and the
others are ranked again by a longer prefix, until they are unique or past fifty bytes (see :mod:`ledgerlens.llm.repeats`). Two things
keep the sort small. Only the suffixes at anchors take part, one in about sixteen bytes, as every fifty bytes have one at the same
place wherever they stand. And a rank is a hash of the prefix rather than its place in the order, so that it needs no numbering between
the sorts. Prefixes are of 20, 43 and 50 bytes.

Defined results: a null text is empty; shorter texts lose nothing; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlens.llm.arrow import bounds, filled, pieces
from ledgerlens.llm.repeats import PIECE, Spec, byte_symbols, raw_bytes, removed, with_repeats

BYTES, SEED = 50, 20
#: Windows kept together by the second and the third sort.
RANGES = (8, 1)


def without_repeats(docs: DataFrame, length: int = BYTES, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """One row per document: numbers of bytes, of removed ones and of the maximal runs they form, the digest of the bytes kept, and with
    ``texts`` these themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                data, counts = raw_bytes(filled(piece, "text"))
                gone, starts = removed(counts, piece.column("repeats"), length), bounds(counts)
                first = gone & ~np.r_[False, gone[:-1]] if len(gone) else gone
                first[starts[:-1][counts > 0]] = gone[starts[:-1][counts > 0]]
                lost, runs = (np.r_[0, np.cumsum(x)][starts] for x in (gone, first))
                kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
                columns = [piece.column("doc_id"), pa.array(counts), pa.array(np.diff(lost)), pa.array(np.diff(runs)),
                           pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string())]
                yield pa.record_batch(columns + [pa.array(kept, pa.binary())] * texts, schema.fieldNames())

    long = T.LongType()
    schema = T.StructType([
        *[T.StructField(c, long) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")], T.StructField("kept_sha256", T.StringType()),
        *[T.StructField("kept", T.BinaryType())] * texts,
    ])
    return with_repeats(docs, Spec(length, seed, byte_symbols, RANGES), doc_id, text).mapInArrow(run, schema)
