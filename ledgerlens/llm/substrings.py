"""Substring dedup by seed and extend, over words.

Documents meet on winnowed anchors of five words; anchors are extended both ways to stretches, and stretches that stand in an
earlier document are joined to maximal repeats of thirteen words or more, which are removed (see :mod:`ledgerlens.llm.repeats`).

Defined results: a null text has no words; shorter texts lose nothing; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlens.llm.arrow import bounds, filled, pieces, words
from ledgerlens.llm.repeats import PIECE, Spec, removed, with_repeats, word_symbols

WORDS, SEED = 13, 5


def without_repeats(docs: DataFrame, length: int = WORDS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """One row per document: numbers of words and of removed ones, the digest of the words kept, joined by a space, and with ``texts`` these themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                counts, flat = words(filled(piece, "text"))
                gone, starts, all_words = removed(counts, piece.column("repeats"), length), bounds(counts), flat.to_pylist()
                kept, left = [], np.zeros(len(counts), np.int64)
                for k, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                    own = [all_words[i] for i in np.flatnonzero(~gone[a:b]) + a] if gone[a:b].any() else all_words[a:b]
                    left[k] = len(own)
                    kept.append(" ".join(own))
                columns = [piece.column("doc_id"), pa.array(counts), pa.array(counts - left),
                           pa.array([hashlib.sha256(t.encode()).hexdigest() for t in kept], pa.string())]
                yield pa.record_batch(columns + [pa.array(kept, pa.string())] * texts, schema.fieldNames())

    long = T.LongType()
    schema = T.StructType([
        *[T.StructField(c, long) for c in ("doc_id", "n_words", "n_removed")], T.StructField("kept_sha256", T.StringType()),
        *[T.StructField("kept", T.StringType())] * texts,
    ])
    return with_repeats(docs, Spec(length, seed, word_symbols), doc_id, text).mapInArrow(run, schema)
