"""Near-duplicates by min-max hashing of word shingles.

Each permutation of the hash space gives two values of a set, its minimum and its maximum; both agree between two sets with their
similarity as probability, so 32 hash evaluations per shingle give 64 values. How many of them make a band follows from the threshold:
at 85 percent sixteen bands of four values, which two sets of similarity 0.85 miss with a probability of 7 in a million, at 0.9 of 4 in a
hundred million; at 80 percent 21 bands of three values, missed at 0.8 with 3 in ten million.

Sets that are equal become one class before anything else, so exact copies cost one row each however many there are. Documents that meet in a band
are compared on their full sets: a band value's members are dealt into blocks of bounded size, each pair of blocks is compared in one task by an inverted
index, and only a spanning forest of the links found leaves it. No pair is a row, no value has a limit of members.

Defined results: a text without words has the empty set and is linked with nothing; a missing id is linked with nothing, has no
component and is kept; rows that repeat an id are judged each by its own text; other columns are ignored by :func:`near_duplicates` and kept by :func:`keep_one`; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.arrow import filled, mixed, pieces
from ledgerlens.llm.graph import components
from ledgerlens.llm.shingles import WORDS, shingles
from ledgerlens.session import materialize

PERMUTATIONS = 32
#: Most that two sets at the threshold may miss each other in all bands.
MISSED = 1e-5
#: Linked at 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Shingles of a block, which bounds a task's memory.
BLOCK = 1_000_000
#: Text bytes hashed at once.
PIECE = 1 << 20


def permutations(n: int = PERMUTATIONS, seed: int = 7) -> np.ndarray:
    """Odd multipliers: each permutes the 64-bit numbers."""
    drawn = np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


def min_max(hashes: np.ndarray, ends: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """For each set its minimum and maximum under every permutation; zeros for empty sets."""
    full = np.flatnonzero(np.diff(ends))
    out = np.zeros((len(ends) - 1, 2 * len(multipliers)), np.uint64)
    for k, m in enumerate(multipliers) if len(full) else ():
        moved = hashes * m
        out[full, 2 * k] = np.minimum.reduceat(moved, ends[full])
        out[full, 2 * k + 1] = np.maximum.reduceat(moved, ends[full])
    return out


def bands_of(percent: int, values: int = 2 * PERMUTATIONS) -> tuple[int, int]:
    """Number of bands and values of each: as many values as let sets at the threshold be missed no more often than ``MISSED``."""
    fits = [r for r in range(1, values + 1) if (1 - (percent / 100) ** r) ** (values // r) <= MISSED]
    size = max(fits, default=1)
    return values // size, size


def banded(values: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """One 64-bit value per band; equal in two bands of different number only by chance."""
    bands, size = bands_of(percent, values.shape[1])
    rows = values[:, : bands * size].reshape(len(values), bands, size)
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(values), 1))
    for k in range(rows.shape[2]):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return out


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_a, set_b, bands``: a hash of the text, size and 128-bit name of each document's set, and its bands (none of an
    empty set)."""
    multipliers = permutations()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                hashes, ends = shingles(filled(piece, "text"), n)
                sets = [np.unique(hashes[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                names = [np.array([f(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                         for f in (lambda s: s, lambda s: mixed(s + np.uint64(1)))]
                bands = banded(min_max(hashes, ends, multipliers), percent).view(np.int64)
                sizes = np.array([len(s) for s in sets], np.int64)
                listed = pa.array([b if n_ else b[:0] for b, n_ in zip(bands, sizes, strict=True)], pa.list_(pa.int64()))
                columns = [piece.column("doc_id"), piece.column("text_key"), pa.array(sizes), *map(pa.array, names), listed]
                yield pa.record_batch(columns, schema.fieldNames())

    long = T.LongType()
    schema = T.StructType([
        *[T.StructField(c, long) for c in ("doc_id", "text_key", "n_shingles", "set_a", "set_b")], T.StructField("bands", T.ArrayType(long)),
    ])
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), _text_key(docs[text]).alias("text_key"), docs[text].alias("text")).mapInArrow(run, schema)


def _text_key(text: Column) -> Column:
    """Tells the texts of rows that share an id apart."""
    return F.xxhash64(text, F.octet_length(text))


def _classes(signed: DataFrame) -> DataFrame:
    """The smallest id of each different set."""
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    return full.groupBy("n_shingles", "set_a", "set_b").agg(F.min("doc_id").alias("first"))


def _meetings(signed: DataFrame, firsts: DataFrame) -> DataFrame:
    """``bucket, i, j, doc_id``: which documents to compare together. A band value with several members is a bucket; of buckets with the same
    members one stays; members are dealt to blocks, and a document of block b stands in all groups (i, j) with i = b or j = b."""
    one = signed.join(firsts.select("n_shingles", "set_a", "set_b", F.col("first").alias("doc_id")), ["n_shingles", "set_a", "set_b", "doc_id"], "left_semi")
    one = one.select("doc_id", "n_shingles", F.explode("bands").alias("band")).distinct()
    buckets = one.groupBy("band").agg(
        F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"), F.min("doc_id").alias("least"),
        F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("name"),
    ).where("members > 1")
    buckets = buckets.groupBy("members", "shingles", "least", "name").agg(F.min("band").alias("band"))
    blocks = F.greatest(F.ceil(F.col("shingles") / BLOCK), F.lit(1)).cast("int")
    rows = one.join(buckets.select("band", blocks.alias("blocks")), "band")
    rows = rows.withColumn("b", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(F.col("band").alias("bucket"), F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), "doc_id")


def forest(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links of a spanning forest over all pairs of sets that are alike enough, found by an inverted index of their elements."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets, ids = [sets[k] for k in order], ids[order]
    sizes = np.array([len(s) for s in sets])
    elements = np.concatenate(sets)
    by = np.argsort(elements, kind="stable")
    owner = np.repeat(np.arange(len(sets)), sizes)[by]
    elements = elements[by]
    root = list(range(len(sets)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    out = []
    for k, s in enumerate(sets):
        # Larger sets can be alike only up to this size.
        last = int(np.searchsorted(sizes * percent, 100 * sizes[k], "right"))
        if last <= k + 1:
            continue
        start, stop = np.searchsorted(elements, s, "left"), np.searchsorted(elements, s, "right")
        long = stop - start
        if long.sum() == len(s):
            continue
        at = np.repeat(stop - np.cumsum(long), long) + np.arange(long.sum())
        shared = np.bincount(owner[at], minlength=len(sets))[k + 1 : last]
        alike = 100 * shared >= percent * (sizes[k] + sizes[k + 1 : last] - shared)
        for m in np.flatnonzero(alike) + k + 1:
            a, b = top(k), top(int(m))
            if a != b:
                root[b] = a
                out.append((int(ids[k]), int(ids[m])))
    return out


def _links(meetings: DataFrame, docs: DataFrame, doc_id: str, text: str, n: int, percent: int) -> DataFrame:
    texts = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = meetings.join(texts, "doc_id").repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            found = forest(np.array(ids), sets, percent) if len(ids) > 1 else []
            return pa.record_batch([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["u", "v"])

        group, ids, sets = None, [], []
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                hashes, ends = shingles(filled(piece, "text"), n)
                keys = zip(*[piece.column(c).to_pylist() for c in ("bucket", "i", "j")], strict=True)
                for k, (key, id_) in enumerate(zip(keys, piece.column("doc_id").to_pylist(), strict=True)):
                    if key != group:
                        yield told(ids, sets)
                        group, ids, sets = key, [], []
                    ids.append(id_)
                    sets.append(np.unique(hashes[ends[k] : ends[k + 1]]))
        yield told(ids, sets)

    return rows.select("bucket", "i", "j", "doc_id", "text").mapInArrow(run, "u long, v long")


def _judged(docs: DataFrame, doc_id: str, text: str, n: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept``, a row per document. Signatures and links are written to the shared folder."""
    signed = materialize(signatures(docs, doc_id, text, n, percent), "signatures")
    firsts = materialize(_classes(signed), "classes")
    found = components(_links(_meetings(signed, firsts), docs, doc_id, text, n, percent))
    named = firsts.join(found, F.col("first") == F.col("node"), "left")
    named = named.select("n_shingles", "set_a", "set_b", F.coalesce("component", "first").alias("component"))
    out = signed.drop("bands").join(named, ["n_shingles", "set_a", "set_b"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == own, F.lit(True))
    return out.select("doc_id", "text_key", "n_shingles", own.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    return _judged(docs, doc_id, text, n, percent).drop("text_key")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, unchanged. Rows that share an id are judged each by its own text."""
    gone = _judged(docs, doc_id, text, WORDS, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_key")).distinct()
    return docs.join(gone, (docs[doc_id] == gone["_gone"]) & (_text_key(docs[text]) == gone["_key"]), "left_anti")
