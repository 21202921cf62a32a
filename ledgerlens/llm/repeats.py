"""Stretches of a document that stand in an earlier one, exactly, for sequences of any symbols.

A window is ``length`` consecutive symbols. Of the short runs (``seed`` symbols) in a window, the one with the least hash is its anchor, so equal windows have equal
anchors at equal places, and consecutive windows mostly share one. The search sorts anchors, not windows:

1. Every anchor is a row of the hash of its run and the hash of its stretch: the run, extended both ways as far as the windows that it
   is the anchor of. Spark sorts the rows. A run found in one document only is dropped. Rows of one stretch agree in all of their windows, so each
   but those of the earliest document is a repeat. A run with a single stretch is settled by that.
2. Where a run has several stretches, the sort is repeated with longer runs: the stretch's windows are cut to ranges of so many by their
   distance from the anchor, and the run is what all windows of such a range share. The last ranges are single windows, whose run is the window.

Repeats are joined to maximal spans per document. Rows that a batch of documents settles by itself (a later copy in the same batch) do
not take part in the sort, so a passage that a third of all documents share is a few rows per batch. Sorted rows are read as a stream
that remembers one stretch. Hashes compared are 128 bits wide.

A missing id is never earlier or later than another and loses nothing. Rows that repeat an id are one document: what is
removed at one place of one is removed at that place of all.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.arrow import bounds, filled, hashed, mixed, pieces, words
from ledgerlens.session import materialize

#: Text bytes worked on at once.
PIECE = 1 << 20
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


#: Bits of a number of windows, and of a distance from the anchor, in a place.
_BITS = 6


def packed(at: np.ndarray, shift: np.ndarray, n: np.ndarray) -> np.ndarray:
    """First window, its distance from the anchor and the number of windows as one number; a repeat's is the complement."""
    return at << 2 * _BITS | shift << _BITS | n


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place = np.where(place < 0, ~place, place)
    low = (1 << _BITS) - 1
    return place >> 2 * _BITS, place >> _BITS & low, place & low


@dataclass(frozen=True)
class Spec:
    """``symbols`` gives a piece's symbols as 64-bit hashes, text after text, and the number of each text. ``ranges`` are the numbers of
    windows that the later sorts keep together; the last is 1."""

    length: int
    seed: int
    symbols: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
    ranges: tuple[int, ...] = (1,)

    @property
    def width(self) -> int:
        """Runs in a window, which is also the most windows of an anchor."""
        return self.length - self.seed + 1

    def __post_init__(self) -> None:
        if not 0 < self.width < 1 << _BITS or self.ranges[-1] != 1:
            raise ValueError(f"windows must hold 1 to {(1 << _BITS) - 1} runs, and the last range 1 window")


def word_symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    counts, flat = words(texts)
    return hashed(flat), counts


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and the number of each."""
    counts = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8), counts


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, counts = raw_bytes(texts)
    return _BYTES[data], counts


class Prefix:
    """Hashes of any runs of a sequence of symbols, each by two look-ups."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        powers = np.full(n + 1, _BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * powers[:n], out=self._sums[1:])
        self._back = np.full(n + 1, _INVERSE, np.uint64)
        self._back[0] = 1
        np.multiply.accumulate(self._back, out=self._back)

    def run(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._back[start])

    def runs(self, n: int) -> np.ndarray:
        """Hash of the run of ``n`` symbols at every place."""
        return mixed((self._sums[n:] - self._sums[:-n]) * self._back[: len(self._sums) - n])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value among each ``width`` consecutive ones."""
    at = np.arange(len(values), dtype=np.int32)
    done = 1
    while done < width:
        step = min(done, width - done)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        done += step
    return at


def _named(prefix: Prefix, start: np.ndarray, shift: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Hash of a stretch of ``n`` windows and of where in it the anchor is."""
    return mixed(prefix.run(start, start + n - 1 + length) + shift.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def anchors(symbols: np.ndarray, counts: np.ndarray, spec: Spec) -> tuple[np.ndarray, ...]:
    """Of each anchor: hash of its run, hash of its stretch, number of its text, place."""
    starts, windows = bounds(counts), np.maximum(counts - spec.length + 1, 0)
    if not windows.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    prefix = Prefix(symbols)
    grams = prefix.runs(spec.seed)
    texts = np.repeat(np.arange(len(counts)), windows)
    window = np.arange(len(texts)) + (starts[:-1] - (np.cumsum(windows) - windows))[texts]
    anchor = least(grams, spec.width)[window]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (texts[1:] != texts[:-1])])
    n = np.diff(np.r_[new, len(texts)])
    text, first, at = texts[new], window[new], anchor[new]
    shift = at - first
    return grams[at], _named(prefix, first, shift, n, spec.length), text, packed(first - starts[text], shift, n)


def finer(symbols: np.ndarray, counts: np.ndarray, text: np.ndarray, place: np.ndarray, size: int, spec: Spec) -> tuple[np.ndarray, ...]:
    """Stretches cut to ranges of ``size`` windows by distance from the anchor, as by :func:`anchors`."""
    at, shift, n = unpacked(place)
    low, high = (shift - n + 1) // size, shift // size
    each = np.repeat(np.arange(len(text)), high - low + 1)
    part = np.arange(len(each)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[each]
    anchor, far = (at + shift)[each], np.minimum(part * size + size - 1, shift[each])
    near = np.maximum(part * size, (shift - n + 1)[each])
    fits = anchor - near + spec.length <= counts[text[each]]
    each, part, anchor, far, near = (x[fits] for x in (each, part, anchor, far, near))
    text, prefix, n = text[each], Prefix(symbols), far - near + 1
    place = packed(anchor - far, far, n)
    anchor = anchor + bounds(counts)[text]
    end = np.minimum(part * size + size, spec.width) - 1
    run = mixed(prefix.run(anchor - part * size, anchor - end + spec.length) + part.astype(np.uint64))
    return run, _named(prefix, anchor - far, far, n, spec.length), text, place


_LONG = T.LongType()
#: Hashes of run and stretch, document and place.
ROWS = T.StructType([T.StructField(c, _LONG) for c in ("run", "name", "doc_id", "place")])
#: What a sort tells: repeats, and stretches to be cut finer.
TOLD = T.StructType([T.StructField(c, _LONG) for c in ("doc_id", "place")])


def _combined(run: np.ndarray, name: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows of a batch; those that are later copies within it are repeats already, and dealt by document."""
    order = np.lexsort((doc, name, run))
    run, name, doc, place = (x[order] for x in (run, name, doc, place))
    new = np.r_[True, (run[1:] != run[:-1]) | (name[1:] != name[:-1])]
    done = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    run, name = np.where(done, mixed(doc.view(np.uint64)), run), np.where(done, np.uint64(0), name)
    columns = [run.view(np.int64), name.view(np.int64), doc, np.where(done, ~place, place)]
    return pa.record_batch([pa.array(c) for c in columns], ROWS.fieldNames())


def _rows(docs: DataFrame, spec: Spec, size: int = 0) -> DataFrame:
    """Rows of all anchors of the texts, or of their ``stretches`` cut to ranges of ``size`` windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
            for piece in pieces(batch, "text", PIECE):
                symbols, counts = spec.symbols(filled(piece, "text"))
                if size:
                    listed = piece.column("stretches")
                    owner = pc.list_parent_indices(listed).to_numpy(zero_copy_only=False)
                    found = finer(symbols, counts, owner, listed.flatten().to_numpy(zero_copy_only=False), size, spec)
                else:
                    found = anchors(symbols, counts, spec)
                gram, name, text, place = found
                if len(gram):
                    yield gram, name, piece.column("doc_id").to_numpy()[text], place

        for batch in batches:
            for part in pieces(batch, "text", 16 * PIECE):
                if found := list(of(part)):
                    yield _combined(*map(np.concatenate, zip(*found, strict=True)))

    return docs.mapInArrow(run, ROWS)


def _settled(rows: DataFrame, parts: int) -> DataFrame:
    """Sort; tell repeats and the stretches of runs that have several; drop the others."""
    dealt = rows.repartition(parts, "run").sortWithinPartitions("run", "name", "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(doc), pa.array(place)], TOLD.fieldNames())

        # Rows of the last run that wait for a second stretch; or, once there was one, two rows that stand for it.
        kept: list[np.ndarray] | None = None
        for batch in batches:
            new = [batch.column(c).to_numpy() for c in ROWS.fieldNames()]
            done = new[3] < 0
            yield told(new[2][done], new[3][done])
            new = [x[~done] for x in new]
            new.append(np.zeros(len(new[0]), bool))  # those already told
            if kept is not None:
                new = [np.concatenate(x) for x in zip(kept, new, strict=True)]
            run, name, doc, place, old = new
            if not len(run):
                continue
            new_run = np.r_[True, run[1:] != run[:-1]]
            new_name = new_run | np.r_[True, name[1:] != name[:-1]]
            starts, run_starts = np.flatnonzero(new_name), np.flatnonzero(new_run)
            of_run = np.cumsum(new_run) - 1
            repeat = (doc > doc[starts][np.cumsum(new_name) - 1]) & ~old
            several = np.add.reduceat(new_name.astype(np.int64), run_starts)[of_run] > 1
            # A run of one document has no repeat; of the last run more may follow, and of one begun before there were more.
            lone = (np.minimum.reduceat(doc, run_starts) == np.maximum.reduceat(doc, run_starts)) & ~np.logical_or.reduceat(old, run_starts)
            lone = lone[of_run] & (of_run < of_run[-1])
            out = repeat | several & ~lone & ~old
            yield told(doc[out], np.where(repeat, ~place, place)[out])
            if several[-1]:
                # The last stretch's earliest row, after a row of another stretch: both told.
                stand = np.array([run_starts[-1], starts[-1]])
                kept = [*[x[stand] for x in new[:4]], np.ones(2, bool)]
            else:
                kept = [x[(of_run == of_run[-1]) & ~repeat] for x in new]

    return dealt.mapInArrow(read, TOLD)


def _release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are written and forgotten: it does so when the driver's JVM collects its
    garbage, which a driver with little to do puts off. Listeners hold a finished plan for a moment longer."""
    for _ in range(3):
        time.sleep(1)
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def with_repeats(docs: DataFrame, spec: Spec, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, repeats``: every document with the places of its repeats (see :func:`packed`)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    rows = every.where("doc_id IS NOT NULL")
    told = [materialize(_settled(_rows(rows, spec), parts), "repeats")]
    _release(spark)
    for size in spec.ranges:
        stretches = told[-1].where("place >= 0").groupBy("doc_id").agg(F.collect_list("place").alias("stretches"))
        # Shuffled once by document, for this sort and, where it is the last, for the result.
        dealt = rows.repartition(parts, "doc_id")
        finer_ = _settled(_rows(dealt.join(stretches, "doc_id").select("doc_id", "text", "stretches"), spec, size), parts)
        if size > 1:
            finer_ = materialize(finer_, "repeats")
            _release(spark)
        told.append(finer_)
    found = reduce(DataFrame.unionByName, [t.where("place < 0") for t in told])
    found = found.groupBy("doc_id").agg(F.collect_list("place").alias("repeats"))
    return dealt.join(found, "doc_id", "left").unionByName(
        every.where("doc_id IS NULL").withColumn("repeats", F.lit(None).cast("array<bigint>")))


def removed(counts: np.ndarray, repeats: pa.Array, length: int) -> np.ndarray:
    """For each symbol of a piece, whether a repeat covers it."""
    starts = bounds(counts)
    text = pc.list_parent_indices(repeats).to_numpy(zero_copy_only=False)
    at, _, n = unpacked(repeats.flatten().to_numpy(zero_copy_only=False))
    edge = np.zeros(starts[-1] + 1, np.int64)
    begin = np.minimum(at, counts[text]) + starts[text]
    end = np.minimum(at + n + length - 1, counts[text]) + starts[text]
    np.add.at(edge, begin, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0
