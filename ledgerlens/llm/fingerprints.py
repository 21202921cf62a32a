"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

A paragraph is a run of up to eight words that ends with its sentence or line. Each is hashed to a wide vector: 4 lanes of 64 uniform
bits and 256 lanes of +1 or -1. A text's fingerprint is the sum over its paragraphs, modulo 2^64 in the first lanes and 2^32 in the others. So the order of paragraphs does not
matter, inserting or deleting one is an addition or subtraction, and equal multisets are equal. The signed lanes also
tell how alike two texts are: their inner product estimates the number of common paragraphs (each twice as
often where both have it twice), with a standard error of about one part in sixteen. No text is long enough to wrap a signed lane.

Defined results: a null text is empty; the fingerprint of an empty text is all zero, alike (1) to another empty one and 0 to others;
other columns are ignored; repeated rows get equal fingerprints; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.arrow import filled, pieces
from ledgerlens.llm.text import given

EXACT, SIGNED = 4, 256
_PARAGRAPH = re.compile(r"(?:\S*[^\s.!?][ \t]+){0,7}\S+")
#: Text bytes whose paragraphs are expanded to vectors at once.
PIECE = 1 << 20


def paragraphs(text: str) -> list[str]:
    return _PARAGRAPH.findall(text)


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Exact lanes (uint64) and signed lanes (int32) of each text."""
    known: dict[str, int] = {}
    codes, counts = [], []
    for text in texts:
        found = paragraphs(text)
        counts.append(len(found))
        codes.extend([known.setdefault(p, len(known)) for p in found])
    wide = EXACT * 8 + SIGNED // 8
    raw = b"".join(hashlib.blake2b(p.encode(), digest_size=wide).digest() for p in known)
    table = np.frombuffer(raw, np.uint8).reshape(-1, wide)
    exact = table[:, : EXACT * 8].copy().view("<u8")
    signed = np.unpackbits(table[:, EXACT * 8 :], axis=1).astype(np.int8) * np.int8(2) - np.int8(1)
    sums = np.zeros((len(texts), EXACT), np.uint64), np.zeros((len(texts), SIGNED), np.int32)
    full = np.flatnonzero(counts)
    if len(full):
        at, starts = np.array(codes), (np.cumsum(counts) - counts)[full]
        sums[0][full] = np.add.reduceat(exact[at], starts, axis=0)
        sums[1][full] = np.add.reduceat(signed[at], starts, axis=0, dtype=np.int32)
    return sums


def told(exact: np.ndarray, signed: np.ndarray) -> str:
    return base64.b64encode(exact.astype("<u8").tobytes() + signed.astype("<i4").tobytes()).decode()


def read(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[: EXACT * 8], "<u8"), np.frombuffer(raw[EXACT * 8 :], "<i4")


def changed(fingerprint: str, added: str = "", removed: str = "") -> str:
    """The fingerprint after paragraphs were put in and others taken out, without the rest of the text."""
    exact, signed = read(fingerprint)
    (plus, minus), (plus_s, minus_s) = (x for x in vectors([added, removed]))
    return told(exact + plus - minus, signed + plus_s - minus_s)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for each pair of rows of signed lanes."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    both, size = 2 * (a * b).sum(axis=1), (a * a).sum(axis=1) + (b * b).sum(axis=1)
    return np.where(size > 0, np.clip(both / np.where(size > 0, size, 1), 0, 1), 1.0)


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id and fingerprint. No shuffle."""
    kept = docs.schema[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, PIECE):
                out = [told(*x) for x in zip(*vectors(filled(piece, text).to_pylist()), strict=True)]
                yield pa.record_batch([piece.column(doc_id), pa.array(out, pa.string())], [doc_id, "fingerprint"])

    return docs.select(doc_id, text).mapInArrow(run, T.StructType([kept, T.StructField("fingerprint", T.StringType())]))


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``bucket, guest, doc_id, tie, text``, sorted in their partitions so that each document is followed by the next one.

    Buckets are ranges of ids between quantiles, four to a partition. The first document of a bucket is also put at
    the end of the bucket before it, as a guest; after the last document comes the first. What reaches the driver is one id per bucket.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), given(docs[text]).alias("text"))
    cuts = sorted(set(rows.approxQuantile("doc_id", [i / (4 * parts) for i in range(1, 4 * parts)], 1 / (16 * parts))))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        # Missing ids come first.
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(cuts, ids.fillna(0), "right"))).astype("int32")

    rows = rows.withColumns({"bucket": bucket_of("doc_id"), "tie": F.xxhash64("text")})
    first = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "tie")
    firsts = sorted(rows.groupBy("bucket").agg(F.min(first).alias("first")).select("bucket", "first.doc_id", "first.tie").collect())
    before = [(firsts[i - 1]["bucket"], f["doc_id"], f["tie"]) for i, f in enumerate(firsts)]
    hosts = spark.createDataFrame(before, "host int, host_id long, host_tie long")
    guests = rows.join(F.broadcast(hosts), F.col("doc_id").eqNullSafe(F.col("host_id")) & (F.col("tie") == F.col("host_tie")))
    every = rows.select("bucket", F.lit(False).alias("guest"), "doc_id", "tie", "text").unionByName(
        guests.select(F.col("host").alias("bucket"), F.lit(True).alias("guest"), "doc_id", "tie", "text"))
    return every.repartition(parts, "bucket").sortWithinPartitions("bucket", "guest", F.asc_nulls_first("doc_id"), "tie")


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form: the last quarter of its characters replaced by the first as many (or all)
    of the next document by ascending id. Rows of equal id follow each other by a hash of their text."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
    ])

    def rows_of(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
        after = [t[: len(t) - len(t) // 4] + f[: len(t) // 4] for t, f in zip(texts, following, strict=True)]
        exact, signed = vectors(texts + following[-1:])
        new_exact, new_signed = vectors(after)
        # Each text is followed by the next of the list, but where a bucket ends: its guest is not in the list.
        beside = signed[1:].copy()
        lone = [i for i in range(len(texts) - 1) if following[i] is not texts[i + 1]]
        if lone:
            beside[lone] = vectors([following[i] for i in lone])[1]
        columns = [
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in after]),
            pa.array([told(*x) for x in zip(exact[:-1], signed[:-1], strict=True)]),
            pa.array([told(*x) for x in zip(new_exact, new_signed, strict=True)]),
            pa.array(likeness(signed[:-1], new_signed)), pa.array(likeness(signed[:-1], beside)),
        ]
        return pa.record_batch(columns, schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the document that waits for the next one: bucket, id, text
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                ids, texts, following = [], [], []
                for bucket, guest, id_, text_ in zip(*[piece.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text")], strict=True):
                    if held and held[0] == bucket:
                        ids.append(held[1])
                        texts.append(held[2])
                        following.append(text_)
                    held = None if guest else (bucket, id_, text_)
                if ids:
                    yield rows_of(ids, texts, following)

    return in_order(docs, doc_id, text).select("bucket", "guest", "doc_id", "text").mapInArrow(run, schema)
