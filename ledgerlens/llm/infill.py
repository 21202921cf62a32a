"""Fill-in-middle documents: prefix, middle and suffix of a text put in the order in which a model learns to fill the middle.

A text is cut into units, its lines, and the units into chunks of bounded size. Each chunk is a piece keyed by its document and its place in the output,
markers are pieces too. One shuffle deals the pieces by document and sorts them by place within each partition (``repartitionAndSortWithinPartitions``), so
that an output of any length streams by, piece by piece. Restoration reads that stream again: it tells the three parts by the markers that pass, keys what
lies between by its place in the text, and sorts within the same partitions. The partitioner is the same, so the second sort moves nothing between executors.

What is decided for a document follows from a digest of its id alone: the two cuts, whether it is transformed, and which order it takes.

Defined results: a null text is empty, an empty text stays plain, as does one that holds a marker; a null id is digested as an empty string; rows that repeat
an id, or are equal altogether, are rows of their own, told apart by digest and number, and equal rows are dealt to several partitions; a text without line ends is one unit, cut into
pieces all the same; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.text import only

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: The order of the parts in each form; within the original text it is prefix, middle, suffix.
ORDERS = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
TEXT_ORDER = (PREFIX, MIDDLE, SUFFIX)
SALT = "7:"
#: Of 100 documents, how many are transformed, and of these how many take the order that begins with the suffix.
RATE, SPM_RATE = 100, 50
#: UTF-8 bytes of a piece.
CHUNK = 256 << 10
#: Text bytes of a partition of pieces.
PARTITION = 32 << 20

#: Document: digest of its text, id, number of the task that read it, number among equal rows of that task.
Key = tuple[bytes, int, int, int]


@dataclass(frozen=True)
class Cut:
    """What is decided for a document."""

    n: int
    form: str
    parts: dict[str, str]


def cut(doc_id: int | None, text: str, rate: int = RATE, spm_rate: int = SPM_RATE, salt: str = SALT) -> Cut:
    """Units, form and parts of one document."""
    n = text.count("\n") + (text != "" and text[-1] != "\n")
    told = hashlib.sha256(f"{salt}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(told[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(m in text for m in TEXT_ORDER) or h[2] % 100 >= rate:
        return Cut(n, PLAIN, {"": text})
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a = _after(text, first, n, 0, 0)
    b = _after(text, second, n, first, a)
    return Cut(n, SPM if h[3] % 100 < spm_rate else PSM, {PREFIX: text[:a], MIDDLE: text[a:b], SUFFIX: text[b:]})


def _after(text: str, units: int, n: int, done: int, at: int) -> int:
    """Place after the first ``units`` units, when ``done`` of them end at ``at``."""
    if units == n:
        return len(text)
    for _ in range(units - done):
        at = text.index("\n", at) + 1
    return at


def chunks(part: str, limit: int = CHUNK) -> Iterator[bytes]:
    """Whole units, as many as fit, as UTF-8; a unit above the limit is cut."""
    at = 0
    while at < len(part):
        end = at + limit // 4  # so many code points always fit
        if end < len(part):
            whole = part.rfind("\n", at, end) + 1
            end = whole if whole > at else end
        yield part[at:end].encode()
        at = end


def _pieces(rows: Iterator, rate: int, spm_rate: int, limit: int) -> Iterator[tuple[tuple[Key, int], tuple]]:
    """``((document, place), value)``: place 0 holds what is decided, the others bytes of the output, in order."""
    task = TaskContext.get().partitionId()
    equal: dict[tuple[bytes, int], int] = {}
    for doc_id, text in rows:
        text = text or ""
        name = hashlib.blake2b(text.encode(), digest_size=16).digest(), -1 if doc_id is None else doc_id
        equal[name] = number = equal.get(name, -1) + 1
        key = (*name, task, number)
        made = cut(doc_id, text, rate, spm_rate)
        chars = (None, None) if made.form == PLAIN else (len(made.parts[PREFIX]), len(made.parts[MIDDLE]))
        yield (key, 0), (doc_id, made.n, made.form, *chars)
        place = 1
        for mark in ORDERS.get(made.form, ("",)):
            marker = [mark.encode()] if mark else []
            for chunk in chain(marker, chunks(made.parts[mark], limit)):
                yield (key, place), (chunk,)
                place += 1


def _dealt(key: tuple[Key, int]) -> int:
    """Partition of a piece: all of a row go to one, equal rows to different ones."""
    name, doc_id, task, number = key[0]
    return int.from_bytes(name[:8], "big") + doc_id + 31 * task + 1009 * number


def assembled(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = RATE, spm_rate: int = SPM_RATE, limit: int = CHUNK, partitions: int | None = None,
) -> RDD:
    """The outputs as sorted pieces: ``((document, place), value)``, all pieces of a document next to each other in one partition.

    The number of partitions follows the bytes of text, which one scan adds up. Place 0 holds ``(doc_id, n, form, prefix_chars, middle_chars)``, the others one chunk of output bytes each.
    """
    rows = only(docs, doc_id, text)
    if partitions is None:
        size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
        partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION))
    return rows.rdd.mapPartitions(lambda it: _pieces(it, rate, spm_rate, limit)).repartitionAndSortWithinPartitions(partitions, _dealt)


def _original(pieces: Iterator) -> Iterator:
    """The same pieces keyed by their place in the text, by the output and its form alone: a marker that passes names the part that follows.

    The first value of a document also carries the digest of its output.
    """
    for key, group in groupby(pieces, lambda p: p[0][0]):
        _, told = next(group)
        out, part, place = hashlib.sha256(), 0, 0
        marks = {m.encode(): k for k, m in enumerate(TEXT_ORDER)} if told[2] != PLAIN else {}
        for _, (chunk,) in group:
            out.update(chunk)
            if chunk in marks:
                part = marks[chunk]
            else:
                place += 1
                yield (key, 1 + part, place), (chunk,)
        yield (key, 0, 0), (*told, out.hexdigest())


def restored(pieces: RDD) -> RDD:
    """The texts that :func:`assembled` was made of, as sorted pieces ``((document, part, place), value)``: first what is decided and the digest of the
    output, then the chunks of the text in order. Sorted where they lie."""
    keyed = pieces.mapPartitions(_original, preservesPartitioning=True)
    return keyed.repartitionAndSortWithinPartitions(pieces.getNumPartitions(), pieces.partitioner.partitionFunc)


def _digests(pieces: Iterator) -> Iterator[tuple]:
    for _, group in groupby(pieces, lambda p: p[0][0]):
        _, told = next(group)
        text = hashlib.sha256()
        for _, (chunk,) in group:
            text.update(chunk)
        yield (*told, text.hexdigest())


def _joined(pieces: Iterator) -> Iterator[tuple]:
    for _, group in groupby(pieces, lambda p: p[0][0]):
        _, told = next(group)
        yield (*told, b"".join(chunk for _, (chunk,) in group).decode())


def _schema(docs: DataFrame, doc_id: str, *more: str) -> T.StructType:
    long = [T.StructField(c, T.LongType()) for c in ("prefix_chars", "middle_chars")]
    head = [T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n", T.LongType()), T.StructField("form", T.StringType())]
    return T.StructType([*head, *long, *(T.StructField(c, T.StringType()) for c in more)])


def _table(docs: DataFrame, pieces: RDD, read: Callable, doc_id: str, *more: str) -> DataFrame:
    return docs.sparkSession.createDataFrame(pieces.mapPartitions(read), _schema(docs, doc_id, *more), verifySchema=False)


def transformed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: the documents as a model reads them."""
    return _table(docs, assembled(docs, doc_id, text, **options), _joined, doc_id, "output")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``: neither outputs nor texts are held whole."""
    return _table(docs, restored(assembled(docs, doc_id, text, **options)), _digests, doc_id, "output_sha256", "restored_sha256")
