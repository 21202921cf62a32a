"""Byte-level BPE by a sentencepiece model written straight from a rank table.

Every token of the table becomes a piece: its bytes, each mapped to one printable character, with minus its rank as score, so that
sentencepiece merges in the order of the ranks. Normalisation is the identity, white space is neither added nor escaped.
Texts are cut into pre-tokens; each is encoded alone, a pre-token that is itself a token at once.
Decoding maps ids back to their bytes.

The model (about 1 MB, bound by the vocabulary) is built on the driver and sent with the code; each worker loads it once. Rows
are worked on where they lie, without a shuffle.

Defined results: a null text is empty and has no tokens; repeated rows get equal ids; other columns are ignored or
kept as the caller names them; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlens.llm.arrow import filled, pieces
from ledgerlens.llm.text import only

#: Pre-tokens remembered by a worker; then it starts anew. Longer ones than this many characters are not remembered.
REMEMBERED, SHORT = 150_000, 40


def ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks, from lines of base64 and rank."""
    with open(path, "rb") as file:
        table = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
    if sorted(table) != list(range(len(table))):
        raise ValueError(f"{path}: ranks must run from 0 without a gap")
    return [table[r] for r in range(len(table))]


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it is printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: float, length-delimited or varint by the type of ``value``."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(int(value))


def serialise(tokens: list[bytes]) -> bytes:
    """ModelProto: piece 0 is the unknown piece, piece ``r + 1`` the token of rank ``r``."""
    letters = byte_letters()
    rows = [_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)]
    rows += [_field(1, "".join(letters[b] for b in t).encode()) + _field(2, -float(r)) + _field(3, 1) for r, t in enumerate(tokens)]
    # model type 2: BPE; vocabulary size; no bos, eos or pad piece.
    trainer = _field(3, 2) + _field(4, len(rows)) + _field(40, 0) + b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))
    # no dummy prefix, white space neither removed nor escaped.
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, r) for r in rows) + _field(2, trainer) + _field(3, normaliser)


@dataclass
class Coder:
    """Encoder and decoder of a worker, from what the driver sent."""

    tokens: list[bytes]
    model: bytes
    pattern: str
    _known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        import regex
        import sentencepiece

        self._whole = {t: r for r, t in enumerate(self.tokens)}
        self._told = [str(r) for r in range(len(self.tokens))]
        self._letters = dict(enumerate(byte_letters()))
        self._split = regex.compile(self.pattern).findall
        self._model = sentencepiece.SentencePieceProcessor(model_proto=self.model)

    def _learn(self, parts: Iterable[str]) -> list[str]:
        """Remember the ids of pre-tokens not yet known; the long ones among them."""
        new = [p for p in parts if p not in self._known]
        if len(self._known) + len(new) > REMEMBERED:
            self._known.clear()
            new = list(parts)
        merged = []
        for p in new:
            raw = p.encode()
            if (rank := self._whole.get(raw)) is not None:
                self._known[p] = (rank,)
            else:
                merged.append((p, raw.decode("latin-1").translate(self._letters)))
        if merged:
            found = self._model.encode([m for _, m in merged], num_threads=1)
            self._known.update((p, tuple(i - 1 for i in ids)) for (p, _), ids in zip(merged, found, strict=True))
        return [p for p in new if len(p) > SHORT]

    def encode(self, text: str) -> list[int]:
        parts = self._split(text)
        try:
            return list(chain.from_iterable(map(self._known.__getitem__, parts)))
        except KeyError:
            different = set(parts)
        if len(different) > REMEMBERED:  # more than fit: in runs
            runs = (parts[i : i + REMEMBERED] for i in range(0, len(parts), REMEMBERED))
            return list(chain.from_iterable(map(self._run, runs)))
        long = self._learn(different)
        out = list(chain.from_iterable(map(self._known.__getitem__, parts)))
        for p in long:
            del self._known[p]
        return out

    def _run(self, parts: list[str]) -> list[int]:
        self._known.clear()
        self._learn(set(parts))
        return list(chain.from_iterable(map(self._known.__getitem__, parts)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def told(self, ids: list[int]) -> str:
        return ",".join(map(self._told.__getitem__, ids))


_CODERS: dict[tuple[str, str], Coder] = {}


@dataclass(frozen=True)
class Vocabulary:
    """What the driver sends: tokens by rank, the serialised model and the pre-token pattern."""

    tokens: tuple[bytes, ...]
    model: bytes
    pattern: str

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        tokens = ranks(path)
        return cls(tuple(tokens), serialise(tokens), pattern)

    def coder(self) -> Coder:
        """The worker's coder, made once."""
        key = hashlib.sha256(self.model).hexdigest(), self.pattern
        if key not in _CODERS:
            _CODERS[key] = Coder(list(self.tokens), self.model, self.pattern)
        return _CODERS[key]


def encode(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its ids as an array of integers, how many they are, and the digest of what they decode to."""
    kept = docs.schema[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary.coder()
        for batch in batches:
            for piece in pieces(batch, text):
                ids = [coder.encode(t) for t in filled(piece, text).to_pylist()]
                back = [hashlib.sha256(coder.decode(x)).hexdigest() for x in ids]
                columns = [piece.column(doc_id), pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64()), pa.array(back, pa.string())]
                yield pa.record_batch(columns, schema.fieldNames())

    schema = T.StructType([
        kept, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("decoded_sha256", T.StringType()),
    ])
    return only(docs, doc_id, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per document: the bytes its ids stand for."""
    kept = encoded.schema[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary.coder()
        for batch in batches:
            out = pa.array([coder.decode(x or []) for x in batch.column(ids).to_pylist()], pa.binary())
            yield pa.record_batch([batch.column(doc_id), out], [doc_id, "bytes"])

    schema = T.StructType([kept, T.StructField("bytes", T.BinaryType())])
    return only(encoded, doc_id, ids).mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode in one pass: number of tokens, digest of the ids, digest of the decoded bytes."""
    kept = docs.schema[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary.coder()
        for batch in batches:
            for piece in pieces(batch, text):
                n, told, back = [], [], []
                for t in filled(piece, text).to_pylist():
                    ids = coder.encode(t)
                    n.append(len(ids))
                    told.append(hashlib.sha256(coder.told(ids).encode()).hexdigest())
                    back.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                columns = [piece.column(doc_id), pa.array(n, pa.int64()), pa.array(told, pa.string()), pa.array(back, pa.string())]
                yield pa.record_batch(columns, [doc_id, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([
        kept, T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ])
    return only(docs, doc_id, text).mapInArrow(run, schema)
