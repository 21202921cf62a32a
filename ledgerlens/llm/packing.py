"""Best-fit packing of tokenised documents into sequences of fixed length, by a grouping genetic algorithm.

Documents become ids and an end id; only what is longer than a sequence is cut, and the first piece takes the odd length. Pieces are dealt at random to groups of
bounded size, each packed on its own: a group wastes at most its last sequence, whatever the number of documents. Pieces of one length are interchangeable, so a
group is known by its sorted lengths, and a packing is the sequence number of each of them.

Every group is evolved on several islands, each a row of a table with the group's lengths and a population of packings. A child takes whole well-filled sequences of one parent,
then the sequences of the other that hold none of the injected pieces; sequences with duplicates are taken apart, and their remaining pieces are
displaced and put back best-fit, the longest first. After an epoch each island's best packing migrates to the next island of its ring by a shuffle, and the
best of all islands is kept. A packing that needs no more sequences than any packing must is done at once.

Defined results: a null text is empty and becomes the end id alone; a null id is kept; repeated rows are packed each for itself; texts are read whole, in runs that end where a pre-token ends;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.arrow import filled, pieces
from ledgerlens.llm.bpe import byte_letters
from ledgerlens.llm.text import only
from ledgerlens.session import materialize

#: Tokens of a sequence, and the id that ends a document.
LENGTH = 2048
END = 0
#: Pieces of a group, and islands of a task.
GROUP, TASK = 32768, 16
#: Islands of a group, packings of an island, children a generation, epochs.
ISLANDS, POPULATION, CHILDREN, EPOCHS = 3, 8, 4, 2
#: Generations of an epoch: few for a large group, more for a small one, of about so many placed pieces.
GENERATIONS, WORK = 4, 200_000
#: Share of a parent's sequences that are injected, the best-filled first.
INJECTED = 0.5
SEED = 13
#: Characters encoded at once, and white space in a row beyond which the pattern's library runs out of stack.
RUN, SPACES = 1 << 20, 4096


@dataclass
class Tokens:
    """Ids of texts by a byte-level BPE in the format of the ``tokenizers`` library, as that library gives them.

    The same vocabulary run by ``tiktoken`` is four times as fast, and splits and merges alike; texts with very long white space go to ``tokenizers`` itself.
    """

    model: str
    pattern: str
    _made: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str, pattern: str) -> Tokens:
        return cls(Path(path).read_text(encoding="utf-8"), pattern)

    def _coders(self) -> tuple:
        if not self._made:
            import json

            import tiktoken
            from tokenizers import Tokenizer

            told = json.loads(self.model)
            back = {c: b for b, c in enumerate(byte_letters())}
            ranks = {bytes(back[c] for c in t): r for t, r in told["model"]["vocab"].items() if r not in {a["id"] for a in told["added_tokens"]}}
            if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in told["added_tokens"]) or told["pre_tokenizer"] != {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
            }:
                raise ValueError("not a plain byte-level tokenizer")
            special = {a["content"]: a["id"] for a in told["added_tokens"]}
            fast = tiktoken.Encoding("packing", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens=special)
            self._made.update(fast=fast, slow=Tokenizer.from_str(self.model))
        return self._made["fast"], self._made["slow"]

    def __getstate__(self) -> dict:
        return {"model": self.model, "pattern": self.pattern, "_made": {}}

    def encode(self, text: str) -> np.ndarray:
        fast, slow = self._coders()
        out = []
        for run in runs(text):
            if len(run) >= SPACES and _SPACES.search(run):
                out.append(np.array(slow.encode(run, add_special_tokens=False).ids, np.uint32))
            else:
                out.append(fast.encode_to_numpy(run, allowed_special="all"))
        return np.concatenate([*out, [END]]).astype("<u4")


_SPACES = re.compile(rf"\s{{{SPACES}}}")
_CUT = re.compile(r"(?<=\S)\s")


def runs(text: str, limit: int = RUN) -> Iterator[str]:
    """Runs of about ``limit`` characters, cut before white space that follows something else, where a pre-token always begins."""
    at = 0
    while len(text) - at > limit:
        found = _CUT.search(text, at + limit)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


_TOKENS: dict[int, Tokens] = {}


def cut(docs: DataFrame, tokens: Tokens, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids`` of every piece of every document."""
    kept = docs.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _TOKENS.setdefault(hash((tokens.model, tokens.pattern)), tokens)
        for batch in batches:
            for part in pieces(batch, text):
                rows = []
                for row, t in enumerate(filled(part, text).to_pylist()):
                    ids = coder.encode(t)
                    first = (len(ids) - 1) % length + 1
                    for k, end in enumerate(range(first, len(ids) + 1, length)):
                        start = max(0, end - length)
                        rows.append((row, k, start, end - start, zlib.crc32(ids[start:end]), *([ids[start:end].astype(np.int32)] if with_ids else [])))
                at, *columns = map(list, zip(*rows, strict=True)) if rows else [[]] * (len(kinds) + 1)
                yield pa.record_batch([
                    part.column(doc_id).take(pa.array(at, pa.int64())), *(pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)),
                ], schema.fieldNames())

    long = T.LongType()
    schema = T.StructType([
        T.StructField("doc_id", kept), T.StructField("piece", T.IntegerType()), T.StructField("start", long), T.StructField("length", long),
        T.StructField("ids_crc32", long), *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
    ])
    kinds = [pa.int32(), *[pa.int64()] * 3, *([pa.list_(pa.int32())] if with_ids else [])]
    return only(docs, doc_id, text).mapInArrow(run, schema)


class Room:
    """Open sequences by what is left in them; the fullest that still takes a piece is found by one look at a number's bits."""

    def __init__(self, length: int) -> None:
        self.by_left: list[list[int]] = [[] for _ in range(length + 1)]
        self.some = 0

    def add(self, bin_: int, left: int) -> None:
        if left:
            self.by_left[left].append(bin_)
            self.some |= 1 << left

    def take(self, size: int) -> tuple[int, int] | None:
        """The fullest sequence with room for ``size``, and what is left in it; it is open no longer."""
        fits = self.some >> size
        if not fits:
            return None
        left = size + (fits & -fits).bit_length() - 1
        bins = self.by_left[left]
        out = bins.pop()
        if not bins:
            self.some ^= 1 << left
        return out, left


#: Sequences as lists of pieces, and what is in each.
Packing = tuple[list[list[int]], list[int]]


def best_fit(sizes: list[int], order: list[int], begun: Packing, length: int) -> Packing:
    """Put the pieces of ``order`` into the sequences begun, each where the least room stays, or into new ones."""
    bins, loads = begun
    room = Room(length)
    for k, load in enumerate(loads):
        room.add(k, length - load)
    for i in order:
        size = sizes[i]
        found = room.take(size)
        if found is None:
            bins.append([i])
            loads.append(size)
            room.add(len(bins) - 1, length - size)
        else:
            k, left = found
            bins[k].append(i)
            loads[k] += size
            room.add(k, left - size)
    return bins, loads


def least_bins(sizes: np.ndarray, length: int = LENGTH) -> int:
    """No packing has fewer sequences: pieces above half a sequence stand alone, and share their room only with what fits beside them."""
    sizes = np.asarray(sizes, np.int64)
    best = -(-int(sizes.sum()) // length)
    half = sizes[sizes > length // 2]
    rest = np.sort(sizes[sizes <= length // 2])
    sums = np.concatenate([[0], np.cumsum(rest)])
    for k in np.unique(rest):
        alone, beside = int((half > length - k).sum()), half[half <= length - k]
        small = int(sums[-1] - sums[np.searchsorted(rest, k, "left")])
        best = max(best, alone + len(beside) + max(0, -(-(small - int((length - beside).sum())) // length)))
    return max(best, len(half))


def fitness(packing: Packing, length: int) -> tuple[int, float]:
    """Fewer sequences first, then the fuller ones: the mean square of their fill."""
    fills = np.array(packing[1]) / length
    return -len(fills), float((fills**2).mean())


def crossed(one: Packing, two: Packing, sizes: list[int], length: int, rng: np.random.Generator) -> Packing:
    """A child of two packings: whole well-filled sequences of ``one`` injected into ``two``, duplicates removed, what is displaced put back best-fit."""
    # Noise in the order gives different children of the same parents.
    fills = np.array(one[1]) / length - rng.random(len(one[1])) * 0.4
    chosen = np.argsort(-fills)[: max(1, int(len(fills) * INJECTED))].tolist()
    bins, loads = [list(one[0][k]) for k in chosen], [one[1][k] for k in chosen]
    held = {i for b in bins for i in b}
    displaced = []
    for b, load in zip(*two, strict=True):
        if held.isdisjoint(b):
            bins.append(list(b))
            loads.append(load)
        else:
            displaced += [i for i in b if i not in held]
    # Mutation: a few of the emptiest sequences are taken apart as well.
    loose = np.argsort(loads, kind="stable")[: int(rng.integers(1, 5))].tolist()
    for k in sorted(loose, reverse=True):
        displaced += bins.pop(k)
        del loads[k]
    # Pieces are numbered from the longest on.
    return best_fit(sizes, sorted(displaced), (bins, loads), length)


def _packing(numbers: np.ndarray, sizes: np.ndarray) -> Packing:
    order = np.argsort(numbers, kind="stable")
    bins = [p.tolist() for p in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1)]
    return bins, np.bincount(numbers, weights=sizes).astype(int).tolist()


def _numbers(packing: Packing, n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for k, b in enumerate(packing[0]):
        out[b] = k
    return out


def evolve(sizes: np.ndarray, elites: list[np.ndarray], island: int, epoch: int, length: int = LENGTH, seed: int = SEED) -> list[np.ndarray]:
    """The population of an island after an epoch, the best first; ``sizes`` are falling. Without ``elites`` it begins with best-fit decreasing and variants of it."""
    n, plain = len(sizes), [int(s) for s in sizes]
    rng = np.random.default_rng([seed, island, epoch, n, int(sizes.sum())])
    goal = least_bins(sizes, length)
    population = [_packing(np.asarray(e), sizes) for e in elites]
    if not population:
        population.append(best_fit(plain, list(range(n)), ([], []), length))
    while len(population) < POPULATION and len(population[0][0]) > goal:
        order = np.argsort(-(sizes * (1 + 0.1 * rng.random(n))), kind="stable")
        population.append(best_fit(plain, order.tolist(), ([], []), length))
    rated = sorted(((fitness(p, length), p) for p in population), key=lambda x: x[0], reverse=True)
    for _ in range(max(GENERATIONS, WORK // (n * CHILDREN))):
        if -rated[0][0][0] <= goal:
            break
        for _ in range(CHILDREN):
            a, b = rng.choice(len(rated), 2, replace=False)
            child = crossed(rated[a][1], rated[b][1], plain, length, rng)
            rated.append((fitness(child, length), child))
        rated = sorted(rated, key=lambda x: x[0], reverse=True)[:POPULATION]
    return [_numbers(p, n) for _, p in rated]


_STATE = "group_no long, island int, epoch int, sizes array<int>, elites array<array<int>>"


def _epoch(state: DataFrame, length: int, tasks: int) -> DataFrame:
    """Every island evolved on its own; a row is an island, a task has few."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row, = batch.slice(k, 1).to_pylist()
                sizes = np.array(row["sizes"], np.int64)
                found = evolve(sizes, [np.array(e) for e in row["elites"]], row["island"], row["epoch"], length)
                yield pa.record_batch([
                    pa.array([row["group_no"]], pa.int64()), pa.array([row["island"]], pa.int32()), pa.array([row["epoch"] + 1], pa.int32()),
                    pa.array([sizes.astype(np.int32)], pa.list_(pa.int32())), pa.array([[e.tolist() for e in found]], pa.list_(pa.list_(pa.int32()))),
                ], ["group_no", "island", "epoch", "sizes", "elites"])

    return state.repartition(tasks, "group_no", "island").mapInArrow(run, _STATE)


def _migrated(state: DataFrame) -> DataFrame:
    """Each island's best packing moves on to the next of its group's ring, where it takes the place of the worst."""
    own = state.select("*", F.lit(False).alias("moved"))
    moved = state.select("group_no", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), "epoch", "sizes", F.slice("elites", 1, 1).alias("elites"), F.lit(True).alias("moved"))
    both = own.unionByName(moved).groupBy("group_no", "island").agg(
        F.first("epoch").alias("epoch"), F.first("sizes").alias("sizes"), F.max_by("elites", ~F.col("moved")).alias("own"), F.max_by("elites", "moved").alias("new"),
    )
    kept = F.slice("own", F.lit(1), F.greatest(F.lit(1), F.size("own") - 1))
    return both.select("group_no", "island", "epoch", "sizes", F.concat(kept, "new").alias("elites"))


def packed(cuts: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """The rows of ``cuts``, which has a ``length``, with ``sequence_id`` and ``offset``; columns of these names are replaced."""
    spark = cuts.sparkSession
    named = [c for c in cuts.columns if c not in ("sequence_id", "offset")]
    rows = cuts.select(F.struct(*[cuts[c] for c in named]).alias("row"), cuts["length"].cast("int").alias("size"), F.monotonically_increasing_id().alias("dealt"))
    # Written before it is dealt, so that a row has one number for good.
    rows = materialize(rows, "pieces")
    groups = max(1, -(-rows.count() // group))
    # At random: groups are of about one size, and alike, however often a row is repeated.
    rows = rows.withColumn("group_no", F.pmod(F.xxhash64("dealt"), F.lit(groups)))
    islands = groups * ISLANDS
    tasks = min(islands, max(-(-islands // TASK), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ordered = F.expr("array_sort(collect_list(struct(size, dealt)), (a, b) -> CASE WHEN a.size <> b.size THEN b.size - a.size WHEN a.dealt < b.dealt THEN -1 ELSE 1 END)")
    known = materialize(rows.select("group_no", "size", "dealt").groupBy("group_no").agg(ordered.alias("members")), "groups")
    state = known.select(
        "group_no", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.lit(0).alias("epoch"), F.col("members.size").alias("sizes"),
        F.array().cast("array<array<int>>").alias("elites"),
    )
    for k in range(EPOCHS):
        state = _epoch(_migrated(state) if k else state, length, tasks)
    state = materialize(state, "islands")
    # Fewest sequences; the first island among equals.
    best = state.groupBy("group_no").agg(F.min_by(F.element_at("elites", 1), F.struct(F.array_max(F.element_at("elites", 1)), "island")).alias("bins"))
    placed = known.join(best, "group_no").select("group_no", F.explode(F.arrays_zip(F.col("members.dealt").alias("dealt"), F.col("members.size").alias("size"), "bins")).alias("m"))
    placed = placed.select("group_no", "m.*")
    own = "PARTITION BY group_no, bins ORDER BY size DESC, dealt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    placed = placed.select("dealt", (F.col("group_no") * (1 << 32) + F.col("bins")).alias("sequence_id"), (F.expr(f"sum(size) OVER ({own})") - F.col("size")).cast("long").alias("offset"))
    return rows.join(placed, "dealt").select("row.*", "sequence_id", "offset")


def pack(docs: DataFrame, tokens: Tokens, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece of every document with its ids, its sequence and its place there."""
    return packed(cut(docs, tokens, length, doc_id, text), length)


def places(docs: DataFrame, tokens: Tokens, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As :func:`pack`, with the checksum of each piece's ids in place of the ids."""
    return packed(cut(docs, tokens, length, doc_id, text, with_ids=False), length)
