"""How far the sources of each language differ in their words.

The documents are cut into terms once, into a table partitioned by language. For each language ``CountVectorizer`` with a minimum number of
documents and the largest vocabulary it allows keeps every term that enough documents hold, and turns each document into an exact sparse vector of counts.
The vectors are added up by group of (language, source) inside each task, in whole numbers, before the shuffle, so that a source with a third of all rows
travels as one number a term and task. Groups become whole-number shares. Two groups' distance is taken over the terms that either holds: what neither holds adds the
same amount a term, so the sum over the whole vocabulary follows without it. Sources are compared block by block and term range by term range, each a bounded
task, and only one number a pair leaves it.

The vocabulary of a language (terms that at least ``min_df`` documents hold) passes through the driver, as ``CountVectorizer`` has it; counts, sums and pairs do not.
One fit is made per language, each over its own part of the table alone.

Defined results: a null text, language or source is read as empty; a group without kept terms has the share that no occurrence gives; a language without
kept terms has distances of 0 and no terms; repeated rows count as often as they stand; texts are read whole; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.arrow import pieces
from ledgerlens.llm.text import given
from ledgerlens.session import fresh_path, materialize

#: Terms are runs of ASCII letters, lowered, and of bytes beyond ASCII; every other byte is a gap and becomes a blank.
TERM_BYTES = np.array([b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)], np.uint8)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_DF = 30
#: Occurrences added to each term, and the whole that shares are parts of.
SMOOTHING = 5
WHOLE = 1_000_000_000
TOP = 50
#: No limit on the vocabulary beyond that of an integer.
VOCABULARY = 2**31 - 1
#: Sources and terms of one comparing task.
SOURCES = 256
TERMS = 4096
#: Numbers that a task which adds up vectors holds, unless a single vocabulary is larger.
HELD = 1 << 23
#: Stands in every document, so that a vocabulary is never empty; no term can be it. A text that begins or ends with a gap has it more than once.
MARK = ""


def _terms(texts: pa.Array) -> pa.Array:
    """The terms of each text, after a ``MARK``: what stands before the blank put at the start of each."""
    led = pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type))
    valid, ends, data = led.buffers()
    lowered = pa.py_buffer(TERM_BYTES[np.frombuffer(data, np.uint8)])
    return pc.ascii_split_whitespace(pa.Array.from_buffers(led.type, len(led), [valid, ends, lowered]))


def tokenised(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> str:
    """Path of the written table ``source, terms`` of all documents, partitioned by ``of``, a digest of the language."""
    path = fresh_path(docs.sparkSession, "terms")
    rows = docs.select(
        F.md5(given(docs[lang])).alias("of"), given(docs[lang]).alias("lang"), given(docs[source]).alias("source"), given(docs[text]).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield pa.record_batch([*(piece.column(c) for c in ("of", "lang", "source")), _terms(piece.column("text"))], ["of", "lang", "source", "terms"])

    rows.mapInArrow(run, "of string, lang string, source string, terms array<string>").write.partitionBy("of").parquet(path)
    return path


def _group_sums(vectors: DataFrame, size: int, held: int = HELD) -> DataFrame:
    """``source, term_no, n`` of sparse vectors ``source, i, v``: each task adds up whole numbers by source before they travel.

    A task holds one row of ``size`` numbers a source; when those pass ``held`` they are handed on and begun again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for source, row in sums.items():
                at = np.flatnonzero(row)
                yield pa.record_batch([pa.array([source] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(row[at])], ["source", "term_no", "n"])
            sums.clear()

        for batch in batches:
            coded = pc.dictionary_encode(batch.column("source"))
            of_row = coded.indices.to_numpy()
            for k, source in enumerate(coded.dictionary.to_pylist()):
                mine = batch.filter(pa.array(of_row == k))
                at, inverse = np.unique(mine.column("i").flatten().to_numpy(), return_inverse=True)
                # Whole numbers below 2^53, as no batch holds more words.
                n = np.bincount(inverse, mine.column("v").flatten().to_numpy(), len(at)).astype(np.int64)
                if source not in sums:
                    if sums and (len(sums) + 1) * size > held:
                        yield from told()
                    sums[source] = np.zeros(size, np.int64)
                sums[source][at] += n
        yield from told()

    return vectors.mapInArrow(run, "source string, term_no int, n long").groupBy("source", "term_no").agg(F.sum("n").alias("n"))


def _of_language(rows: DataFrame, lang: str, min_df: int) -> tuple[DataFrame, list[str]]:
    """Occurrences of each kept term by source, ``lang, source, term_no, n``, and the kept terms by number."""
    coder = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=VOCABULARY)
    model = coder.fit(rows)
    vector = F.unwrap_udt("vector")
    vectors = model.transform(rows).select("source", vector["indices"].alias("i"), vector["values"].alias("v"))
    return _group_sums(vectors, len(model.vocabulary)).select(F.lit(lang).alias("lang"), "source", "term_no", "n"), model.vocabulary


def counts(docs: DataFrame, min_df: int = MIN_DF, text: str = "text", lang: str = "lang", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """``lang, source, term, term_no, n`` of every kept term that occurs in a group, and all groups as ``lang, source``. Both are written."""
    spark = docs.sparkSession
    path = tokenised(docs, text, lang, source)
    table = spark.read.schema("lang string, source string, terms array<string>, of string").parquet(path)
    groups = materialize(table.groupBy("of", "lang", "source").agg(F.count("*").alias("documents")), "groups")
    sums, words = [], []
    for of, name, _ in groups.groupBy("of", "lang").agg(F.sum("documents").alias("n")).where(F.col("n") >= min_df).collect():
        found, vocabulary = _of_language(table.where(F.col("of") == of), name, min_df)
        sums.append(found)
        words.append(spark.createDataFrame(pa.table({"lang": [name] * len(vocabulary), "term_no": pa.array(range(len(vocabulary)), pa.int32()), "term": vocabulary})))
    groups = groups.select("lang", "source")
    if not sums:
        return spark.createDataFrame([], "lang string, source string, term string, term_no int, n long"), groups
    terms = reduce(DataFrame.unionAll, words).where(F.col("term") != MARK)
    told = reduce(DataFrame.unionAll, sums).join(terms, ["lang", "term_no"]).select("lang", "source", "term", "term_no", "n")
    return materialize(told, "counts"), groups


def share(n: Column, total: Column, terms: Column, smoothing: int = SMOOTHING) -> Column:
    """``1 + floor(WHOLE * (n + smoothing) / (total + smoothing * terms))`` in whole numbers; null without terms."""
    wide = lambda c: c.cast("decimal(27,0)")
    over, under = F.lit(WHOLE).cast("decimal(10,0)") * wide(n + smoothing), wide(total + F.lit(smoothing).cast("long") * terms)
    return F.when(terms > 0, F.call_function("div", over, under) + F.lit(1).cast("long"))


def _pair_parts(shares: DataFrame) -> DataFrame:
    """``lang, a, b, part`` for a < b: what the terms of either add to the distance beyond a term that neither holds."""
    blocks = F.ceil(F.col("sources") / SOURCES).cast("int")
    rows = shares.withColumn("block", F.pmod(F.xxhash64("source"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other"), "range": (F.col("term_no") / TERMS).cast("int")})

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        at, names = pd.factorize(group["source"], sort=True)
        which, terms = pd.factorize(group["term_no"])
        none = np.zeros(len(names), np.int64)
        none[at] = group["none"]
        block = np.zeros(len(names), np.int64)
        block[at] = group["block"]
        table = np.tile(none, (len(terms), 1))
        table[which, at] = group["p"]
        apart = group["i"].iat[0] != group["j"].iat[0]
        out = []
        for k in range(len(names)):
            later = np.arange(k + 1, len(names))
            if apart:
                later = later[block[later] != block[k]]
            part = np.abs(table[:, later] - table[:, [k]]).sum(0) - len(terms) * np.abs(none[later] - none[k])
            out.append(pd.DataFrame({"lang": group["lang"].iat[0], "a": names[k], "b": names[later], "part": part}))
        return pd.concat(out)

    parts = rows.select("lang", "i", "j", "range", "source", "block", "term_no", "p", "none")
    parts = parts.groupBy("lang", "i", "j", "range").applyInPandas(compare, "lang string, a string, b string, part long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))


def audit(
    docs: DataFrame, min_df: int = MIN_DF, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each group its distance to every other source of the language (part ``pair``), and
    the terms it has most above the language's share (part ``term``, up to ``top``); rank 1 is the largest value, ties by item."""
    found, groups = counts(docs, min_df, text, lang, source)
    kept = found.select("lang", "term_no").distinct().groupBy("lang").agg(F.count("*").alias("terms"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(kept, "lang", "left")
    of_lang = of_lang.join(totals.groupBy("lang").agg(F.sum("total").alias("lang_total")), "lang", "left")
    facts = groups.join(totals, ["lang", "source"], "left").join(of_lang, "lang").na.fill(0, ["total", "terms", "lang_total"])
    facts = materialize(facts.withColumn("none", share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))), "groups")

    shares = found.join(facts, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    shares = shares.withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang", "term_no")))
    ranked = lambda df: df.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).select("lang", "source", "part", "item", "value", "rank")
    above = shares.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (
        F.col("p") - share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).alias("value")).where("value > 0")

    one = facts.select("lang", "source", "terms", "none")
    two = facts.select("lang", F.col("source").alias("item"), F.col("none").alias("_none"))
    pairs = one.join(two, "lang").where(F.col("source") != F.col("item"))
    pairs = pairs.withColumns({"a": F.least("source", "item"), "b": F.greatest("source", "item")}).join(_pair_parts(shares), ["lang", "a", "b"], "left")
    value = F.coalesce(F.col("terms") * F.abs(F.col("none") - F.col("_none")), F.lit(0)) + F.coalesce("part", F.lit(0))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))
    return ranked(pairs).unionAll(ranked(above).where(F.col("rank") <= top))
