"""Secret scans over a ledger of content-addressed blobs.

A text is a blob, named by the SHA-256 of its bytes. The ledger remembers which version of which rule has seen which blob, and
what was found; an update scans only the pairs that are new, and findings are joined back to every row whose text is
that blob. Everything is built-in expressions, shuffled by blob name, so a text with a third of all rows is combined
before the shuffle and scanned once.

Defined results: a null text is the empty blob and holds nothing; repeated rows each get their findings; an empty
table gives none; other columns are ignored. A run that breaks off leaves a ledger from which the next one goes on:
findings are written before the pairs are marked as seen, and a finding written twice counts once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerlens.llm.text import given, only
from ledgerlens.session import fresh_path

MASK = "[secret]"
SALTS = 16


@dataclass(frozen=True)
class Kind:
    """Leftmost matches of ``pattern`` that do not overlap; those whose ``group`` is shorter than ``at_least`` are dropped."""

    name: str
    pattern: str
    group: int = 0
    at_least: int = 1

    @property
    def version(self) -> str:
        told = "\n".join((self.name, self.pattern, str(self.group), str(self.at_least)))
        return hashlib.sha256(told.encode()).hexdigest()[:16]


#: In the order in which spans of one start are told. Runs of one class are asked for at full length at once, which
#: finds the same runs as matching all and dropping the short ones.
BASE = (
    Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Kind("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Kind("hex", r"[0-9a-f]{16,}", 0, 16),
)
MORE = (
    Kind("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Kind("web_token", r"eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Kind("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
KINDS = BASE + MORE

SEEN = T.StructType([T.StructField("blob", T.StringType()), T.StructField("version", T.StringType())])
FOUND = T.StructType([
    T.StructField("blob", T.StringType()), T.StructField("version", T.StringType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
])


def blob_name(text: Column) -> Column:
    return F.sha2(given(text), 256)


def blobs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each different text once, with its name."""
    rows = only(docs, text).select(blob_name(F.col(text)).alias("blob"), given(F.col(text)).alias("text"))
    return rows.dropDuplicates(["blob"])


def _hits(pairs: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """Findings in rows of ``blob``, ``text``, ``todo`` (the rule versions still to run).

    A place is the length of all that stands before: the pieces between the matches and the matches themselves.
    """
    def of(kind: Kind) -> Column:
        found = F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0))
        told = F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(kind.group)) if kind.group else found
        cut = F.split("text", kind.pattern, -1)
        return F.when(
            F.array_contains("todo", kind.version) & F.col("text").rlike(kind.pattern),
            F.struct(
                F.lit(kind.version).alias("version"), F.lit(kind.at_least).alias("at_least"),
                F.arrays_zip(
                    F.transform(cut, F.length).alias("gap"), F.transform(found, F.length).alias("long"),
                    F.transform(told, F.length).alias("told"),
                ).alias("parts"),
            ),
        )

    scanned = pairs.select("blob", F.explode(F.filter(F.array(*map(of, kinds)), lambda x: x.isNotNull())).alias("hit"))
    parts = scanned.select("blob", "hit.version", "hit.at_least", F.posexplode("hit.parts").alias("i", "part"))
    before = Window.partitionBy("blob", "version").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    # The last piece has no match after it: its lengths are missing.
    end = F.sum(F.col("part.gap") + F.coalesce("part.long", F.lit(0))).over(before)
    placed = parts.withColumn("end", end).where("part.told >= at_least")
    return placed.select("blob", "version", (F.col("end") - F.col("part.long")).cast("long").alias("start"), F.col("end").cast("long"))


@dataclass(frozen=True)
class Ledger:
    """Pairs seen and findings, as two tables below one path every executor can reach."""

    path: str

    @classmethod
    def fresh(cls, spark: SparkSession) -> Ledger:
        return cls(fresh_path(spark, "secrets"))

    def _table(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{name}")
        return spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def seen(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, "seen", SEEN).distinct()

    def found(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, "found", FOUND).distinct()

    def unseen(self, docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, text: str = "text") -> DataFrame:
        """Blobs with the rule versions that have not seen them yet, where there are any."""
        every = F.array(*[F.lit(k.version) for k in kinds])
        known = self.seen(docs.sparkSession).groupBy("blob").agg(F.collect_set("version").alias("done"))
        rows = blobs(docs, text).join(known, "blob", "left")
        todo = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
        return rows.select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)

    def update(self, docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, text: str = "text") -> None:
        """Scan what is new in ``docs`` and write it down."""
        todo = self.unseen(docs, kinds, text)
        _hits(todo, kinds).write.mode("append").parquet(f"{self.path}/found")
        known = self.seen(docs.sparkSession)
        new = only(docs, text).select(blob_name(F.col(text)).alias("blob")).distinct()
        new = new.withColumn("version", F.explode(F.array(*[F.lit(k.version) for k in kinds])))
        new.join(known, ["blob", "version"], "left_anti").write.mode("append").parquet(f"{self.path}/seen")

    def spans(self, spark: SparkSession, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
        """``blob, spans``: structs of start, place of the kind, kind, end, sorted; blobs without findings have no row."""
        kind = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k.version), F.struct(F.lit(i).alias("i"), F.lit(k.name).alias("name")))])
        rows = self.found(spark).where(F.col("version").isin([k.version for k in kinds])).withColumn("kind", kind[F.col("version")])
        span = F.struct("start", F.col("kind.i").alias("place"), F.col("kind.name").alias("kind"), "end")
        return rows.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))

    def of_rows(self, docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, text: str = "text", *keep: str) -> DataFrame:
        """Findings of every row, an empty list where there are none; ``keep`` names the columns that stay."""
        rows = docs.select(*[docs[k] for k in keep], blob_name(docs[text]).alias("_blob"))
        spans = self.spans(docs.sparkSession, kinds)
        out = _beside(rows, spans)
        none = F.array().cast(spans.schema["spans"].dataType)
        return out.select(*keep, F.coalesce("spans", none).alias("spans"))


def _beside(rows: DataFrame, by_blob: DataFrame) -> DataFrame:
    """Each row with what ``by_blob`` knows of its ``_blob``. Blobs with findings are repeated per salt, so that the rows of one that is
    everywhere are dealt to several tasks."""
    salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    every = by_blob.withColumn("_each", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(every, (F.col("_blob") == F.col("blob")) & (F.col("_salt") == F.col("_each")), "left")


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, ledger: Ledger | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: numbers of base findings, their digest, and all spans."""
    ledger = ledger or Ledger.fresh(docs.sparkSession)
    ledger.update(docs, KINDS, text)
    out = ledger.of_rows(docs, KINDS, text, doc_id)
    count = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")
    return out.select(
        doc_id, *[count(k.name).alias(f"n_{k.name}") for k in KINDS],
        F.sha2(_told(F.filter("spans", lambda s: s["place"] < len(BASE))), 256).alias("base_sha256"),
        _told(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, ledger: Ledger | None = None, text: str = "text", mask: str = MASK) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask``; spans that touch or overlap become one mask."""
    ledger = ledger or Ledger.fresh(docs.sparkSession)
    ledger.update(docs, KINDS, text)
    spans = ledger.spans(docs.sparkSession).select("blob", F.posexplode("spans").alias("i", "s"))
    before = Window.partitionBy("blob").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("blob", "s.start", "s.end", F.coalesce(F.max("s.end").over(before), F.lit(0)).alias("from"))
    # A piece is kept before each span that starts beyond all earlier ones, and one after the last.
    pieces = spans.where("start > from OR (start = 0 AND from = 0)").withColumn("piece", F.struct("from", (F.col("start") - F.col("from")).alias("n")))
    cuts = pieces.groupBy("blob").agg(F.sort_array(F.collect_set("piece")).alias("_pieces"))
    cuts = cuts.join(spans.groupBy("blob").agg(F.max("end").alias("_tail")), "blob")
    rows = docs.select(F.struct("*").alias("_row"), docs[text].alias("_text"))
    rows = rows.withColumn("_blob", blob_name(F.col("_text")))
    rows = _beside(rows, cuts)
    part = lambda p: F.substring("_text", (p["from"] + 1).cast("int"), p["n"].cast("int"))
    tail = F.substring("_text", (F.col("_tail") + 1).cast("int"), F.length("_text"))
    clean = F.array_join(F.concat(F.transform("_pieces", part), F.array(tail)), mask)
    rows = rows.withColumn("_clean", F.when(F.col("_tail").isNull(), F.col("_text")).otherwise(clean))
    return rows.select(*[F.col("_clean").alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns])
