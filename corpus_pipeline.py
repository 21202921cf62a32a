"""Corpus pipeline: quality rules, near-duplicates, secrets, mixing, tokens.

Each stage takes the documents that its predecessor kept and returns those it keeps, with the columns of ``documents``;
the last returns their tokens. Between stages the documents are written to the shared folder, so a lost executor costs a
re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, minhash, mixing, quality, secrets
from ledgerlens.llm.catalog import vocabulary
from ledgerlens.session import materialize


#: Percent of common shingles from which the near-duplicate stage links; op1's own contract asks for more.
NEAR = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id."""
    return minhash.keep_one(docs, percent=NEAR)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets are masked and lengths follow."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics meet their weights."""
    return mixing.sample(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, and the digest of the text they decode to."""
    return bpe.encode(docs, vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing", target_mix),
    ("byte-level bpe", byte_bpe),
]

#: Near-duplicates and tokens have no SQL; tests hold the pipeline against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
