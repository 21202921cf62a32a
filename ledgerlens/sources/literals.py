"""The engine's small inline tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens import config as C
from ledgerlens import schemas as S


def debt_book(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(C.DEBT_BOOK), S.DEBT_BOOK)


def portfolio(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(C.PORTFOLIO), S.PORTFOLIO)


def concepts(spark: SparkSession) -> DataFrame:
    rows = [(category, name, i) for category, names in C.CONCEPTS.items() for i, name in enumerate(names)]
    return spark.createDataFrame(rows, S.CONCEPTS)
