"""What is known about each company's journal: layout, start, accepted accounts, voucher rule."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerlens import config as C
from ledgerlens import schemas as S

@dataclass(frozen=True)
class Location:
    """Where one table lies: a reader format with its options, and a path for file formats. A database table may be read in
    parts, one for each of ``predicates``, which must hold for every row exactly once (``sources/ranges.py``)."""

    format: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    predicates: tuple[str, ...] = ()


@dataclass(frozen=True)
class SourceSpec:
    empresa: str
    layout: str
    since: date
    prefixes: tuple[str, ...] = C.JOURNAL_PREFIXES
    by_year: bool = False
    voucher_rule: str | None = None
    tables: dict[str, Location] = field(default_factory=dict)

    def starting(self, since: date) -> SourceSpec:
        return replace(self, since=since)

    def located(self, tables: dict[str, Location]) -> SourceSpec:
        missing = set(S.JOURNAL_TABLES[self.layout]) - set(tables)
        # Without a status test no voucher table is read.
        if self.voucher_rule != "status":
            missing.discard("voucher")
        if missing:
            raise ValueError(f"{self.empresa}: no location for {sorted(missing)}")
        return replace(self, tables=dict(tables))


_2024, _2025 = date(2024, 1, 1), date(2025, 1, 1)

# Extraction rules of the thirteen journals.
SOURCES = (
    SourceSpec("CONIX", "A", _2025, ("5",)),
    SourceSpec("GFO", "B", _2024, ("5",)),
    SourceSpec("LTCP", "C", _2025),
    SourceSpec("LTCP2", "C", _2025),
    SourceSpec("NCPF", "C", _2025),
    SourceSpec("NC LEASING PERU", "C", _2025),
    SourceSpec("AFI", "D", _2025, voucher_rule="number"),
    SourceSpec("LTC", "D", _2025, voucher_rule="number"),
    SourceSpec("NC SPA", "D", _2025, voucher_rule="status"),
    SourceSpec("NC LEASING CHILE", "D", _2025, voucher_rule="status"),
    SourceSpec("NC SA", "D", _2025, ("3", "42"), by_year=True, voucher_rule="status"),
    SourceSpec("IN SA", "D", _2025, voucher_rule="status"),
    SourceSpec("INCOFIN LEASING", "E", _2025),
)


def spec_of(empresa: str) -> SourceSpec:
    return next(s for s in SOURCES if s.empresa == empresa)


def registry_table(spark: SparkSession, specs: Iterable[SourceSpec] = SOURCES) -> DataFrame:
    """The registry as rows, for joins with what was loaded."""
    rows = [
        (s.empresa, s.layout, s.since, ",".join(s.prefixes), s.voucher_rule) for s in specs
    ]
    return spark.createDataFrame(
        rows, "empresa string, layout string, since date, prefixes string, voucher_rule string"
    )


def exclusions_table(spark: SparkSession, path: str) -> DataFrame:
    """Excluded accounts of every company, kept as a CSV with the columns empresa, cuenta_contable."""
    return spark.read.schema(S.EXCLUSIONS).option("header", True).csv(path)
