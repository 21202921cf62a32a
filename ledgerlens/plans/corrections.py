"""Corrections of the stored ledger that cost what they touch.

The lines that a correction hits are found by a join over few columns, their companies alone are rewritten, and the next version points to the
untouched folders of the one before. What changed lines bring to the rollup and the vendor counts comes to these as further rows; they are added up where
they are read, and written anew once a company has ``MERGE_AFTER`` such parts.
Vendors are unified by their counts: these tell the usual classes and the companies with a line to change before a line is read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import classifier as M
from ledgerlens.operators import rollup as R
from ledgerlens.operators import vendor_counts as V
from ledgerlens.operators import writeback as W
from ledgerlens.operators.filters import is_pending
from ledgerlens.session import materialize
from ledgerlens.sources.tables import amend_version, extend_version, parts_of_partition, read_version, versions, write_version

ROLLUP = "rollup"
VENDOR_COUNTS = "vendor_counts"
#: Parts of a company's sums from which they are written anew.
MERGE_AFTER = 8
#: What the sums read of a line besides its class.
_SUMMED = ("empresa", "fecha_corte", "cuenta_contable", "nombre_tercero", "valor")
_MONTH = ("mes",)
_VENDOR = ("nombre_tercero",)


@dataclass(frozen=True)
class Corrected:
    """The version a correction made, or the one in use if it hit nothing, and the companies it rewrote."""

    version: int
    companies: tuple[str | None, ...]


def _of(companies: list[str | None]) -> Column:
    """Test for the rows of some companies, on the partition column alone."""
    named = F.col("empresa").isin([c for c in companies if c is not None])
    return named | F.col("empresa").isNull() if None in companies else named


def read_rollup(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rollup of a ledger version, the latest by default; made and stored where the version has none yet."""
    number = versions(spark, root)[-1] if number is None else number
    if number not in versions(spark, f"{root}/{ROLLUP}"):
        write_version(R.rollup(read_version(spark, root, number)), f"{root}/{ROLLUP}", sort_within=_MONTH, number=number)
    return _added_up(spark, f"{root}/{ROLLUP}", number, R.added_up)


def read_vendor_counts(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The vendor counts of a ledger version, the latest by default; made and stored where the version has none yet."""
    number = versions(spark, root)[-1] if number is None else number
    if number not in versions(spark, f"{root}/{VENDOR_COUNTS}"):
        write_version(V.counts(read_version(spark, root, number)), f"{root}/{VENDOR_COUNTS}", sort_within=_VENDOR, number=number)
    return _added_up(spark, f"{root}/{VENDOR_COUNTS}", number, V.added_up)


def _added_up(spark: SparkSession, table: str, number: int, added_up: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A version of a table of sums, with what corrections brought to it."""
    rows = read_version(spark, table, number)
    return added_up(rows) if parts_of_partition(spark, table, number) > 1 else rows


def _bring(changes: DataFrame, table: str, base: int, number: int, added_up: Callable[[DataFrame], DataFrame], sort_within: tuple[str, ...]) -> None:
    """The next version of a table of sums: what corrected lines bring comes to it."""
    spark = changes.sparkSession
    if parts_of_partition(spark, table, base) < MERGE_AFTER:
        extend_version(changes, table, base, sort_within=sort_within, number=number)
    else:
        rows = read_version(spark, table, base)
        write_version(added_up(rows.unionByName(changes.select(*rows.columns))), table, sort_within=sort_within, number=number)


def _correct(spark: SparkSession, root: str, key: str, reduced: DataFrame, change: Callable[[DataFrame], DataFrame]) -> Corrected:
    base = versions(spark, root)[-1]
    ledger = read_version(spark, root, base)
    hit = ledger.join(reduced.select(key), key, "left_semi")
    beside = [name for name in (ROLLUP, VENDOR_COUNTS) if base in versions(spark, f"{root}/{name}")]
    if beside:
        # Few columns of the lines hit, with their classes of before; written once, as three jobs read them.
        hit = change(hit.withColumns({f"antes_{c}": F.col(c) for c in V.CLASS})).select(*_SUMMED, *V.CLASS, *[f"antes_{c}" for c in V.CLASS])
        hit = materialize(hit, "hit")
    # One row per company reaches the driver.
    companies = [r[0] for r in hit.select("empresa").distinct().collect()]
    if not companies:
        return Corrected(base, ())
    number = amend_version(change(ledger.filter(_of(companies))), root, base)
    if ROLLUP in beside:
        _bring(R.changes(hit), f"{root}/{ROLLUP}", base, number, R.added_up, _MONTH)
    if VENDOR_COUNTS in beside:
        _bring(V.changes(hit), f"{root}/{VENDOR_COUNTS}", base, number, V.added_up, _VENDOR)
    return Corrected(number, tuple(companies))


def correct_by_id(spark: SparkSession, root: str, updates: DataFrame) -> Corrected:
    """:func:`~ledgerlens.operators.writeback.update_by_id` on the stored ledger, as its next version."""
    reduced = materialize(W.reduced_by_id(updates), "updates")
    return _correct(spark, root, "id_transaccion", reduced, lambda rows: W.set_by_id(rows, reduced))


def correct_by_vendor(spark: SparkSession, root: str, updates: DataFrame) -> Corrected:
    """:func:`~ledgerlens.operators.writeback.update_by_vendor` on the stored ledger, as its next version."""
    reduced = materialize(W.reduced_by_vendor(updates), "updates")
    return _correct(spark, root, "nombre_tercero", reduced, lambda rows: W.set_by_vendor(rows, reduced))


def unify_stored(spark: SparkSession, root: str) -> Corrected:
    """:func:`~ledgerlens.operators.writeback.unify_vendor` on the stored ledger, as its next version."""
    return _unify(spark, root, None)


def classify_stored(spark: SparkSession, root: str, model: M.ExpenseClassifier) -> Corrected:
    """:func:`~ledgerlens.operators.classifier.classify_pending` on the stored ledger, as its next version."""
    return _unify(spark, root, M.filled(read_version(spark, root), model))


def _unify(spark: SparkSession, root: str, scored: DataFrame | None) -> Corrected:
    """Pending rows replaced by ``scored``, if given, then vendors unified. Companies without a scored row or a row to unify are not read."""
    base = versions(spark, root)[-1]
    ledger, known = read_version(spark, root, base), read_vendor_counts(spark, root, base)
    if scored is not None:
        known = V.corrected(known, V.counts(ledger.filter(is_pending())), V.counts(scored))
        known = materialize(known, "vendor-counts")
    modes = materialize(V.modes(known), "modes")
    unified = W.unify_vendor_flagged(known, modes)
    hit = unified.filter("unificado").select("empresa")
    # One row per company reaches the driver.
    companies = [r[0] for r in (hit if scored is None else hit.union(scored.select("empresa"))).distinct().collect()]
    if not companies:
        return Corrected(base, ())
    rows = ledger.filter(_of(companies))
    if scored is not None:
        rows = rows.filter(~is_pending()).unionByName(scored)
    number = amend_version(W.unify_vendor(rows, modes), root, base)
    after = V.added_up(unified.filter(_of(companies)))
    amend_version(after, f"{root}/{VENDOR_COUNTS}", base, sort_within=_VENDOR, number=number)
    if base in versions(spark, f"{root}/{ROLLUP}"):
        lines = read_version(spark, root, number).filter(_of(companies))
        amend_version(R.rollup(lines), f"{root}/{ROLLUP}", base, sort_within=_MONTH, number=number)
    return Corrected(number, tuple(companies))
