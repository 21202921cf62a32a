"""Counts of the classes of every vendor, from which its usual group and subgroup are told without reading a line.

A row holds a company, vendor, group, subgroup and manual flag with their number of lines. It has the columns of a ledger line that the vendor rules
read, so unifying the counts tells what unifying the lines would give.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.aggregates import vendor_modes

CLASS = ("grupo", "subgrupo", "clasificacion_manual")
KEY = ("empresa", "nombre_tercero", *CLASS)


def counts(ledger: DataFrame) -> DataFrame:
    """Lines by company, vendor, group, subgroup and manual flag; a common vendor travels as a few combinations."""
    return ledger.groupBy(*KEY).agg(F.count(F.lit(1)).alias("filas"))


def added_up(known: DataFrame) -> DataFrame:
    """One row per combination; combinations without lines go."""
    return known.groupBy(*KEY).agg(F.sum("filas").alias("filas")).filter(F.col("filas") > 0)


def changes(lines: DataFrame) -> DataFrame:
    """What changed lines, each with its class and that of before (``antes_grupo`` and so on), bring to the counts. Lines that keep their class bring nothing."""
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"antes_{c}")) for c in CLASS])
    entry = lambda before, sign: F.struct(*[F.col(f"{before}{c}").alias(c) for c in CLASS], F.lit(sign).cast("long").alias("filas"))
    moved = lines.filter(~same).select("empresa", "nombre_tercero", F.inline(F.array(entry("antes_", -1), entry("", 1))))
    return moved.groupBy(*KEY).agg(F.sum("filas").alias("filas")).filter(F.col("filas") != 0)


def corrected(known: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """The counts after lines changed: what they were is taken out, what they are is put in."""
    minus = removed.select(*KEY, (-F.col("filas")).alias("filas"))
    return added_up(known.select(*KEY, "filas").unionByName(minus).unionByName(added.select(*KEY, "filas")))


def modes(known: DataFrame) -> DataFrame:
    """:func:`~ledgerlens.operators.aggregates.vendor_modes` of the lines that were counted."""
    return vendor_modes(known, F.sum("filas"))
