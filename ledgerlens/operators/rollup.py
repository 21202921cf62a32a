"""One table of exact totals from which the ledger's sums are answered, kept up to date by the rows a correction changes.

A row holds a company, month, account prefix, vendor and group with their exact total and number of lines. It has the shape of a
ledger line (:func:`as_ledger`), so the operators that add up lines run on it unchanged and read as many rows as there are combinations, not lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions import columns as X
from ledgerlens.operators.canonical import display_defaults

KEY = ("empresa", "mes", "prefijo", "nombre_tercero", "grupo")
#: Characters of an account that tell every prefix the reports ask for.
PREFIX = max(len(p) for p in (*C.EXPENSE_PREFIXES, *C.JOURNAL_PREFIXES))
#: ``con_importe`` counts the lines that add to the total, so that a total of nothing stays null.
_SUMS = ("total", "filas", "con_importe")


def rollup(ledger: DataFrame) -> DataFrame:
    """Exact total, lines, and lines with an amount, by company, month, account prefix, vendor and group.

    Lines without a closing date have a null month. Lines are added up before the shuffle, so a vendor or company with
    a large part of all lines travels as a few combinations.
    """
    amount = X.exact("valor")
    return ledger.groupBy(*_of_line(), "grupo").agg(
        F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(38,6)").alias("total"), F.count(F.lit(1)).alias("filas"), F.count(amount).alias("con_importe"),
    )


def _of_line() -> list[Column]:
    """What a line gives of the key besides its group."""
    return [F.col("empresa"), F.trunc("fecha_corte", "MM").alias("mes"), F.substring("cuenta_contable", 1, PREFIX).alias("prefijo"), F.col("nombre_tercero")]


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sum("total").cast("decimal(38,6)").alias("total"), *[F.sum(c).alias(c) for c in _SUMS[1:]])


def added_up(rows: DataFrame) -> DataFrame:
    """One row per combination of a rollup and the changes that came to it; combinations without lines go."""
    return _sums(rows).filter(F.col("filas") > 0)


def changes(lines: DataFrame) -> DataFrame:
    """What changed lines, each with its group and that of before (``antes_grupo``), bring to the rollup: what they were is taken out, what they are is put in.
    Lines that keep their group bring nothing."""
    amount = X.exact("valor")
    entry = lambda group, sign: F.struct(
        F.col(group).alias("grupo"), (F.coalesce(amount, F.lit(0)) * sign).cast(X.MONEY).alias("total"), F.lit(sign).cast("long").alias("filas"),
        F.when(amount.isNull(), 0).otherwise(sign).cast("long").alias("con_importe"),
    )
    moved = lines.filter(~F.col("grupo").eqNullSafe(F.col("antes_grupo"))).select(*_of_line(), F.inline(F.array(entry("antes_grupo", -1), entry("grupo", 1))))
    return _sums(moved).filter((F.col("filas") != 0) | (F.col("con_importe") != 0) | (F.col("total") != 0))


def as_ledger(known: DataFrame) -> DataFrame:
    """The rollup as ledger lines, each the lines of its combination in one, dated on the first of the month."""
    return known.select(
        "empresa", F.col("mes").alias("fecha_corte"), F.col("prefijo").alias("cuenta_contable"), "nombre_tercero", "grupo",
        F.when(F.col("con_importe") > 0, F.col("total")).alias("valor"),
    )


def as_view(known: DataFrame) -> DataFrame:
    """The rollup as the dashboards see lines. Totals stay exact, as amounts are no text here."""
    shown = display_defaults(as_ledger(known).withColumnRenamed("valor", "_exact"))
    return shown.withColumnRenamed("_exact", "valor")
