"""Totals, counts, modes and top lists."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions import columns as X
from ledgerlens.operators.filters import account_prefix_filter, pending_all


def summary(ledger: DataFrame, year: int = 2025) -> DataFrame:
    """Total by company and month of one year. The year is a date range, so that files prune."""
    of_year = ledger.filter(
        F.col("fecha_corte").between(F.lit(date(year, 1, 1)), F.lit(date(year, 12, 31)))
    )
    return (
        account_prefix_filter(of_year)
        .groupBy("empresa", X.month("fecha_corte").alias("periodo"))
        .agg(X.money_sum("valor").alias("total"))
        .orderBy("periodo", "empresa")
    )


def categories(ledger: DataFrame) -> DataFrame:
    """Distinct groups and subgroups in use, as (kind, value); one scan."""
    kinds = F.array(*[
        F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ("grupo", "subgrupo")
    ])
    return (
        ledger.select(F.inline(kinds))
        .filter(X.given("value"))
        .distinct()
        .orderBy("kind", "value")
    )


def _most_frequent(kind: str) -> Column:
    """Value with the highest count of one kind; the smallest among equals; nulls never win."""
    ranked = F.when(
        (F.col("kind") == kind) & F.col("value").isNotNull(),
        F.struct((-F.col("n")).alias("less"), F.col("value").alias("value")),
    )
    return F.min(ranked)["value"]


def _value_counts(df: DataFrame, key: str, kinds: Sequence[str], total: Column | None = None, lines: Column | None = None) -> DataFrame:
    """(key, kind, value) -> n, total.

    Rows are first counted by the key and all kinds together, before the first shuffle, so a key
    with a large part of all rows travels as a few combinations. The total is carried by the first
    kind only.
    """
    combined = df.groupBy(key, *kinds).agg(
        (F.count(F.lit(1)) if lines is None else lines).alias("n"),
        F.sum(total if total is not None else F.lit(None).cast(X.MONEY)).alias("t"),
    )
    entries = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.col(kind).alias("value"),
            (F.col("t") if i == 0 else F.lit(None).cast("decimal(30,4)")).alias("t"),
        )
        for i, kind in enumerate(kinds)
    ]
    return (
        combined.select(key, "n", F.inline(F.array(*entries)))
        .groupBy(key, "kind", "value")
        .agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    )


def vendor_modes(ledger: DataFrame, lines: Column | None = None) -> DataFrame:
    """Most frequent group and, independently, subgroup of every named vendor. ``lines`` adds up the lines that rows stand for, one each by default."""
    named = ledger.filter(
        F.col("grupo").isNotNull() & ~F.col("nombre_tercero").isin("", C.NO_VENDOR_ID)
    )
    return (
        _value_counts(named, "nombre_tercero", ("grupo", "subgrupo"), lines=lines)
        .groupBy("nombre_tercero")
        .agg(
            _most_frequent("grupo").alias("grupo_comun"),
            _most_frequent("subgrupo").alias("subgrupo_comun"),
        )
    )


def vendor_rollup(view: DataFrame, limit: int = C.TOP_VENDORS) -> DataFrame:
    """Vendors with the largest totals, their usual status, group and subgroup and their companies."""
    kinds = ("empresa", "status_gestion", "grupo", "subgrupo")
    companies = F.collect_set(F.when(F.col("kind") == "empresa", F.col("value")))
    return (
        _value_counts(view, "nombre_tercero", kinds, X.exact("valor"))
        .groupBy("nombre_tercero")
        .agg(
            F.array_join(F.sort_array(companies), ", ").alias("empresa"),
            _most_frequent("grupo").alias("grupo"),
            _most_frequent("subgrupo").alias("subgrupo"),
            F.sum("t").cast("double").alias("valor"),
            _most_frequent("status_gestion").alias("status_gestion"),
        )
        .withColumn("valor_fmt", X.amount_label("valor"))
        .orderBy(F.desc("valor"), F.asc("nombre_tercero"))
        .limit(limit)
    )


def vendor_class_counts(transactions: DataFrame, vendor: str) -> DataFrame:
    """Rows per vendor, group and subgroup for vendors whose name contains the text."""
    return (
        transactions.filter(X.contains_ignoring_case("nombre_tercero", vendor))
        .groupBy("nombre_tercero", "grupo", "subgrupo")
        .agg(F.count(F.lit(1)).alias("registros"))
    )


def kpi_country_totals(view: DataFrame) -> DataFrame:
    """Grand total and the totals of the three countries, in one pass."""
    amount, zero = X.exact("valor"), F.lit(0.0)
    of = lambda country: F.sum(F.when(F.col("pais") == country, amount)).cast("double")
    return view.agg(
        F.coalesce(F.sum(amount).cast("double"), zero).alias("total"),
        F.coalesce(of("Chile"), zero).alias("total_chile"),
        F.coalesce(of("Colombia"), zero).alias("total_colombia"),
        F.coalesce(of("Perú"), zero).alias("total_peru"),
    )


def explorer_kpis(transactions: DataFrame) -> DataFrame:
    """Rows, total and number of companies."""
    by_company = transactions.groupBy("empresa").agg(
        F.count(F.lit(1)).alias("n"), F.sum(X.exact("valor")).alias("t")
    )
    return by_company.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("registros"),
        F.coalesce(F.sum("t").cast("double"), F.lit(0.0)).alias("monto_total"),
        F.count("empresa").alias("empresas"),
    )


def top_groups(view: DataFrame, limit: int = C.TOP_GROUPS) -> DataFrame:
    """Largest groups by total, shown from small to large."""
    return (
        view.groupBy("grupo")
        .agg(X.money_sum("valor").alias("valor"))
        .orderBy(F.desc("valor"), F.asc("grupo"))
        .limit(limit)
        .orderBy(F.asc("valor"), F.desc("grupo"))
    )


def pending_count(ledger: DataFrame) -> DataFrame:
    return pending_all(ledger).agg(F.count(F.lit(1)).alias("pendientes"))


def classified_count(ledger: DataFrame) -> DataFrame:
    """Rows that carry a group."""
    return ledger.filter(X.given("grupo")).agg(F.count(F.lit(1)).alias("clasificados"))


#: What a pass that writes a source counts on the way.
OBSERVED = ("filas", "total", "fechas_rechazadas", "importes_rechazados")


def observed(rows: DataFrame, seen: Observation) -> DataFrame:
    """The same rows; the job that writes them counts lines, their exact total, and lines with a rejected date or amount."""
    told = lambda field: F.count(F.when(F.col("rechazo").contains(f"{field}="), 1))
    rejected = "rechazo" in rows.columns
    return rows.observe(
        seen, F.count(F.lit(1)).alias("filas"), F.coalesce(X.money_sum("valor"), F.lit(0.0)).alias("total"),
        (told("fecha_transaccion") if rejected else F.lit(0).cast("long")).alias("fechas_rechazadas"),
        (told("valor") if rejected else F.lit(0).cast("long")).alias("importes_rechazados"),
    )


def ingest_audit(registry: DataFrame, counts: DataFrame, failures: DataFrame) -> DataFrame:
    """One row per registered source: what the pass that wrote its rows counted, its state, and the error of a source that failed.

    A failed source with counts is one whose earlier rows were carried over.
    """
    audit = registry.select("empresa").join(counts, "empresa", "left").join(failures.select("empresa", "error"), "empresa", "left")
    return audit.select(
        "empresa",
        F.coalesce("filas", F.lit(0)).alias("filas"),
        F.when(F.col("error").isNull(), F.lit("ok")).when(F.col("filas") > 0, F.lit("conservado"))
        .otherwise(F.lit("error")).alias("estado"),
        "error",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in OBSERVED[1:]],
    )
