"""Joins: lookups of any size, voucher headers, templates, debt shares."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens import config as C
from ledgerlens.functions import columns as X

# Offending keys named in an error, besides their number.
_NAMED = 20


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join with a lookup whose ``key`` is unique and named alike on both sides.

    Adaptive execution broadcasts the lookup when it turns out small, and else splits the partitions of a vendor or a
    null key with a third of all rows.
    """
    return facts.join(lookup, key, "left")


@dataclass(frozen=True)
class Dimensions:
    """Client, account and cost-centre tables of a star journal, with unique keys."""

    tables: dict[str, tuple[DataFrame, str]]


def check_dims(client: DataFrame, account: DataFrame, cost_centre: DataFrame) -> Dimensions:
    """Fail on repeated keys, which would multiply ledger rows; one job for all dimensions."""
    tables = {
        "client": (client.select("Cli_Rut", "Cli_Nombre"), "Cli_Rut"),
        "account": (account.select("Cta_Codigo", "Cta_Glosa"), "Cta_Codigo"),
        "cost_centre": (cost_centre.select("Cdc_Codigo", "Cdc_glosa"), "Cdc_Codigo"),
    }
    keys = [
        df.filter(F.col(key).isNotNull()).select(F.lit(name).alias("name"), F.col(key).cast("string").alias("k"))
        for name, (df, key) in tables.items()
    ]
    repeated = reduce(DataFrame.unionAll, keys).groupBy("name", "k").count().filter("count > 1")
    first = F.row_number().over(Window.partitionBy("name").orderBy("k"))
    found = {r.name: r for r in repeated.withColumn("_first", first).groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.when(F.col("_first") <= _NAMED, F.col("k")))).alias("keys"),
    ).collect()}
    for name, (_, key) in tables.items():
        if name in found:
            keys, n = found[name]["keys"], found[name].n
            more = f" and {n - len(keys)} more" if n > len(keys) else ""
            raise ValueError(f"{name}: repeated values of {key}: {', '.join(keys)}{more}")
    return Dimensions(tables)


def enrich_dims(detail: DataFrame, dims: Dimensions) -> DataFrame:
    """Journal lines with client name, account gloss and cost-centre gloss."""
    for dim, key in dims.tables.values():
        detail = lookup_join(detail, dim, key)
    return detail


def join_header(detail: DataFrame, voucher: DataFrame) -> DataFrame:
    """Journal lines with the status of their voucher; lines without a voucher fall away, as no
    status test could accept them."""
    return detail.join(
        voucher.select("Com_Numero", "Com_Periodo", "Com_Estado"), ["Com_Numero", "Com_Periodo"]
    )


def join_detail_header(detail: DataFrame, header: DataFrame) -> DataFrame:
    return detail.join(header.select("num_comp", "fecha_comp"), "num_comp")


def template_fill(
    params: DataFrame,
    dates: DataFrame | None = None,
    countries: Sequence[str] = C.PARAMETER_COUNTRIES,
    concepts: dict[str, Sequence[str]] = C.CONCEPTS,
) -> DataFrame:
    """Every concept for every closing date and country, with the saved value or 0.

    ``dates`` holds the closing dates asked for, by default those with saved values. Exchange
    rates are regional and take whatever country saved them.
    """
    is_fx = F.col("categoria") == C.FX_CATEGORY
    rows = [
        F.struct(
            F.lit(category).alias("categoria"), F.lit(concept).alias("concepto"), F.lit(i).alias("ord")
        )
        for category, names in concepts.items() for i, concept in enumerate(names)
    ]
    places = F.when(is_fx, F.array(F.lit(C.REGIONAL))).otherwise(
        F.array(*[F.lit(c) for c in countries])
    )
    spine = (
        (params if dates is None else dates).select("fecha_corte").distinct()
        .select("fecha_corte", F.inline(F.array(*rows)))
        .withColumn("pais", F.explode(places))
    )
    saved = params.select(
        "fecha_corte", "categoria", "concepto",
        F.when(is_fx, F.lit(C.REGIONAL)).otherwise(F.col("pais")).alias("pais"),
        "valor", "descripcion",
    )
    return spine.join(saved, ["fecha_corte", "pais", "categoria", "concepto"], "left").select(
        "fecha_corte", "pais", "categoria", "concepto", "ord",
        F.coalesce("valor", F.lit(0.0)).alias("valor"),
        X.text("descripcion").alias("descripcion"),
    )


def debt_allocation(debts: DataFrame, portfolio: Sequence[tuple[str, float, float]] = C.PORTFOLIO) -> DataFrame:
    """Debt of every country view, in millions.

    The regional view holds the whole book. A country's view holds its own debt and its share, by
    portfolio, of the debt raised abroad, whose label then names the country.
    """
    total = sum(perf + npa for name, perf, npa in portfolio if name == C.REGIONAL)
    weights = {
        name: (perf + npa) / total if total > 0 else 0.0
        for name, perf, npa in portfolio if name != C.REGIONAL
    }
    shared = F.col("country") == C.SHARED_DEBT_COUNTRY
    everywhere = F.array(F.lit(C.REGIONAL), *[F.lit(n) for n in weights])
    at_home = F.array_compact(
        F.array(F.lit(C.REGIONAL), F.when(F.col("country").isin(list(weights)), F.col("country")))
    )
    weight_of = F.create_map(*[F.lit(v) for pair in weights.items() for v in pair])
    lent = shared & (F.col("vista") != C.REGIONAL)
    return (
        debts.withColumn("vista", F.explode(F.when(shared, everywhere).otherwise(at_home)))
        .withColumn(
            "balance",
            F.col("balance_usd") / 1_000_000
            * F.when(lent, weight_of[F.col("vista")]).otherwise(F.lit(1.0)),
        )
        .withColumn(
            "type",
            F.when(lent, F.concat("type", F.lit(" ("), "vista", F.lit(" share)"))).otherwise(F.col("type")),
        )
    )
