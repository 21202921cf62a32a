"""Row filters of extraction, of the ledger queries and of the dashboards."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions import columns as X


def account_prefix_filter(
    df: DataFrame, prefixes: Sequence[str] = C.EXPENSE_PREFIXES, col: str = "cuenta_contable"
) -> DataFrame:
    return df.filter(X.starts_with_any(col, prefixes))


def period_filter(df: DataFrame, since: date, col: str, kind: str = "date") -> DataFrame:
    """Rows from ``since`` on. ``kind`` tells what ``col`` holds or how it is compared:
    ``date``, ``period`` (``yyyymm`` text) or ``year`` (the year part of such a text)."""
    return df.filter(since_test(since, col, kind))


def since_test(since: date, col: str, kind: str = "date") -> Column:
    """The condition of :func:`period_filter`."""
    if kind == "period":
        return F.col(col) >= since.strftime("%Y%m")
    if kind == "year":
        # The comparison of the text follows from that of the year, and reaches the scan.
        return (F.col(col) >= f"{since.year:04d}") & (F.substring(col, 1, 4).try_cast("int") >= since.year)
    return F.col(col) >= F.lit(since)


def voucher_numbered(df: DataFrame, col: str = "Com_Numero") -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def voucher_not_void(df: DataFrame, col: str = "Com_Estado") -> DataFrame:
    """Status known and not void."""
    return df.filter(F.col(col) != "A")


def transactions(
    ledger: DataFrame,
    start: date,
    end: date,
    companies: Sequence[str] | None = None,
    account: str | None = None,
    vendor: str | None = None,
) -> DataFrame:
    """Rows of a date range, with display defaults; see :func:`transactions_sorted` for the order.

    The expense prefixes apply only when neither an account nor a vendor is asked for.
    """
    df = ledger.filter(F.col("fecha_corte").between(F.lit(start), F.lit(end)))
    if companies is not None:
        df = df.filter(F.col("empresa").isin(list(companies)))
    if account:
        df = df.filter(F.col("cuenta_contable").startswith(account))
    elif not vendor:
        df = account_prefix_filter(df)
    if vendor:
        df = df.filter(X.contains_ignoring_case("nombre_tercero", vendor))
    return df.withColumns({
        "grupo": F.coalesce("grupo", F.lit(C.NO_GROUP)),
        "subgrupo": F.coalesce("subgrupo", F.lit(C.NO_SUBGROUP)),
        "status_gestion": F.coalesce("status_gestion", F.lit(C.DEFAULT_STATUS)),
        "clasificacion_manual": F.coalesce("clasificacion_manual", F.lit(False)),
    })


def sort_date_value(df: DataFrame, limit: int = 0) -> DataFrame:
    """Newest first, then largest; the id settles equal rows. A limit turns this into a top-k."""
    ordered = df.orderBy(
        F.desc("fecha_corte"), F.desc("valor"), F.asc("id_transaccion")
    )
    return ordered.limit(limit) if limit > 0 else ordered


def transactions_sorted(
    ledger: DataFrame,
    start: date,
    end: date,
    companies: Sequence[str] | None = None,
    account: str | None = None,
    vendor: str | None = None,
    limit: int = 0,
) -> DataFrame:
    return sort_date_value(transactions(ledger, start, end, companies, account, vendor), limit)


def is_pending() -> Column:
    return F.coalesce(F.col("grupo") == "", F.lit(True)) & X.not_manual()


def pending_all(ledger: DataFrame) -> DataFrame:
    """Rows the classifiers may fill: no group, not set by hand."""
    return ledger.filter(is_pending())


def pending(ledger: DataFrame, limit: int = C.PENDING_LIMIT) -> DataFrame:
    """Newest pending expense rows."""
    return (
        account_prefix_filter(pending_all(ledger))
        .orderBy(F.desc("fecha_corte"), F.asc("id_transaccion"))
        .limit(limit)
    )


# Levels of the filter cascade, outermost first.
FACETS = ("pais", "empresa", "grupo", "subgrupo", "nombre_tercero")


def _chosen(level: str, choices: dict[str, Sequence[str]]) -> Column | None:
    values = choices.get(level)
    if values is None or (level == FACETS[-1] and not values):
        return None
    return F.col(level).isin(list(values)) if values else F.lit(False)


def facet_filter(df: DataFrame, choices: dict[str, Sequence[str]]) -> DataFrame:
    """Rows left by the choices. A level without a choice keeps everything, as does an empty vendor
    list; an empty list on another level keeps nothing."""
    for level in FACETS:
        test = _chosen(level, choices)
        if test is not None:
            df = df.filter(test)
    return df


def facet_values(df: DataFrame, choices: dict[str, Sequence[str]]) -> DataFrame:
    """Distinct values each level offers, given the choices on the levels before it; one scan.

    The outer levels have few combinations, so a row is reduced to its combination and, when it
    passes them all, its vendor before anything is spread out by level.
    """
    *outer, vendor = FACETS
    before: dict[str, Column] = {}
    passed: Column = F.lit(True)
    for level in FACETS:
        before[level] = passed
        test = _chosen(level, choices)
        if test is not None:
            passed = passed & test
    none = F.lit(None).cast("string")
    combination = F.struct(*outer, none.alias(vendor))
    passing = F.when(before[vendor], F.struct(*[none.alias(c) for c in outer], F.col(vendor)))
    reduced = df.select(F.inline(F.array_compact(F.array(combination, passing)))).distinct()
    offers = [
        F.when(
            (before[level] if level in outer else F.lit(True)) & F.col(level).isNotNull(),
            F.struct(F.lit(level).alias("nivel"), F.col(level).alias("valor")),
        )
        for level in FACETS
    ]
    return reduced.select(F.inline(F.array_compact(F.array(*offers)))).distinct().orderBy("nivel", "valor")


def status_filter(df: DataFrame, statuses: Sequence[str] = C.OPEN_STATUSES) -> DataFrame:
    return df.filter(F.col("status_gestion").isin(list(statuses))) if statuses else df


def params_pick(params: DataFrame, category: str, country: str | None = None) -> DataFrame:
    """Parameters of one category; exchange rates are kept for all countries together."""
    picked = params.filter(F.col("categoria") == category)
    if category == C.FX_CATEGORY or country is None:
        return picked
    return picked.filter(F.col("pais") == country)


def read_params(params: DataFrame, closing: date, country: str | None = None) -> DataFrame:
    """Parameters of a closing date, of one country or of all."""
    df = params.filter(F.col("fecha_corte") == F.lit(closing))
    if country and country != C.ALL_COUNTRIES:
        df = df.filter(F.col("pais") == country)
    return df.orderBy("categoria", "concepto")
