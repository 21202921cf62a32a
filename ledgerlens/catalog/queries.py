"""One query per operator, each over the whole tables of ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens import schemas as S
from ledgerlens.catalog import fixtures as X
from ledgerlens.functions import columns as E
from ledgerlens.operators import aggregates as A
from ledgerlens.operators import canonical as K
from ledgerlens.operators import classifier as M
from ledgerlens.operators import filters as P
from ledgerlens.operators import finance as N
from ledgerlens.operators import joins as J
from ledgerlens.operators import ledger as L
from ledgerlens.operators import rollup as R
from ledgerlens.operators import trends as T
from ledgerlens.operators import vendor_counts as V
from ledgerlens.operators import writeback as W
from ledgerlens.plans import corrections, load
from ledgerlens.plans.load import extract
from ledgerlens.plans.projection import project_countries
from ledgerlens.session import fresh_path
from ledgerlens.sources import exports, literals, readers
from ledgerlens.sources.ranges import months, range_predicates
from ledgerlens.sources.registry import Location, registry_table
from ledgerlens.sources.tables import read_version, write_version

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _register(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n, t in df.dtypes if t == "double"})


def _spec(empresa: str):
    return next(s for s in X.specs() if s.empresa == empresa)


def _dims(spark: SparkSession, sf: str) -> J.Dimensions:
    return J.check_dims(X.clients(spark, sf), X.accounts(spark, sf), X.cost_centres(spark, sf))


def _star_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Star-layout lines of all companies through the load steps."""
    tables = X.star_tables(spark, sf)
    lines = P.account_prefix_filter(tables["detail"], C.JOURNAL_PREFIXES, "Cta_Codigo")
    lines = P.period_filter(lines, X.SINCE, "Com_Periodo", "period")
    lines = J.join_header(lines, P.voucher_not_void(tables["voucher"]))
    lines = J.enrich_dims(lines, _dims(spark, sf))
    rows = L.account_exclusion(K.canonical_d(lines), X.exclusions(spark, sf))
    return K.normalize_ledger(rows)


def _view(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Ledger rows as the dashboards see them."""
    needed = {"empresa" if c == "pais" else c for c in columns} | {"fecha_corte"}
    return K.display_defaults(X.ledger(spark, sf, *sorted(needed))).select(*columns)


# --- extraction ---------------------------------------------------------------------------------

@_register
def etl_summary(spark, sf):
    """Star journal to monthly totals: the whole way from journal lines to a report."""
    return A.summary(_star_ledger(spark, sf), X.YEAR)


@_register
def read_source(spark, sf):
    """One star journal with the year test, the wider account prefix and the void test."""
    return extract(X.journal(spark, sf, _spec("NC SA")), _spec("NC SA"), X.exclusions(spark, sf))


@_register
def canonical_a(spark, sf):
    """All lines, as one company's journal of this layout; so below."""
    return K.canonical_a(X.journal_a(spark, sf), "CONIX")


@_register
def canonical_b(spark, sf):
    return K.canonical_b(X.journal_b(spark, sf), "GFO")


@_register
def canonical_c(spark, sf):
    """Both sets of column names."""
    return K.canonical_c(X.journal_c(spark, sf), "LTCP").unionByName(
        K.canonical_c(X.journal_c(spark, sf, plain=True), S.PLAIN_JOURNAL_C)
    )


@_register
def canonical_d(spark, sf):
    tables = X.star_tables(spark, sf)
    lines = J.enrich_dims(tables["detail"], _dims(spark, sf))
    return K.canonical_d(lines)


@_register
def canonical_e(spark, sf):
    tables = X.journal_e(spark, sf)
    return K.canonical_e(J.join_detail_header(tables["detail"], tables["header"]), "INCOFIN LEASING")


def _raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw text: dates as text, some of them no dates, amounts as text, long descriptions."""
    documents = X.table(spark, sf, "documents")
    key = F.col("doc_id")
    raw = documents.select(
        F.col("lang").alias("empresa"),
        F.when(key % 13 == 0, F.lit("sin fecha"))
        .otherwise(F.concat(F.lit("2025-0"), (key % 9 + 1).cast("string"), F.lit("-15")))
        .alias("fecha_transaccion"),
        key.cast("string").alias("cuenta_contable"),
        F.when(key % 3 != 0, F.col("source")).alias("id_proveedor"),
        F.when(key % 5 != 0, F.col("source")).alias("nombre_tercero"),
        F.col("text").alias("descripcion_gasto"),
        F.when(key % 4 == 0, F.lit("n/a")).otherwise((F.col("n_chars") / 4).cast("string")).alias("valor"),
    )
    return raw


@_register
def normalize_ledger(spark, sf):
    """Cleanup of raw text."""
    return K.normalize_ledger(_raw_lines(spark, sf))


@_register
def rejections(spark, sf):
    """What the cleanup of raw text rejects, by line."""
    traced = K.normalize_ledger(_raw_lines(spark, sf), traced=True)
    return traced.filter(F.col(K.REJECTED).isNotNull()).select("cuenta_contable", "fecha_transaccion", "valor", K.REJECTED)


@_register
def consolidate(spark, sf):
    """All thirteen journals, each by its own layout and rules."""
    excluded, dims = X.exclusions(spark, sf), _dims(spark, sf)
    return L.consolidate([extract(X.journal(spark, sf, s), s, excluded, dims) for s in X.specs()])


def _refreshed(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """The whole job twice: a load of GFO, then one of all journals while GFO's is gone. Folder of the ledger, and the last audit."""
    root, excluded, sources = fresh_path(spark, "ledger"), X.exclusions(spark, sf), X.stored_sources(spark, sf)
    load.ledger_full_refresh(spark, [s for s in sources if s.empresa == "GFO"], root, excluded)
    now = [X.unreadable(s) if s.empresa == "GFO" else s for s in sources]
    return root, load.ledger_full_refresh(spark, now, root, excluded)


@_register
def ledger_full_refresh(spark, sf):
    """What a reader of the ledger finds after the whole job; ids are left out, as they follow the written files."""
    root, _ = _refreshed(spark, sf)
    return read_version(spark, root).drop("id_transaccion")


@_register
def ingest_audit(spark, sf):
    """The audit stored by the whole job."""
    _, audit = _refreshed(spark, sf)
    return audit.select("empresa", "filas", "estado", F.col("error").isNotNull().alias("con_error"))


@_register
def load_ids(spark, sf):
    """Ids after the whole job, carried rows included: from 1 on, without holes or repeats."""
    root, _ = _refreshed(spark, sf)
    ids = F.col("id_transaccion")
    return read_version(spark, root).agg(
        F.count(ids).alias("filas"), F.count_distinct(ids).alias("ids"), F.min(ids).alias("primero"), F.max(ids).alias("ultimo")
    )


@_register
def audit_totals(spark, sf):
    """What the passes that wrote the sources counted: totals, and lines with a rejected date or amount."""
    _, audit = _refreshed(spark, sf)
    return audit.select("empresa", "filas", "total", "fechas_rechazadas", "importes_rechazados")


@_register
def source_ranges(spark, sf):
    """Lines of the star journals in each range of months that a database is asked for; every line is in one."""
    bounds = [m.strftime("%Y%m") for m in months(X.SINCE, date(1998, 12, 1))]
    told = range_predicates("Com_Periodo", bounds, "`")
    counts = X.star_detail(spark, sf).agg(F.array(*[F.count_if(F.expr(p)) for p in told]).alias("n"))
    return counts.select(F.posexplode("n").alias("rango", "filas"))


@_register
def concept_template(spark, sf):
    """Every concept of the inline template with the number of parameters saved under it."""
    saved = X.parameters(spark, sf).groupBy("categoria", "concepto").agg(F.count(F.lit(1)).alias("guardados"))
    return literals.concepts(spark).join(saved, ["categoria", "concepto"], "left").select(
        "categoria", "concepto", "ord", F.coalesce("guardados", F.lit(0)).alias("guardados")
    )


@_register
def debt_book(spark, sf):
    """The inline debt book beside the inline portfolio and the instruments of the same country and kind in the debt table."""
    known = X.debts(spark, sf).groupBy("country", "type").agg(F.count(F.lit(1)).alias("instruments"))
    return (
        literals.debt_book(spark).join(literals.portfolio(spark), "country", "left").join(known, ["country", "type"], "left")
        .select("country", "type", "balance_usd", "rate", "term_years", "perf", "npa", F.coalesce("instruments", F.lit(0)).alias("instruments"))
    )


@_register
def source_registry(spark, sf):
    """Each registered source with the lines its company posted from the source's start on."""
    rows = X.ledger(spark, sf, "empresa", "fecha_transaccion")
    registry = registry_table(spark, X.specs())
    counts = (
        rows.join(F.broadcast(registry.select("empresa", "since")), "empresa")
        .filter(F.col("fecha_transaccion") >= F.col("since"))
        .groupBy("empresa").agg(F.count(F.lit(1)).alias("filas"))
    )
    return registry.join(counts, "empresa", "left").select(
        "empresa", "layout", "since", "prefixes", "voucher_rule", "filas"
    )


@_register
def account_prefix_filter(spark, sf):
    return P.account_prefix_filter(
        X.ledger(spark, sf, "id_transaccion", "empresa", "cuenta_contable", "valor")
    )


@_register
def account_exclusion(spark, sf):
    rows = X.ledger(spark, sf, "id_transaccion", "empresa", "cuenta_contable", "valor")
    return L.account_exclusion(rows, X.exclusions(spark, sf)).select(
        "id_transaccion", "empresa", "cuenta_contable", "valor"
    )


@_register
def period_filter(spark, sf):
    """The three ways a start date is tested, counted per company."""
    detail = X.star_detail(spark, sf).withColumn("fecha", E.period_start("Com_Periodo"))
    tests = {
        "period": P.since_test(X.SINCE, "Com_Periodo", "period"), "year": P.since_test(X.SINCE, "Com_Periodo", "year"),
        "date": P.since_test(X.SINCE_GFO, "fecha"),
    }
    kinds = F.array_compact(F.array(*[F.when(test, F.lit(kind)) for kind, test in tests.items()]))
    counted = detail.groupBy("empresa", kinds.alias("kinds")).agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.withColumn("kind", F.explode("kinds")).groupBy("kind", "empresa").agg(F.sum("n").alias("filas"))
    )


@_register
def voucher_valid(spark, sf):
    """Lines per company with a voucher number, and lines whose voucher is not void."""
    tables = X.star_tables(spark, sf)
    numbered = P.voucher_numbered(tables["detail"]).groupBy("empresa").agg(F.count(F.lit(1)).alias("con_numero"))
    live = P.voucher_not_void(J.join_header(tables["detail"], tables["voucher"]))
    live = live.groupBy("empresa").agg(F.count(F.lit(1)).alias("vigentes"))
    return numbered.join(live, "empresa", "full").select("empresa", "con_numero", "vigentes")


@_register
def enrich_dims(spark, sf):
    t = X.star_tables(spark, sf)
    return J.enrich_dims(t["detail"], _dims(spark, sf)).select(
        "Com_Numero", "Cta_Codigo", "Cli_Rut", "Cdc_Codigo", "Cli_Nombre", "Cta_Glosa", "Cdc_glosa", "Dco_Valor"
    )


@_register
def join_header(spark, sf):
    t = X.star_tables(spark, sf)
    return J.join_header(t["detail"], t["voucher"]).select(
        "Com_Numero", "Com_Periodo", "Cta_Codigo", "Dco_Valor", "Com_Estado"
    )


@_register
def join_detail_header(spark, sf):
    t = X.journal_e(spark, sf)
    return J.join_detail_header(t["detail"], t["header"]).select("num_comp", "cod_cuenta", "mto_deb_$", "mto_hab_$", "fecha_comp")


@_register
def assign_ids(spark, sf):
    """Dense ids in the total order of the lines."""
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return L.assign_ids(X.table(spark, sf, "lineitem").select(*order), *order)


@_register
def evolve_schema(spark, sf):
    rows = X.ledger(spark, sf, *[c for c in S.LEDGER.names if c not in S.LATE_COLUMNS])
    return L.evolve_schema(rows).select("id_transaccion", *S.LATE_COLUMNS)


@_register
def ledger_version(spark, sf):
    """Write the ledger as a new version, then total what a reader of the table finds."""
    root = fresh_path(spark, "ledger")
    write_version(X.ledger(spark, sf), root, cluster_by=["id_transaccion"])
    return read_version(spark, root).groupBy("empresa").agg(
        F.count(F.lit(1)).alias("filas"), E.money_sum("valor").alias("total"),
        F.max("fecha_corte").alias("ultima_fecha"),
    )


@_register
def export_csv_bom(spark, sf):
    """Write the explorer report as CSV, then total what a reader of the files finds."""
    path = fresh_path(spark, "export")
    exports.export_csv_bom(X.ledger(spark, sf), path)
    back = spark.read.options(header=True, multiLine=True, **exports.CSV_RULES).csv(path)
    return back.toDF(*C.EXPLORER_COLUMNS).groupBy("empresa").agg(
        F.count(F.lit(1)).alias("filas"),
        E.money_sum(F.col("valor").cast("double")).alias("total"),
        F.count("grupo").alias("con_grupo"),
    )


@_register
def scalar_functions(spark, sf):
    """Text, date and number rules of the engine, one column each."""
    documents = X.table(spark, sf, "documents")
    part = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    amount = F.col("n_chars") * F.when(F.col("doc_id") % 2 == 0, F.lit(1234.5)).otherwise(F.lit(-1234.25))
    made = F.concat((F.lit(2020) + F.col("doc_id") % 6).cast("string"), F.lpad((F.col("doc_id") % 14).cast("string"), 2, "0"))
    dated = E.period_start(made)
    return documents.select(
        "doc_id",
        E.joined_skipping_nulls("lang", part, F.lit("x")).alias("skipping"),
        E.joined_keeping_blanks("lang", part, F.lit("x")).alias("keeping"),
        dated.alias("period_day"),
        F.last_day(dated).alias("month_end"),
        E.month(dated).alias("month"),
        E.number_or_zero(F.when(F.col("doc_id") % 5 == 0, F.lit("abc")).otherwise(F.col("n_chars").cast("string"))).alias("number"),
        E.amount_label(amount).alias("label"),
        E.contains_ignoring_case("text", "The").alias("has_the"),
        E.starts_with_any(made, ("2021", "2023")).alias("odd_year"),
    )


# --- ledger queries -----------------------------------------------------------------------------

@_register
def ledger_scan(spark, sf):
    return readers.ledger_scan(X.ledger(
        spark, sf, "id_transaccion", "cuenta_contable", "id_proveedor", "descripcion_gasto", "grupo",
        "clasificacion_manual",
    ))


@_register
def summary(spark, sf):
    return A.summary(X.ledger(spark, sf, "empresa", "fecha_corte", "cuenta_contable", "valor"), X.YEAR)


@_register
def categories(spark, sf):
    return A.categories(X.ledger(spark, sf, "grupo", "subgrupo"))


@_register
def transactions(spark, sf):
    """A date range of eight companies, default accounts."""
    return P.transactions(X.ledger(spark, sf), X.START, X.END, C.COMPANIES[:8])


@_register
def transactions_account(spark, sf):
    """All companies, accounts outside the default prefixes."""
    columns = [c for c in S.LEDGER.names if c != "descripcion_gasto"]
    return P.transactions(X.ledger(spark, sf, *columns), X.START, X.END, account="33")


@_register
def transactions_vendor(spark, sf):
    columns = [c for c in S.LEDGER.names if c != "descripcion_gasto"]
    return P.transactions(X.ledger(spark, sf, *columns), X.START, X.END, vendor="SUPPLIER#00000000")


@_register
def sort_date_value(spark, sf):
    """The 500 newest, then largest transactions."""
    columns = ("id_transaccion", "empresa", "fecha_corte", "cuenta_contable", "valor", "grupo", "subgrupo",
               "status_gestion", "clasificacion_manual")
    rows = X.ledger(spark, sf, *columns)
    return P.transactions_sorted(rows, X.START, X.END, limit=500).select(*columns)


@_register
def pending(spark, sf):
    columns = ("id_transaccion", "empresa", "fecha_corte", "cuenta_contable", "valor", "grupo", "clasificacion_manual")
    return P.pending(X.ledger(spark, sf, *columns), 100)


@_register
def pending_all(spark, sf):
    return P.pending_all(X.ledger(spark, sf, "id_transaccion", "grupo", "clasificacion_manual"))


@_register
def pending_count(spark, sf):
    return A.pending_count(X.ledger(spark, sf, "grupo", "clasificacion_manual"))


@_register
def classified_count(spark, sf):
    return A.classified_count(X.ledger(spark, sf, "grupo"))


@_register
def display_defaults(spark, sf):
    return K.display_defaults(X.ledger(
        spark, sf, "id_transaccion", "empresa", "fecha_corte", "nombre_tercero", "grupo", "subgrupo",
        "status_gestion", "clasificacion_manual", "valor",
    ))


@_register
def country_of(spark, sf):
    """Rows and companies per country; company names come in mixed case and with blanks."""
    rows = X.ledger(spark, sf, "empresa", "valor")
    messy = F.when(F.col("valor") > 0, F.concat(F.lit(" "), F.lower("empresa"), F.lit(" "))).otherwise(F.col("empresa"))
    return rows.groupBy(E.country_of(messy).alias("pais"), "empresa").agg(F.count(F.lit(1)).alias("filas"))


@_register
def explorer_view(spark, sf):
    return K.explorer_view(X.ledger(spark, sf))


@_register
def explorer_kpis(spark, sf):
    rows = X.ledger(spark, sf, "empresa", "fecha_corte", "cuenta_contable", "valor", "grupo", "subgrupo",
                    "status_gestion", "clasificacion_manual")
    return A.explorer_kpis(P.transactions(rows, X.START, X.END))


_CHOICES = {"pais": ["Chile", "Perú"], "empresa": ["LTCP", "NCPF", "AFI", "IN SA", "GFO"],
            "grupo": ["ECONOMY", "SMALL", C.NO_GROUP], "subgrupo": ["Brand#2", "Brand#17", C.NO_SUBGROUP],
            "nombre_tercero": []}


@_register
def facet_filter(spark, sf):
    view = K.display_defaults(X.ledger(
        spark, sf, "id_transaccion", "empresa", "fecha_corte", "nombre_tercero", "valor", "grupo", "subgrupo",
        "status_gestion", "clasificacion_manual",
    ))
    return P.facet_filter(view, _CHOICES).select(
        "id_transaccion", "pais", "empresa", "grupo", "subgrupo", "nombre_tercero", "valor"
    )


@_register
def facet_values(spark, sf):
    return P.facet_values(_view(spark, sf, *P.FACETS), _CHOICES)


@_register
def status_filter(spark, sf):
    view = _view(spark, sf, "status_gestion", "valor")
    return P.status_filter(view).groupBy("status_gestion").agg(
        F.count(F.lit(1)).alias("filas"), E.money_sum("valor").alias("total")
    )


@_register
def kpi_country_totals(spark, sf):
    return A.kpi_country_totals(_view(spark, sf, "pais", "valor"))


@_register
def top_groups(spark, sf):
    """Ten largest subgroup-in-group labels, as the test groups are few."""
    view = _view(spark, sf, "grupo", "subgrupo", "valor")
    return A.top_groups(view.withColumn("grupo", F.concat_ws(" / ", "grupo", "subgrupo")))


@_register
def vendor_rollup(spark, sf):
    view = _view(spark, sf, "nombre_tercero", "empresa", "status_gestion", "grupo", "subgrupo", "valor")
    return A.vendor_rollup(P.status_filter(view))


@_register
def vendor_class_counts(spark, sf):
    columns = ("fecha_corte", "empresa", "cuenta_contable", "nombre_tercero", "grupo", "subgrupo",
               "status_gestion", "clasificacion_manual")
    found = P.transactions(X.ledger(spark, sf, *columns), X.START, X.END, vendor="supplier#0000000")
    return A.vendor_class_counts(found, "supplier#0000000")


@_register
def monthly_trend(spark, sf):
    """The range starts before the first and ends after the last month with rows."""
    return T.monthly_trend(_view(spark, sf, "fecha_corte", "valor"), X.SINCE_GFO.replace(year=1994), X.END.replace(year=2002))


@_register
def vendor_trend(spark, sf):
    return T.vendor_trend(_view(spark, sf, "nombre_tercero", "fecha_corte", "grupo", "valor"), "Supplier#000000005")


@_register
def month_vendor_matrix(spark, sf):
    return T.month_vendor_matrix(_view(spark, sf, "nombre_tercero", "fecha_corte", "valor"))


@_register
def growth_alerts(spark, sf):
    return _rounded(T.growth_alerts(_view(spark, sf, "nombre_tercero", "fecha_corte", "valor")))


@_register
def alerts_sorted(spark, sf):
    """Alerts per vendor and group, largest last month first."""
    view = _view(spark, sf, "nombre_tercero", "grupo", "fecha_corte", "valor")
    named = view.withColumn("nombre_tercero", F.concat_ws(" / ", "nombre_tercero", "grupo"))
    return _rounded(T.alerts_sorted(T.growth_alerts(named)))


# --- write-back ---------------------------------------------------------------------------------

_UPDATED = ("id_transaccion", "nombre_tercero", "grupo", "subgrupo", "status_gestion", "clasificacion_manual")


@_register
def update_by_id(spark, sf):
    return W.update_by_id(X.ledger(spark, sf, *_UPDATED), X.updates_by_id(spark, sf))


@_register
def updates_submitted(spark, sf):
    return W.updates_submitted(X.updates_by_id(spark, sf))


@_register
def update_by_vendor(spark, sf):
    return W.update_by_vendor(X.ledger(spark, sf, *_UPDATED), X.updates_by_vendor(spark, sf))


@_register
def vendor_update_hits(spark, sf):
    return W.vendor_update_hits(X.ledger(spark, sf, "nombre_tercero"), X.updates_by_vendor(spark, sf))


def _corrected(spark: SparkSession, sf: str, by_vendor: bool = False) -> tuple[str, int]:
    """A stored ledger with its rollup, then its correction by id and, if asked for, by vendor. Folder and last version."""
    root = fresh_path(spark, "ledger")
    write_version(X.ledger(spark, sf), root)
    corrections.read_rollup(spark, root)
    corrections.read_vendor_counts(spark, root)
    last = corrections.correct_by_id(spark, root, X.updates_by_id(spark, sf))
    if by_vendor:
        last = corrections.correct_by_vendor(spark, root, X.updates_by_vendor(spark, sf))
    return root, last.version


@_register
def corrected_by_id(spark, sf):
    """The stored ledger after a correction that rewrote only the companies it hit."""
    root, number = _corrected(spark, sf)
    return read_version(spark, root, number).select(*_UPDATED)


@_register
def corrected_twice(spark, sf):
    """The stored ledger after corrections by id and by vendor."""
    root, number = _corrected(spark, sf, True)
    return read_version(spark, root, number).select(*_UPDATED)


@_register
def counted_vendor_modes(spark, sf):
    """Usual group and subgroup of each vendor from the counts that two corrections kept up to date; no line is read."""
    return V.modes(corrections.read_vendor_counts(spark, _corrected(spark, sf, True)[0]))


@_register
def unify_stored(spark, sf):
    """The stored ledger after its vendors were unified by their counts."""
    root = fresh_path(spark, "ledger")
    write_version(X.ledger(spark, sf), root)
    corrections.unify_stored(spark, root)
    return read_version(spark, root).select(*_UPDATED)


@_register
def rollup_summary(spark, sf):
    """Totals of a year from the corrected rollup; no line is read."""
    return A.summary(R.as_ledger(corrections.read_rollup(spark, _corrected(spark, sf)[0])), X.YEAR)


@_register
def rollup_kpi_country_totals(spark, sf):
    return A.kpi_country_totals(R.as_view(corrections.read_rollup(spark, _corrected(spark, sf)[0])))


@_register
def rollup_top_groups(spark, sf):
    """Groups after two corrections."""
    return A.top_groups(R.as_view(corrections.read_rollup(spark, _corrected(spark, sf, True)[0])))


@_register
def rollup_monthly_trend(spark, sf):
    view = R.as_view(corrections.read_rollup(spark, _corrected(spark, sf)[0]))
    return T.monthly_trend(view, X.SINCE_GFO.replace(year=1994), X.END.replace(year=2002))


@_register
def rollup_vendor_trend(spark, sf):
    """Months and groups of one vendor after two corrections, which changed its groups."""
    return T.vendor_trend(R.as_view(corrections.read_rollup(spark, _corrected(spark, sf, True)[0])), "Supplier#000000006")


@_register
def read_params(spark, sf):
    return P.read_params(X.parameters(spark, sf), X.date(2024, 3, 31), C.ALL_COUNTRIES)


@_register
def params_pick(spark, sf):
    """Closing results of one country, and the exchange rates, which belong to no country."""
    params = X.parameters(spark, sf)
    return P.params_pick(params, "PL_Close", "Perú").unionByName(P.params_pick(params, C.FX_CATEGORY, "Perú"))


@_register
def upsert_params(spark, sf):
    return W.upsert_params(X.parameters(spark, sf), X.parameter_batch(spark, sf))


@_register
def template_fill(spark, sf):
    saved = X.parameters(spark, sf).filter("descripcion is not null")
    return J.template_fill(saved, X.parameters(spark, sf))


@_register
def vendor_modes(spark, sf):
    return A.vendor_modes(X.ledger(spark, sf, "nombre_tercero", "grupo", "subgrupo"))


@_register
def unify_vendor(spark, sf):
    return W.unify_vendor(X.ledger(spark, sf, *_UPDATED))


@_register
def unified_count(spark, sf):
    return W.unified_count(W.unify_vendor_flagged(X.ledger(spark, sf, *_UPDATED)))


@_register
def apply_predictions(spark, sf):
    """Pending rows get labels made from their account."""
    rows = X.ledger(spark, sf, "id_transaccion", "cuenta_contable", "grupo", "subgrupo", "clasificacion_manual")
    found = P.pending_all(rows).select(
        "id_transaccion",
        F.concat(F.lit("G"), F.substring("cuenta_contable", 1, 2)).alias("grupo"),
        F.concat(F.lit("S"), F.substring("cuenta_contable", -2, 2)).alias("subgrupo"),
    )
    return W.apply_predictions(rows, found)


# --- classifier ---------------------------------------------------------------------------------

@_register
def read_training_set(spark, sf):
    """The sheet written as a file and read with its fixed schema."""
    path = fresh_path(spark, "sheet")
    X.training_documents(spark, sf).write.parquet(path)
    sheet = readers.read_training_set(spark, Location(path=path))
    return sheet.groupBy(F.col(C.SHEET_GROUP).alias("grupo")).agg(
        F.count(F.lit(1)).alias("filas"), F.count(C.SHEET_SUBGROUP).alias("con_subgrupo"),
        F.sum(F.length(C.SHEET_DESCRIPTION)).alias("letras"),
    )


@_register
def clean_training_set(spark, sf):
    return M.clean_training_set(X.training_documents(spark, sf))


@_register
def feature_text(spark, sf):
    rows = X.ledger(spark, sf, "id_transaccion", "cuenta_contable", "id_proveedor", "descripcion_gasto")
    return rows.select("id_transaccion", M.feature_text().alias("texto"))


def _labelled(sheet: DataFrame) -> DataFrame:
    return M.clean_training_set(sheet).withColumn("texto", M.feature_text())


def _labelled_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return X.training_ledger(spark, sf).withColumn("texto", M.feature_text())


@_register
def split_80_20(spark, sf):
    """Rows on each side, and texts that lie on both (none)."""
    rows, held = M.split_80_20(_labelled(X.training_documents(spark, sf)))
    sides = rows.withColumn("side", F.lit("train")).unionByName(held.withColumn("side", F.lit("test")))
    return (
        sides.groupBy("texto").agg(
            F.sum((F.col("side") == "train").cast("bigint")).alias("a"),
            F.sum((F.col("side") == "test").cast("bigint")).alias("b"),
        )
        .agg(
            F.sum(F.col("a") + F.col("b")).alias("rows"), F.sum("a").alias("train_rows"),
            F.sum((F.least("a", "b") > 0).cast("bigint")).alias("split_texts"),
            (F.round(F.sum("a") / F.sum(F.col("a") + F.col("b")), 1)).alias("train_share"),
        )
    )


@_register
def tfidf(spark, sf):
    """Term weights of the training documents: number of terms and largest weight of each."""
    rows = _labelled(X.training_documents(spark, sf))
    weights = M.vector_to_array("features")
    return M.fit_tfidf(rows).transform(rows).select(
        "grupo", "cuenta_contable",
        F.size(F.array_remove(weights, 0.0)).alias("terms"),
        F.round(F.array_max(weights), 6).alias("top_weight"),
    )


@_register
def train_group(spark, sf):
    """Group of the hold-out documents by a forest trained on the others."""
    return _trained_target(spark, sf, "grupo")


@_register
def train_subgroup(spark, sf):
    return _trained_target(spark, sf, "subgrupo")


def _trained_target(spark: SparkSession, sf: str, target: str) -> DataFrame:
    rows, held = M.split_80_20(_labelled(X.training_documents(spark, sf)))
    features = M.fit_tfidf(rows)
    forest = M.fit_target(M.weighted(rows.select("texto", target)), features, target)
    return (
        forest.transform(features.transform(held))
        .groupBy(target, f"{target}_predicho").agg(F.count(F.lit(1)).alias("filas"))
    )


@_register
def holdout_accuracy(spark, sf):
    labelled = _labelled(X.training_documents(spark, sf))
    return M.holdout_accuracy(labelled, M.train(labelled))


@_register
def predict(spark, sf):
    """Every document classified by models trained on the labelled ones, saved and loaded again."""
    sheet, path = X.training_documents(spark, sf), fresh_path(spark, "model")
    M.train(_labelled(sheet)).save(path)
    model = M.ExpenseClassifier.load(path)
    rows = sheet.select(
        F.col(C.SHEET_ACCOUNT).alias("cuenta_contable"),
        F.col(C.SHEET_VENDOR).alias("id_proveedor"),
        F.col(C.SHEET_DESCRIPTION).alias("descripcion_gasto"),
    )
    return M.predict(rows, model).drop("descripcion_gasto")


@_register
def classify_pending(spark, sf):
    """The whole job: train on the rows set by hand, classify, unify."""
    model = M.train(_labelled_ledger(spark, sf))
    return M.classify_pending(X.ledger(spark, sf), model).drop("descripcion_gasto")


# --- finance ------------------------------------------------------------------------------------

@_register
def debt_schedule(spark, sf):
    return _rounded(N.debt_schedule(X.loans(spark, sf)).select("loan_id", "month", "interest"))


@_register
def debt_interest_total(spark, sf):
    return _rounded(N.debt_interest_total(X.scenario_loans(spark, sf)))


@_register
def debt_allocation(spark, sf):
    return _rounded(J.debt_allocation(X.debts(spark, sf)).select("debt_id", "vista", "country", "type", "balance", "rate"), 6)


@_register
def debt_union(spark, sf):
    """Own and shared debt per view and kind."""
    allocated = J.debt_allocation(X.debts(spark, sf))
    shared = (F.col("country") == C.SHARED_DEBT_COUNTRY).alias("shared")
    return _rounded(allocated.groupBy("vista", shared, "type").agg(F.sum("balance").alias("balance")), 6)


@_register
def debt_total(spark, sf):
    return _rounded(N.debt_total(J.debt_allocation(X.debts(spark, sf))), 6)


@_register
def new_debt_schedule(spark, sf):
    return _rounded(N.new_debt_schedule(X.scenarios(spark, sf)))


@_register
def npa_runoff(spark, sf):
    return _rounded(N.npa_runoff(X.scenarios(spark, sf)))


def _projection(spark: SparkSession, sf: str) -> DataFrame:
    return N.project_pnl(X.scenarios(spark, sf), X.scenario_loans(spark, sf))


@_register
def project_pnl(spark, sf):
    return _rounded(_projection(spark, sf))


@_register
def annualize(spark, sf):
    return _rounded(N.annualize(_projection(spark, sf)))


@_register
def pnl_statement(spark, sf):
    return _rounded(N.pnl_statement(N.annualize(_projection(spark, sf))))


@_register
def pnl_display(spark, sf):
    """The annual statement with one column per year."""
    statement = N.pnl_statement(N.annualize(_projection(spark, sf)))
    return _rounded(N.pnl_display(statement, [str(y) for y in range(2025, 2032)]))


@_register
def project_countries_annual(spark, sf):
    """The five country views with their share of the debt book, by year."""
    return _rounded(N.annualize(project_countries(X.debts(spark, sf), X.date(2025, 3, 10))))


@_register
def projection_kpis(spark, sf):
    return _rounded(N.projection_kpis(N.annualize(_projection(spark, sf))))


@_register
def margin_shift(spark, sf):
    return _rounded(N.margin_shift(N.annualize(_projection(spark, sf))))

