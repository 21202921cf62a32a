"""Bringing the five journal layouts to one ledger shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions import columns as X


def canonical_a(journal: DataFrame, empresa: str) -> DataFrame:
    """Signed amounts, vendor named, closing date given."""
    return journal.select(
        F.lit(empresa).alias("empresa"),
        "fecha_corte",
        X.day("d_fecha_documento").alias("fecha_transaccion"),
        F.col("k_sc_codigo_cuenta").cast("string").alias("cuenta_contable"),
        F.col("n_nit").cast("string").alias("id_proveedor"),
        F.col("sc_nombre").alias("nombre_tercero"),
        X.joined_skipping_nulls("sc_nombre_cuenta", "sv_observaciones", "sc_nombre_centro_costo")
        .alias("descripcion_gasto"),
        F.col("n_valor").alias("valor"),
    )


def canonical_b(journal: DataFrame, empresa: str) -> DataFrame:
    """Unsigned amounts with a debit/credit flag, closing date given."""
    return journal.select(
        F.lit(empresa).alias("empresa"),
        "fecha_corte",
        X.day("fecha_docto").alias("fecha_transaccion"),
        F.col("cuenta").cast("string").alias("cuenta_contable"),
        F.col("tercero").cast("string").alias("id_proveedor"),
        F.col("nombre_razon_social").alias("nombre_tercero"),
        X.joined_skipping_nulls("detalle", "c_o_descripcion", "cuenta_descripcion", "c_costo_descripcion")
        .alias("descripcion_gasto"),
        X.signed("d_c", "valor_l1", plus="D", minus="C").alias("valor"),
    )


# Column names of the two variants of the debit/credit-column layout.
_C_SPACED = ("FEC DOC", "CUENTA", "ANEXO", "CONCEPTO", "C COSTO", "DEBE  - MN", "HABER - MN")
_C_PLAIN = ("fec_doc", "cuenta", "anexo", "concepto", "centro_costo", "debe_mn", "haber_mn")


def canonical_c(journal: DataFrame, empresa: str) -> DataFrame:
    """Separate debit and credit columns, no vendor name, closing date given."""
    names = _C_SPACED if _C_SPACED[0] in journal.columns else _C_PLAIN
    posted, account, vendor, concept, centre, debit, credit = [F.col(f"`{n}`") for n in names]
    zero = F.lit(0.0)
    return journal.select(
        F.lit(empresa).alias("empresa"),
        "fecha_corte",
        X.day(posted).alias("fecha_transaccion"),
        account.cast("string").alias("cuenta_contable"),
        vendor.cast("string").alias("id_proveedor"),
        F.lit(None).cast("string").alias("nombre_tercero"),
        X.joined_skipping_nulls(concept, centre).alias("descripcion_gasto"),
        (F.coalesce(debit, zero) - F.coalesce(credit, zero)).alias("valor"),
    )


def canonical_d(lines: DataFrame, empresa: str | None = None) -> DataFrame:
    """Enriched star-layout lines; the date is the first of the period. Without ``empresa`` the
    lines carry their own company."""
    company = F.col("empresa") if empresa is None else F.lit(empresa)
    return lines.select(
        company.alias("empresa"),
        X.period_start("Com_Periodo").alias("fecha_transaccion"),
        F.col("Cta_Codigo").alias("cuenta_contable"),
        F.col("Cli_Rut").alias("id_proveedor"),
        F.col("Cli_Nombre").alias("nombre_tercero"),
        X.joined_keeping_blanks("Dco_Glosa", "Cdc_glosa", "Cta_Glosa").alias("descripcion_gasto"),
        X.signed("Dco_TipoDH", "Dco_Valor", plus="D", minus="H").alias("valor"),
    )


def canonical_e(lines: DataFrame, empresa: str) -> DataFrame:
    """Lines with their header; the vendor id is number and check digit."""
    return lines.select(
        F.lit(empresa).alias("empresa"),
        X.day("fecha_comp").alias("fecha_transaccion"),
        F.col("cod_cuenta").cast("string").alias("cuenta_contable"),
        F.concat(X.text("con_analisis1"), F.lit("-"), X.text("dv_con_analisis1")).alias("id_proveedor"),
        F.lit(None).cast("string").alias("nombre_tercero"),
        X.text("glosa_det_comp").alias("descripcion_gasto"),
        (F.col("`mto_deb_$`") - F.col("`mto_hab_$`")).alias("valor"),
    )


#: Column that names what of a line was not taken over as it came.
REJECTED = "rechazo"
_DATES = ("fecha_transaccion", "fecha_corte")


def rejections(df: DataFrame) -> Column:
    """What of a raw line is not taken over, as ``field=value`` parts; null for a line taken whole.

    Dates that are none become null. Amounts that are no number or not finite become 0, and amounts too large to be added up exactly stay
    but add nothing; all three are told. A missing value is not rejected.
    """
    told = lambda name, bad: F.when(F.col(name).isNotNull() & bad, F.concat(F.lit(f"{name}="), F.substring(F.col(name).cast("string"), 1, 100)))
    parts = [told(name, X.day(name).isNull()) for name in _DATES if name in df.columns]
    parts.append(told("valor", X.exact(F.col("valor").try_cast("double")).isNull()))
    return F.nullif(F.concat_ws(";", *parts), F.lit(""))


def normalize_ledger(df: DataFrame, traced: bool = False) -> DataFrame:
    """Common cleanup: typed dates, closing date, cut description, defaults, numeric amount. ``traced`` adds ``rechazo``, see :func:`rejections`."""
    posted = X.day("fecha_transaccion")
    closing = X.day("fecha_corte") if "fecha_corte" in df.columns else F.last_day(posted)
    return df.select(
        "empresa",
        closing.alias("fecha_corte"),
        posted.alias("fecha_transaccion"),
        F.col("cuenta_contable").cast("string").alias("cuenta_contable"),
        F.coalesce(F.col("id_proveedor").cast("string"), F.lit(C.NO_VENDOR_ID)).alias("id_proveedor"),
        X.text("nombre_tercero").alias("nombre_tercero"),
        F.substring(X.text("descripcion_gasto"), 1, C.DESCRIPTION_LENGTH).alias("descripcion_gasto"),
        X.number_or_zero("valor").alias("valor"),
        *([rejections(df).alias(REJECTED)] if traced else []),
    )


def display_defaults(df: DataFrame) -> DataFrame:
    """What the dashboards show for missing values; rows without a closing date are left out.

    Works on any selection of ledger columns that has the closing date.
    """
    shown = {
        "pais": ("empresa", X.country_of("empresa")),
        "grupo": ("grupo", F.coalesce("grupo", F.lit(C.NO_GROUP))),
        "subgrupo": ("subgrupo", F.coalesce("subgrupo", F.lit(C.NO_SUBGROUP))),
        "nombre_tercero": (
            "nombre_tercero",
            F.coalesce(F.nullif(F.col("nombre_tercero"), F.lit("")), F.lit(C.NO_VENDOR)),
        ),
        "status_gestion": ("status_gestion", F.coalesce("status_gestion", F.lit(C.DEFAULT_STATUS))),
        "clasificacion_manual": (
            "clasificacion_manual", F.coalesce("clasificacion_manual", F.lit(False))
        ),
        "valor": ("valor", X.number_or_zero("valor")),
    }
    return (
        df.withColumn("fecha_corte", X.day("fecha_corte"))
        .filter(F.col("fecha_corte").isNotNull())
        .withColumns({name: value for name, (source, value) in shown.items() if source in df.columns})
    )


def explorer_view(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in C.EXPLORER_COLUMNS if c in df.columns])
