"""One fixed schema per table of the engine."""

from __future__ import annotations

from pyspark.sql import types as T

from ledgerlens import config as C

TEXT, NUMBER, WHOLE, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
DAY, FLAG = T.DateType(), T.BooleanType()


def _schema(columns: dict[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns.items()])


# Canonical columns every journal is brought to.
_CANONICAL = {
    "empresa": TEXT, "fecha_corte": DAY, "fecha_transaccion": DAY, "cuenta_contable": TEXT,
    "id_proveedor": TEXT, "nombre_tercero": TEXT, "descripcion_gasto": TEXT, "valor": NUMBER,
}
CANONICAL = tuple(_CANONICAL)

# Columns a freshly loaded ledger lacks, with their type and default.
LATE_COLUMNS = {
    "grupo": ("string", None),
    "subgrupo": ("string", None),
    "status_gestion": ("string", C.DEFAULT_STATUS),
    "clasificacion_manual": ("boolean", False),
}

LEDGER = _schema(
    {
        "id_transaccion": WHOLE, **_CANONICAL,
        "grupo": TEXT, "subgrupo": TEXT, "status_gestion": TEXT, "clasificacion_manual": FLAG,
    },
    required=("id_transaccion",),
)

PARAMETER_KEY = ("fecha_corte", "pais", "categoria", "concepto")
PARAMETERS = _schema({
    "fecha_corte": DAY, "pais": TEXT, "categoria": TEXT, "concepto": TEXT, "valor": NUMBER, "descripcion": TEXT,
})

JOURNAL_A = _schema({
    "fecha_corte": DAY, "d_fecha_documento": DAY, "k_sc_codigo_cuenta": TEXT, "n_nit": TEXT, "sc_nombre": TEXT,
    "sc_nombre_cuenta": TEXT, "sv_observaciones": TEXT, "sc_nombre_centro_costo": TEXT, "n_valor": NUMBER,
})
JOURNAL_B = _schema({
    "fecha_corte": DAY, "fecha_docto": DAY, "cuenta": TEXT, "tercero": TEXT, "nombre_razon_social": TEXT,
    "detalle": TEXT, "c_o_descripcion": TEXT, "cuenta_descripcion": TEXT, "c_costo_descripcion": TEXT,
    "valor_l1": NUMBER, "d_c": TEXT,
})
JOURNAL_C = _schema({
    "fecha_corte": DAY, "FEC DOC": DAY, "CUENTA": TEXT, "ANEXO": TEXT, "CONCEPTO": TEXT, "C COSTO": TEXT,
    "DEBE  - MN": NUMBER, "HABER - MN": NUMBER,
})
JOURNAL_C_PLAIN = _schema({
    "fecha_corte": DAY, "fec_doc": DAY, "cuenta": TEXT, "anexo": TEXT, "concepto": TEXT, "centro_costo": TEXT,
    "debe_mn": NUMBER, "haber_mn": NUMBER,
})
JOURNAL_D = _schema({
    "Com_Numero": TEXT, "Com_Periodo": TEXT, "Cta_Codigo": TEXT, "Cli_Rut": TEXT, "Cdc_Codigo": TEXT,
    "Dco_Glosa": TEXT, "Dco_TipoDH": TEXT, "Dco_Valor": NUMBER,
})
CLIENT = _schema({"Cli_Rut": TEXT, "Cli_Nombre": TEXT})
ACCOUNT = _schema({"Cta_Codigo": TEXT, "Cta_Glosa": TEXT})
COST_CENTRE = _schema({"Cdc_Codigo": TEXT, "Cdc_glosa": TEXT})
VOUCHER = _schema({"Com_Numero": TEXT, "Com_Periodo": TEXT, "Com_Estado": TEXT})
JOURNAL_E = _schema({
    "num_comp": TEXT, "cod_cuenta": TEXT, "con_analisis1": TEXT, "dv_con_analisis1": TEXT, "glosa_det_comp": TEXT,
    "mto_deb_$": NUMBER, "mto_hab_$": NUMBER,
})
JOURNAL_E_HEADER = _schema({"num_comp": TEXT, "fecha_comp": DAY})

# Journal tables by layout and role.
JOURNAL_TABLES = {
    "A": {"journal": JOURNAL_A},
    "B": {"journal": JOURNAL_B},
    "C": {"journal": JOURNAL_C},
    "D": {
        "detail": JOURNAL_D, "client": CLIENT, "account": ACCOUNT, "cost_centre": COST_CENTRE,
        "voucher": VOUCHER,
    },
    "E": {"detail": JOURNAL_E, "header": JOURNAL_E_HEADER},
}
# The one company whose journal has the plain column names.
PLAIN_JOURNAL_C = "NC LEASING PERU"

TRAINING = _schema(dict.fromkeys(
    (C.SHEET_GROUP, C.SHEET_SUBGROUP, C.SHEET_DESCRIPTION, C.SHEET_ACCOUNT, C.SHEET_VENDOR), TEXT
))

UPDATES_BY_ID = _schema({
    "seq": WHOLE, "id_transaccion": WHOLE, "grupo": TEXT, "subgrupo": TEXT, "status_gestion": TEXT,
})
UPDATES_BY_VENDOR = _schema({
    "seq": WHOLE, "nombre_tercero": TEXT, "status_gestion": TEXT, "grupo": TEXT, "subgrupo": TEXT,
})
PREDICTION_INPUT = _schema({
    "id_transaccion": WHOLE, "empresa": TEXT, "cuenta_contable": TEXT, "descripcion_gasto": TEXT,
    "id_proveedor": TEXT, "nombre_tercero": TEXT,
})

EXCLUSIONS = _schema({"empresa": TEXT, "cuenta_contable": TEXT})
DEBT_BOOK = _schema({"country": TEXT, "type": TEXT, "balance_usd": NUMBER, "rate": NUMBER, "term_years": NUMBER})
PORTFOLIO = _schema({"country": TEXT, "perf": NUMBER, "npa": NUMBER})
CONCEPTS = _schema({"categoria": TEXT, "concepto": TEXT, "ord": INT})
LOANS = _schema({"scenario_id": TEXT, "amount": NUMBER, "rate": NUMBER, "term_years": NUMBER})
SCENARIO = _schema({
    "scenario_id": TEXT, "start_date": DAY, "horizon_years": NUMBER, "perf_start": NUMBER, "npa_start": NUMBER,
    "new_debt_amount": NUMBER, "new_debt_rate": NUMBER, "new_debt_type": TEXT, "rev_rate": NUMBER,
    "cof_rate": NUMBER, "prov_rate": NUMBER, "rec_npa_rate": NUMBER, "opex_pct": NUMBER, "tax_rate": NUMBER,
    "cogs": NUMBER, "dep_amort": NUMBER, "fx_impact": NUMBER, "non_op": NUMBER,
})
