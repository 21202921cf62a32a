"""Fixed values and defaults of the expense-ledger domain."""

from __future__ import annotations

# Company codes of the consolidated ledger.
COMPANIES = (
    "CONIX", "GFO", "LTCP", "LTCP2", "NCPF", "NC LEASING PERU", "AFI", "LTC",
    "NC SPA", "NC LEASING CHILE", "NC SA", "IN SA", "INCOFIN LEASING",
)

# Account prefixes counted as operating expense by the ledger queries.
EXPENSE_PREFIXES = ("31", "32", "42", "5")

# Account prefixes accepted on extraction.
JOURNAL_PREFIXES = ("31", "32", "42")

# Defaults of the ledger columns and of their display.
NO_VENDOR_ID = "SIN_ID"
NO_GROUP = "Sin Clasificar"
NO_SUBGROUP = "General"
NO_VENDOR = "Sin Proveedor"
STATUSES = ("Pendiente", "En Revisión", "Revisado", "Cerrado")
DEFAULT_STATUS = "Pendiente"
OPEN_STATUSES = ("Pendiente", "En Revisión")
DESCRIPTION_LENGTH = 500
ALL_COUNTRIES = "Todos"

# Company fragments that decide the country.
COLOMBIA_MARKS = ("CONIX", "GFO")
PERU_MARKS = ("LTCP", "NCPF", "LEASING PERU")

# Growth alerts compare this many months and need this last amount.
ALERT_MONTHS = 3
ALERT_FLOOR = 100
TREND_LABEL = "Crecimiento Sostenido"

# List lengths of the reports.
TOP_GROUPS = 10
TOP_VENDORS = 200
PENDING_LIMIT = 50

# Column order of the explorer report.
EXPLORER_COLUMNS = (
    "fecha_transaccion", "empresa", "cuenta_contable", "descripcion_gasto",
    "nombre_tercero", "valor", "grupo", "subgrupo",
)

# Countries and concept templates of the monthly closing parameters.
PARAMETER_COUNTRIES = ("Chile", "Colombia", "Perú", "Brasil")
REGIONAL = "Regional"
FX_CATEGORY = "Macro"
CONCEPTS = {
    "FIU": ("FIU Performing", "FIU NPA"),
    "PL_Close": (
        "Revenues", "Provisions & Writes off", "COF", "COGS", "OPEX",
        "Depreciation & Amortization", "Exchange rates",
        "Non operating rev/expenses", "Taxes",
    ),
    "Deuda": (
        "Banking", "B-Notes", "Bond", "FIP LTC I", "Intermediation", "NATF",
        "Senior Note", "Sp Mbr C",
    ),
    "Macro": ("USD/CLP", "USD/COP", "USD/PEN", "USD/BRL"),
}

# Opening portfolio by country (performing, non-performing; million USD).
PORTFOLIO = (
    ("Regional", 531.41, 71.30),
    ("Chile", 86.17, 21.28),
    ("Perú", 30.67, 21.95),
    ("Colombia", 97.25, 9.63),
    ("Brasil", 9.32, 18.44),
)

# Country whose debt is shared out among the others.
SHARED_DEBT_COUNTRY = "EEUU"

# Debt book (country, instrument, USD balance, yearly rate %, term in years).
DEBT_BOOK = (
    ("Chile", "Banking", 2777178.0, 7.45, 3.0),
    ("Chile", "B-Notes", 835000.0, 11.00, 3.0),
    ("Chile", "Bond", 12186466.0, 11.13, 5.0),
    ("Chile", "FIP LTC I", 5140426.0, 10.82, 4.0),
    ("Chile", "Intermediation", 35995050.0, 8.05, 1.0),
    ("Colombia", "Banking", 9827044.0, 11.13, 3.0),
    ("Colombia", "Intermediation", 385569.0, 14.92, 1.0),
    ("EEUU", "NATF", 78100000.0, 10.00, 5.0),
    ("EEUU", "Senior Note", 364304846.0, 4.72, 7.0),
    ("EEUU", "Sp Mbr C", 7500000.0, 10.00, 3.0),
    ("Perú", "B-Notes", 14362509.0, 13.01, 3.0),
)

# Debt projections run this many months; a smaller balance counts as repaid;
# a loan without a term runs this many years.
DEBT_MONTHS = 120
REPAID_BELOW = 0.01
DEFAULT_TERM_YEARS = 3.0
AMORTISED = "Amortizado"
BULLET = "Bullet"

# Default drivers of a projection (percent per year, million USD per year).
SCENARIO_DEFAULTS = {
    "horizon_years": 5.0,
    "new_debt_amount": 0.0,
    "new_debt_rate": 10.0,
    "new_debt_type": AMORTISED,
    "rev_rate": 24.0,
    "cof_rate": 8.6,
    "prov_rate": 2.1,
    "rec_npa_rate": 10.0,
    "opex_pct": 44.0,
    "tax_rate": 27.0,
    "cogs": 0.0,
    "dep_amort": 1.5,
    "fx_impact": 0.0,
    "non_op": 0.0,
}

# Text classifier.
VOCABULARY = 6000
# Hash values by which terms are counted first.
TERM_BUCKETS = 1 << 20
# Words that are paired and counted at once in a task.
TERM_PIECE = 1 << 21
# Partitions a forest is fitted on, at least, and rows of each.
FIT_PARTITIONS = 32
FIT_ROWS = 16_384
TREES = 150
MAX_DEPTH = 30
SEED = 42
TRAIN_PERCENT = 80
TOKEN_PATTERN = r"(?U)\b\w\w+\b"

# Column names of the labelled training sheet.
SHEET_GROUP = "Grupo"
SHEET_SUBGROUP = "Subgrupo"
SHEET_DESCRIPTION = "Glosa Documento nuevo"
SHEET_ACCOUNT = "Código Cuenta"
SHEET_VENDOR = "Rut Nuevo"
