"""SQL for the registered queries, written for DuckDB over the same tables.

Written independently of the DataFrame code: the test tables are turned into journals, ledger and
parameters by the CTEs below.
"""

from __future__ import annotations

from ledgerlens import config as C

_COMPANIES = """['CONIX','GFO','LTCP','LTCP2','NCPF','NC LEASING PERU','AFI','LTC','NC SPA','NC LEASING CHILE',
 'NC SA','IN SA','INCOFIN LEASING']"""

_ACCOUNT = "(['31','32','42','5','33','11'])[1 + {k} % 6] || lpad({k}::VARCHAR, 12, '0')"

# English stop words that are tokens, i.e. of two letters or more and without an apostrophe.
_STOP = str("""
me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they
them their theirs themselves what which who whom this that these those am is are was were be been being have has had having do
does did doing an the and but if or because as until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very can will just don should now cannot could ought would
""".split())

_CTE = {
    "lines": f"""lines AS (
  SELECT l.*, o_orderdate::DATE AS posted, o_orderstatus, o_orderpriority,
    ({_COMPANIES})[1 + l_orderkey % 13] AS empresa,
    {_ACCOUNT.format(k='l_partkey')} AS cuenta,
    CASE WHEN l_suppkey % 10 <> 0 THEN l_suppkey::VARCHAR END AS rut,
    CASE WHEN l_linenumber <> 3 THEN 'Línea ' || l_linenumber END AS glosa,
    CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE -l_extendedprice END AS signed
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey)""",
    "client": """client AS (
  SELECT s_suppkey, s_suppkey::VARCHAR AS rut,
    CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 11 = 0 THEN '' ELSE s_name END AS nombre
  FROM supplier)""",
    "star": """star AS (
  SELECT empresa, CASE WHEN l_linenumber <> 6 THEN l_orderkey::VARCHAR END AS num, strftime(posted, '%Y%m') AS per,
    cuenta, rut, (l_suppkey % 25)::VARCHAR AS cdc, glosa, CASE WHEN l_linestatus = 'O' THEN 'D' ELSE 'H' END AS dh,
    l_extendedprice AS monto
  FROM lines)""",
    "voucher": """voucher AS (
  SELECT o_orderkey::VARCHAR AS num, strftime(o_orderdate, '%Y%m') AS per,
    CASE WHEN o_orderstatus = 'P' THEN 'A' ELSE 'V' END AS estado FROM orders)""",
    "rich": f"""rich AS (
  SELECT s.*, c.nombre, p.glosa AS cta_glosa, n.n_name AS cdc_glosa
  FROM star s LEFT JOIN client c ON s.rut = c.rut
  LEFT JOIN (SELECT {_ACCOUNT.format(k='p_partkey')} AS cuenta, p_name || ' ' || p_type AS glosa FROM part) p
    ON s.cuenta = p.cuenta
  LEFT JOIN nation n ON s.cdc = n.n_nationkey::VARCHAR)""",
    "excl": f"""excl AS (
  SELECT unnest({_COMPANIES}) AS empresa, {_ACCOUNT.format(k='p_partkey')} AS cuenta FROM part WHERE p_partkey % 17 = 0)""",
    "canon_d": """canon_d AS (
  SELECT empresa, num, per, strptime(per || '01', '%Y%m%d')::DATE AS fecha_transaccion, cuenta AS cuenta_contable,
    rut AS id_proveedor, nombre AS nombre_tercero,
    coalesce(glosa,'') || ' ' || coalesce(cdc_glosa,'') || ' ' || coalesce(cta_glosa,'') AS descripcion_gasto,
    CASE WHEN dh = 'D' THEN monto WHEN dh = 'H' THEN -monto ELSE 0 END AS valor
  FROM rich)""",
    "loaded": """loaded AS (
  SELECT c.* FROM canon_d c JOIN voucher v USING (num, per)
  WHERE v.estado <> 'A' AND per >= '199701'
    AND (cuenta_contable LIKE '31%' OR cuenta_contable LIKE '32%' OR cuenta_contable LIKE '42%')
    AND NOT EXISTS (SELECT 1 FROM excl e WHERE e.empresa = c.empresa AND e.cuenta = c.cuenta_contable))""",
    "ledger": """ledger AS (
  SELECT l_orderkey * 67108864 + l_linenumber::BIGINT * 8388608 + (l_partkey % 2048) * 4096 + (l_suppkey % 64) * 64
      + l_quantity::BIGINT AS id_transaccion,
    empresa, last_day(posted) AS fecha_corte, posted AS fecha_transaccion, cuenta AS cuenta_contable,
    coalesce(rut, 'SIN_ID') AS id_proveedor, c.nombre AS nombre_tercero,
    p_name || ' ' || p_type || ' ' || n_name AS descripcion_gasto, signed AS valor,
    CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 5 THEN NULL ELSE p_type END AS grupo,
    CASE WHEN l_linenumber = 5 THEN NULL ELSE p_brand END AS subgrupo,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'Pendiente' WHEN '2' THEN 'En Revisión' WHEN '3' THEN 'Revisado'
      WHEN '4' THEN 'Cerrado' END AS status_gestion,
    l_returnflag = 'R' AS clasificacion_manual
  FROM lines JOIN (SELECT s_suppkey, nombre FROM client) c ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  JOIN nation ON n_nationkey = l_suppkey % 25)""",
    "view": """view_ AS (
  SELECT id_transaccion, empresa, fecha_corte, cuenta_contable, valor,
    CASE WHEN empresa IN ('CONIX','GFO') THEN 'Colombia'
      WHEN empresa IN ('LTCP','LTCP2','NCPF','NC LEASING PERU') THEN 'Perú' ELSE 'Chile' END AS pais,
    CASE WHEN nombre_tercero IS NULL OR nombre_tercero = '' THEN 'Sin Proveedor' ELSE nombre_tercero END AS nombre_tercero,
    coalesce(grupo, 'Sin Clasificar') AS grupo, coalesce(subgrupo, 'General') AS subgrupo,
    coalesce(status_gestion, 'Pendiente') AS status_gestion, coalesce(clasificacion_manual, FALSE) AS clasificacion_manual
  FROM ledger)""",
    "tx": """tx AS (
  SELECT * REPLACE (coalesce(grupo, 'Sin Clasificar') AS grupo, coalesce(subgrupo, 'General') AS subgrupo,
    coalesce(status_gestion, 'Pendiente') AS status_gestion, coalesce(clasificacion_manual, FALSE) AS clasificacion_manual)
  FROM ledger WHERE fecha_corte BETWEEN DATE '1998-01-01' AND DATE '1999-12-31')""",
    "upd_id": """upd_id AS (
  SELECT l_orderkey * 67108864 + l_linenumber::BIGINT * 8388608 + (l_partkey % 2048) * 4096 + (l_suppkey % 64) * 64
      + l_quantity::BIGINT AS id,
    CASE WHEN l_orderkey % 150 = 0 THEN 'REV' ELSE 'REV' || l_linenumber END AS g,
    CASE WHEN l_orderkey % 100 = 0 THEN 'S2' END AS s,
    CASE WHEN l_orderkey % 50 = 0 THEN 'Revisado' END AS st
  FROM lineitem WHERE l_orderkey % 50 = 0)""",
    "upd_vendor_raw": """upd_vendor_raw AS (
  SELECT nombre, s_suppkey * 3 AS seq, 'Cerrado' AS st, NULL::VARCHAR AS g FROM client
    WHERE nombre IS NOT NULL AND s_suppkey % 3 = 0
  UNION ALL SELECT nombre, s_suppkey * 3 + 1, NULL, 'MANUAL' || (s_suppkey % 4) FROM client
    WHERE nombre IS NOT NULL AND s_suppkey % 6 = 0)""",
    "upd_vendor": """upd_vendor AS (
  SELECT nombre, max(st) AS st, count(*) AS sent,
    (SELECT g FROM upd_vendor_raw i WHERE i.nombre = o.nombre AND g IS NOT NULL ORDER BY seq DESC LIMIT 1) AS g
  FROM upd_vendor_raw o GROUP BY nombre)""",
    "modes": """named AS (
  SELECT nombre_tercero, grupo, subgrupo FROM ledger
  WHERE grupo IS NOT NULL AND nombre_tercero <> '' AND nombre_tercero <> 'SIN_ID'),
modes AS (
  SELECT g.nombre_tercero, grupo_comun, subgrupo_comun FROM (
    SELECT nombre_tercero, grupo AS grupo_comun FROM named GROUP BY nombre_tercero, grupo
    QUALIFY row_number() OVER (PARTITION BY nombre_tercero ORDER BY count(*) DESC, grupo) = 1) g
  LEFT JOIN (
    SELECT nombre_tercero, subgrupo AS subgrupo_comun FROM named WHERE subgrupo IS NOT NULL GROUP BY nombre_tercero, subgrupo
    QUALIFY row_number() OVER (PARTITION BY nombre_tercero ORDER BY count(*) DESC, subgrupo) = 1) s
  ON g.nombre_tercero = s.nombre_tercero)""",
    "unified": """unified AS (
  SELECT l.*, m.grupo_comun, m.subgrupo_comun,
    coalesce((grupo <> grupo_comun OR subgrupo <> subgrupo_comun) AND NOT coalesce(clasificacion_manual, FALSE), FALSE) AS hit
  FROM ledger l LEFT JOIN modes m ON l.nombre_tercero = m.nombre_tercero)""",
    "concepts": """concepts AS (
  SELECT * FROM (VALUES (0,'FIU','FIU Performing',0),(1,'FIU','FIU NPA',1),(2,'PL_Close','Revenues',0),
    (3,'PL_Close','Provisions & Writes off',1),(4,'PL_Close','COF',2),(5,'PL_Close','COGS',3),(6,'PL_Close','OPEX',4),
    (7,'PL_Close','Depreciation & Amortization',5),(8,'PL_Close','Exchange rates',6),
    (9,'PL_Close','Non operating rev/expenses',7),(10,'PL_Close','Taxes',8),(11,'Deuda','Banking',0),
    (12,'Deuda','B-Notes',1),(13,'Deuda','Bond',2),(14,'Deuda','FIP LTC I',3),(15,'Deuda','Intermediation',4),
    (16,'Deuda','NATF',5),(17,'Deuda','Senior Note',6),(18,'Deuda','Sp Mbr C',7),(19,'Macro','USD/CLP',0),
    (20,'Macro','USD/COP',1),(21,'Macro','USD/PEN',2),(22,'Macro','USD/BRL',3)) t(i, categoria, concepto, ord))""",
    "keyed": """keyed AS (
  SELECT c_custkey AS k, c_acctbal AS valor, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS descripcion, 0 AS seq FROM customer
  UNION ALL SELECT c_custkey, c_acctbal + 1, 'lote', 1 FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT c_custkey, c_acctbal + 2, 'lote', 2 FROM customer WHERE c_custkey % 10 = 0
  UNION ALL SELECT c_custkey + 22080, c_acctbal, 'lote', 3 FROM customer WHERE c_custkey % 4 = 0),
all_params AS (
  SELECT last_day(DATE '2024-01-31' + to_months(CAST((k // 92) % 90000 AS INTEGER))) AS fecha_corte,
    CASE WHEN categoria = 'Macro' THEN 'Regional' ELSE (['Chile','Colombia','Perú','Brasil'])[1 + (k // 23) % 4] END AS pais,
    categoria, concepto, valor, descripcion, seq
  FROM keyed JOIN concepts ON k % 23 = i WHERE categoria <> 'Macro' OR (k // 23) % 4 = 0),
params AS (SELECT * EXCLUDE (seq) FROM all_params WHERE seq = 0)""",
    "debts": """weights AS (
  SELECT country AS vista, (perf + npa) / (531.41 + 71.30) AS w FROM (VALUES ('Chile',86.17,21.28),('Perú',30.67,21.95),
    ('Colombia',97.25,9.63),('Brasil',9.32,18.44)) t(country, perf, npa)),
debts AS (
  SELECT c_custkey AS debt_id, (['Chile','Colombia','Perú','Brasil','EEUU'])[1 + c_custkey % 5] AS country,
    (['Banking','B-Notes','Bond','FIP LTC I','Intermediation','NATF','Senior Note','Sp Mbr C'])[1 + c_custkey % 8] AS type,
    abs(c_acctbal) * 1000 AS usd, (c_custkey % 15)::DOUBLE AS rate, (c_custkey % 14) / 2::DOUBLE AS years FROM customer),
allocated AS (
  SELECT debt_id, 'Regional' AS vista, country, type, usd / 1000000 AS balance, rate, years FROM debts
  UNION ALL SELECT debt_id, country, country, type, usd / 1000000, rate, years FROM debts WHERE country <> 'EEUU'
  UNION ALL SELECT debt_id, vista, country, type || ' (' || vista || ' share)', usd / 1000000 * w, rate, years
    FROM debts, weights WHERE country = 'EEUU')""",
    "loans": """loans AS (
  SELECT c_custkey AS id, c_acctbal / 1000 AS amount, (c_custkey % 15) / 1200.0::DOUBLE AS r,
    coalesce(CASE WHEN c_custkey % 17 <> 0 THEN (c_custkey % 14) / 2::DOUBLE END, 3) AS years FROM customer)""",
    "scenario_loans": """loans AS (
  SELECT o_custkey::VARCHAR AS id, o_totalprice / 1000000 AS amount, (o_orderkey % 15) / 1200.0::DOUBLE AS r,
    coalesce(CASE WHEN o_orderkey % 17 <> 0 THEN (o_orderkey % 14) / 2::DOUBLE END, 3) AS years FROM orders)""",
    "country_loans": """loans AS (SELECT vista AS id, balance AS amount, rate / 1200 AS r, years FROM allocated)""",
    "country_scenarios": """scenarios AS (
  SELECT country AS id, DATE '2025-03-10' AS start_date, 60 AS n, perf, npa, 0::DOUBLE AS nd, 10 / 1200.0::DOUBLE AS nr, TRUE AS level_pay,
    24 / 1200.0::DOUBLE AS r_rev, 8.6::DOUBLE / 1200 AS r_cof, 2.1::DOUBLE / 1200 AS r_prov,
    1 - pow(1 - 10 / 100.0::DOUBLE, 1 / 12.0::DOUBLE) AS r_rec, 0.44::DOUBLE AS opex, 0.27::DOUBLE AS tax, 0::DOUBLE AS cogs,
    0.125::DOUBLE AS dep, 0::DOUBLE AS fx, 0::DOUBLE AS other
  FROM (VALUES ('Regional', 531.41::DOUBLE, 71.30::DOUBLE), ('Chile', 86.17, 21.28), ('Perú', 30.67, 21.95), ('Colombia', 97.25, 9.63),
    ('Brasil', 9.32, 18.44)) t(country, perf, npa)),
paid AS (SELECT *, NULL::DOUBLE AS cuota FROM scenarios)""",
    "schedule": """terms AS (
  SELECT *, greatest(1, floor(years * 12)) AS n FROM loans),
balances AS (
  SELECT id, m AS month, r, CASE WHEN amount <= 0 OR years <= 0 OR m >= n THEN 0 WHEN r = 0 THEN amount * (1 - m / n)
    ELSE amount * (pow(1 + r, n) - pow(1 + r, m)) / (pow(1 + r, n) - 1) END AS b
  FROM terms, (SELECT unnest(range(120))::INTEGER AS m) t),
schedule AS (SELECT id, month, CASE WHEN b > 0.01 THEN b * r ELSE 0 END AS interest FROM balances)""",
    "scenarios": """scenarios AS (
  SELECT c_custkey::VARCHAR AS id, DATE '2025-01-15' + CAST(c_custkey % 400 AS INTEGER) AS start_date,
    CAST((c_custkey % 5 + 1) * 12 AS INTEGER) AS n, sqrt(abs(c_acctbal)) * 5 AS perf, sqrt(abs(c_acctbal)) AS npa,
    (c_custkey % 4 * 5)::DOUBLE AS nd, (c_custkey % 3 * 5) / 1200.0::DOUBLE AS nr, c_custkey % 2 = 0 AS level_pay,
    (c_custkey % 20 + 10) / 1200.0::DOUBLE AS r_rev, (c_custkey % 7 + 4) / 1200.0::DOUBLE AS r_cof,
    (c_custkey % 5) / 2400.0::DOUBLE AS r_prov,
    1 - pow(1 - (CASE WHEN c_custkey % 10 = 0 THEN 100 ELSE c_custkey % 9 * 5 END) / 100.0::DOUBLE, 1 / 12.0::DOUBLE) AS r_rec,
    (c_custkey % 30 + 30) / 100.0::DOUBLE AS opex, 0.27::DOUBLE AS tax, (c_custkey % 6) / 12.0::DOUBLE AS cogs, 0.125::DOUBLE AS dep,
    (c_custkey % 5 - 2) / 12.0::DOUBLE AS fx, (c_custkey % 3 - 1) / 12.0::DOUBLE AS other
  FROM customer),
paid AS (
  SELECT *, CASE WHEN nd > 0 AND level_pay THEN CASE WHEN nr = 0 THEN nd / n ELSE nd * nr / (1 - pow(1 + nr, -n)) END END AS cuota
  FROM scenarios)""",
    "newdebt": """newdebt AS (
  SELECT id, 0 AS month, n, nr, nd, level_pay, cuota, nd AS balance FROM paid
  UNION ALL
  SELECT id, month + 1, n, nr, nd, level_pay, cuota, CASE WHEN nd > 0 AND level_pay THEN balance - (cuota - balance * nr) ELSE balance END
  FROM newdebt WHERE month + 1 < n),
nd_month AS (
  SELECT id, month, balance, balance * nr AS interest,
    CASE WHEN nd > 0 AND level_pay THEN cuota - balance * nr WHEN nd > 0 AND month = n - 1 THEN balance ELSE 0 END AS principal
  FROM newdebt)""",
    "pnl": """interest AS MATERIALIZED (SELECT id, month, sum(interest) AS i FROM schedule GROUP BY ALL),
months AS MATERIALIZED (
  SELECT d.id, d.month, d.interest + coalesce(i.i, 0) AS int_total, d.principal FROM nd_month d
  LEFT JOIN interest i ON d.id = i.id AND d.month = i.month),
run AS (
  SELECT id, -1 AS month, perf AS x1, npa AS a1, 0::DOUBLE AS x, 0::DOUBLE AS a, 0::DOUBLE AS int_total FROM scenarios
  UNION ALL
  SELECT r.id, m.month,
    r.x1 + (e - greatest(0, e * s.tax)) + s.dep + r.a1 * s.r_rec - m.principal, r.a1 - r.a1 * s.r_rec, r.x1, r.a1, m.int_total
  FROM run r JOIN scenarios s ON r.id = s.id JOIN months m ON m.id = r.id AND m.month = r.month + 1,
  LATERAL (SELECT (r.x1 * s.r_rev - (r.x1 + r.a1) * s.r_prov - r.x1 * s.r_cof - s.cogs) - r.x1 * s.r_rev * s.opex
    - s.dep + s.fx + s.other - m.int_total AS e)),
gross AS (
  SELECT r.*, s.start_date, x * r_rev AS rev, (x + a) * r_prov AS prov, x * r_cof AS cofs, s.cogs, s.dep, s.fx, s.other, s.tax,
    x * r_rev - (x + a) * r_prov - x * r_cof - s.cogs AS gi, x * r_rev * opex AS ox
  FROM run r JOIN scenarios s ON r.id = s.id WHERE month >= 0),
pnl AS (
  SELECT id AS scenario_id, month, last_day(start_date + to_months(month)) AS month_end, x1 AS fiu_performing, a1 AS fiu_npa,
    rev AS revenues, -prov AS provisions, -cofs AS cof, -cogs AS cogs, gi AS gross_income, -ox AS opex, gi - ox AS ebitda,
    -dep AS dep_amort, fx AS exchange_rates, other AS non_operating, -int_total AS financial_expenses,
    gi - ox - dep + fx + other - int_total AS ebt,
    -greatest(0, (gi - ox - dep + fx + other - int_total) * tax) AS taxes,
    (gi - ox - dep + fx + other - int_total) - greatest(0, (gi - ox - dep + fx + other - int_total) * tax) AS earnings
  FROM gross)""",
    "annual": """annual AS (
  SELECT scenario_id, year(month_end)::INTEGER AS year, arg_max(fiu_performing, month) AS fiu_performing, arg_max(fiu_npa, month) AS fiu_npa,
    sum(revenues) AS revenues, sum(provisions) AS provisions, sum(cof) AS cof, sum(cogs) AS cogs,
    sum(gross_income) AS gross_income, sum(opex) AS opex, sum(ebitda) AS ebitda, sum(dep_amort) AS dep_amort,
    sum(exchange_rates) AS exchange_rates, sum(non_operating) AS non_operating,
    sum(financial_expenses) AS financial_expenses, sum(ebt) AS ebt, sum(taxes) AS taxes, sum(earnings) AS earnings
  FROM pnl GROUP BY ALL)""",
    "sheet": """sheet AS (
  SELECT lang AS grupo, source AS subgrupo, text AS glosa, '5' || coalesce(quality::VARCHAR, '9') AS cuenta,
    CASE WHEN d.doc_id % 5 <> 0 THEN (d.doc_id % 40)::VARCHAR END AS rut
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
}

_LEDGER = ("lines", "client", "ledger")
_VIEW = (*_LEDGER, "view")
_TX = (*_LEDGER, "tx")
_STAR = ("lines", "client", "star", "voucher", "rich", "excl", "canon_d")
_LOADED = (*_STAR, "loaded")
_PARAMS = ("concepts", "keyed")
_PNL = ("scenario_loans", "schedule", "scenarios", "newdebt", "pnl")
_ANNUAL = (*_PNL, "annual")

_EXPENSE = "(cuenta_contable LIKE '31%' OR cuenta_contable LIKE '32%' OR cuenta_contable LIKE '42%' OR cuenta_contable LIKE '5%')"
_JOURNAL = "(cuenta_contable LIKE '31%' OR cuenta_contable LIKE '32%' OR cuenta_contable LIKE '42%')"
_PENDING = "(grupo IS NULL OR grupo = '') AND (clasificacion_manual IS FALSE OR clasificacion_manual IS NULL)"
_TOTAL = "CAST(sum(CAST(valor AS DECIMAL(28,6))) AS DOUBLE)"
_LAST3 = """last3 AS (
  SELECT m, row_number() OVER (ORDER BY m) AS i FROM (
    SELECT DISTINCT strftime(fecha_corte, '%Y-%m') AS m FROM view_ ORDER BY m DESC LIMIT 3))"""


def _with(ctes: tuple[str, ...], select: str, recursive: bool = False, extra: str = "") -> str:
    parts = [_CTE[c] for c in ctes] + ([extra] if extra else [])
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + select


def _norm(source: str) -> str:
    """Cleanup of one journal, as (empresa … valor)."""
    return f"""SELECT empresa, fecha_corte, fecha_transaccion, cuenta_contable, coalesce(id_proveedor, 'SIN_ID') AS id_proveedor,
  coalesce(nombre_tercero, '') AS nombre_tercero, left(coalesce(descripcion_gasto, ''), 500) AS descripcion_gasto,
  coalesce(valor, 0) AS valor FROM ({source}) j
  WHERE NOT EXISTS (SELECT 1 FROM excl e WHERE e.empresa = j.empresa AND e.cuenta = j.cuenta_contable)"""


_CANON_A = """SELECT empresa, last_day(posted) AS fecha_corte, posted AS fecha_transaccion, cuenta AS cuenta_contable,
  rut AS id_proveedor, c.nombre AS nombre_tercero, concat_ws(' ', p_name, glosa, n_name) AS descripcion_gasto, signed AS valor
  FROM lines JOIN (SELECT s_suppkey, nombre FROM client) c ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey JOIN nation ON n_nationkey = l_suppkey % 25
  WHERE empresa = 'CONIX'"""
_CANON_B = """SELECT empresa, last_day(posted) AS fecha_corte, posted AS fecha_transaccion, cuenta AS cuenta_contable,
  rut AS id_proveedor, c.nombre AS nombre_tercero, concat_ws(' ', glosa, p_type, p_name, n_name) AS descripcion_gasto,
  CASE WHEN l_linenumber = 4 THEN 0 ELSE signed END AS valor
  FROM lines JOIN (SELECT s_suppkey, nombre FROM client) c ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  JOIN nation ON n_nationkey = l_suppkey % 25 WHERE empresa = 'GFO'"""
_CANON_C = """SELECT empresa, last_day(posted) AS fecha_corte, posted AS fecha_transaccion, cuenta AS cuenta_contable,
  rut AS id_proveedor, NULL::VARCHAR AS nombre_tercero, concat_ws(' ', glosa, 'CC' || (l_suppkey % 25)) AS descripcion_gasto,
  signed AS valor FROM lines"""
_CANON_E = """SELECT empresa, {closing}posted AS fecha_transaccion, cuenta AS cuenta_contable,
  coalesce(rut, '') || '-' || (l_suppkey % 10) AS id_proveedor, NULL::VARCHAR AS nombre_tercero, coalesce(glosa, '') AS descripcion_gasto,
  signed AS valor FROM lines WHERE empresa = 'INCOFIN LEASING'"""
_CANON_D = """SELECT empresa, last_day(fecha_transaccion) AS fecha_corte, fecha_transaccion, cuenta_contable, id_proveedor, nombre_tercero,
  descripcion_gasto, valor FROM canon_d"""
_LIVE = "EXISTS (SELECT 1 FROM voucher v WHERE v.num = canon_d.num AND v.per = canon_d.per AND v.estado <> 'A')"
_SA = f"""{_CANON_D} WHERE empresa = 'NC SA' AND CAST(left(per, 4) AS INTEGER) >= 1997
  AND (cuenta_contable LIKE '3%' OR cuenta_contable LIKE '42%') AND {_LIVE}"""


def _all_lines(sql: str, empresa: str) -> str:
    """The SQL of one company's journal over the lines of all."""
    return sql.replace(f"WHERE empresa = '{empresa}'", "").replace("SELECT empresa,", f"SELECT '{empresa}' AS empresa,", 1)


_CONSOLIDATE = " UNION ALL ".join(_norm(s) for s in (
    f"{_CANON_A} AND posted >= DATE '1997-01-01' AND cuenta LIKE '5%'",
    f"{_CANON_B} AND posted >= DATE '1996-01-01' AND cuenta LIKE '5%'",
    f"""{_CANON_C} WHERE empresa IN ('LTCP','LTCP2','NCPF','NC LEASING PERU') AND posted >= DATE '1997-01-01'
  AND {_JOURNAL.replace('cuenta_contable', 'cuenta')}""",
    f"{_CANON_D} WHERE empresa IN ('AFI','LTC') AND num IS NOT NULL AND per >= '199701' AND {_JOURNAL}",
    f"{_CANON_D} WHERE empresa IN ('NC SPA','NC LEASING CHILE','IN SA') AND per >= '199701' AND {_JOURNAL} AND {_LIVE}",
    _SA,
    f"{_CANON_E.format(closing='last_day(posted) AS fecha_corte, ')} AND posted >= DATE '1997-01-01' AND {_JOURNAL.replace('cuenta_contable', 'cuenta')}",
))

_ALERTS = """SELECT {name} AS proveedor, m1, m2, m3 FROM (
  SELECT {name}, sum(CASE WHEN i = 1 THEN CAST(valor AS DECIMAL(28,6)) ELSE 0 END) AS m1,
    sum(CASE WHEN i = 2 THEN CAST(valor AS DECIMAL(28,6)) ELSE 0 END) AS m2,
    sum(CASE WHEN i = 3 THEN CAST(valor AS DECIMAL(28,6)) ELSE 0 END) AS m3
  FROM {source} v JOIN last3 ON strftime(fecha_corte, '%Y-%m') = m GROUP BY ALL)
  WHERE m3 > m2 AND m2 > m1 AND m3 > 100"""


def _alerts(name: str, source: str) -> str:
    return f"""SELECT proveedor, 'Crecimiento Sostenido' AS tendencia, round(m1::DOUBLE, 4) AS mes_1, round(m2::DOUBLE, 4) AS mes_2,
  round(m3::DOUBLE, 4) AS mes_actual,
  round(CASE WHEN m1 = 0 THEN 1 ELSE (m3::DOUBLE - m1::DOUBLE) / m1::DOUBLE END, 4) AS var_pct
  FROM ({_ALERTS.format(name=name, source=source)})"""


_FLOWS = ("revenues", "provisions", "cof", "cogs", "gross_income", "opex", "ebitda", "dep_amort", "exchange_rates",
          "non_operating", "financial_expenses", "ebt", "taxes", "earnings")
_MEASURES = ", ".join(f"round({c}, 4) AS {c}" for c in ("fiu_performing", "fiu_npa", *_FLOWS))
_STATEMENT = " UNION ALL ".join(
    f"SELECT scenario_id, year::VARCHAR AS period, year AS period_no, {i} AS line_no, '{line}' AS line, round({value}, 4) AS value FROM annual"
    for i, (line, value) in enumerate((
        ("FIU Performing", "fiu_performing"), ("FIU NPA", "fiu_npa"), ("Total FIU", "fiu_performing + fiu_npa"),
        ("Revenues", "revenues"), ("Provisions & Writes off", "provisions"), ("COF", "cof"), ("COGS", "cogs"),
        ("Gross Income", "gross_income"), ("OPEX", "opex"), ("Op. Income / EBITDA", "ebitda"),
        ("Depreciation & Amortization", "dep_amort"), ("Exchange rates", "exchange_rates"),
        ("Non operating rev/expenses", "non_operating"), ("Financial Expenses", "financial_expenses"),
        ("Earnings before tax (EBT)", "ebt"), ("Taxes", "taxes"), ("Earnings (Net Income)", "earnings"),
        ("Gross Margin %", "CASE WHEN revenues = 0 THEN 0 ELSE gross_income / revenues * 100 END"),
        ("Operating Margin %", "CASE WHEN revenues = 0 THEN 0 ELSE ebitda / revenues * 100 END"),
        ("Net Margin %", "CASE WHEN revenues = 0 THEN 0 ELSE earnings / revenues * 100 END"),
    ), 1)
)
_UPDATED = "id_transaccion, nombre_tercero, grupo, subgrupo, status_gestion, clasificacion_manual"
_CHOSEN = {
    "pais": "pais IN ('Chile','Perú')",
    "empresa": "empresa IN ('LTCP','NCPF','AFI','IN SA','GFO')",
    "grupo": "grupo IN ('ECONOMY','SMALL','Sin Clasificar')",
    "subgrupo": "subgrupo IN ('Brand#2','Brand#17','General')",
}


def _facets() -> str:
    tests, parts = ["TRUE"], []
    for level in ("pais", "empresa", "grupo", "subgrupo", "nombre_tercero"):
        parts.append(f"SELECT DISTINCT '{level}' AS nivel, {level} AS valor FROM view_ WHERE {' AND '.join(tests)}")
        if level in _CHOSEN:
            tests.append(_CHOSEN[level])
    return " UNION ALL ".join(parts)


def _mode(column: str) -> str:
    return f"""(SELECT nombre_tercero, {column} FROM chosen GROUP BY nombre_tercero, {column}
    QUALIFY row_number() OVER (PARTITION BY nombre_tercero ORDER BY count(*) DESC, {column}) = 1)"""


_BY_ID = (*_LEDGER, "upd_id")
_BY_BOTH = (*_LEDGER, "upd_id", "upd_vendor_raw", "upd_vendor")


_CORRECTED = "SELECT id_transaccion, nombre_tercero, grupo, subgrupo, status_gestion, clasificacion_manual FROM fixed"


def _after(source: str, by_vendor: bool = False) -> str:
    """The ledger after the corrections, as the table ``source``, and the dashboards' view of it."""
    both = """ LEFT JOIN upd_vendor v ON l.nombre_tercero = v.nombre""" if by_vendor else ""
    pick = (lambda c, f: f"coalesce(v.{c}, u.{c}, l.{f})") if by_vendor else (lambda c, f: f"coalesce(u.{c}, l.{f})")
    manual = "CASE WHEN v.g IS NOT NULL THEN TRUE ELSE clasificacion_manual END" if by_vendor else "clasificacion_manual"
    view = _CTE["view"].replace("view_ AS", "shown AS").replace("FROM ledger)", f"FROM {source})")
    return f"""{source} AS (
  SELECT l.* REPLACE ({pick('g', 'grupo')} AS grupo, coalesce(u.s, l.subgrupo) AS subgrupo, {pick('st', 'status_gestion')} AS status_gestion,
    {manual} AS clasificacion_manual)
  FROM ledger l LEFT JOIN upd_id u ON l.id_transaccion = u.id{both}),
{view}"""


def oracle_sql() -> dict[str, str]:
    return {
        "etl_summary": _with(_LOADED, f"""SELECT empresa, strftime(last_day(fecha_transaccion), '%Y-%m') AS periodo, {_TOTAL} AS total
  FROM loaded WHERE year(fecha_transaccion) = 1998 AND {_EXPENSE} GROUP BY ALL ORDER BY 2, 1"""),
        "split_80_20": """WITH t AS (
  SELECT lower(concat_ws(' ', '5' || coalesce(quality::VARCHAR, '9'), CASE WHEN doc_id % 5 <> 0 THEN (doc_id % 40)::VARCHAR ELSE '' END,
    coalesce(text, ''))) AS texto
  FROM documents LEFT JOIN labels USING (doc_id) WHERE lang IS NOT NULL)
SELECT count(*) AS rows, count(*) FILTER (train) AS train_rows, 0::BIGINT AS split_texts, round(avg(train::INT), 1) AS train_share
FROM (SELECT ('0x' || substr(md5('42|' || texto), 1, 8))::BIGINT % 100 < 80 AS train FROM t)""",
        "tfidf": f"""WITH d AS (
  SELECT row_number() OVER () AS i, lang AS grupo, '5' || coalesce(quality::VARCHAR, '9') AS cuenta_contable,
    lower(concat_ws(' ', '5' || coalesce(quality::VARCHAR, '9'), CASE WHEN doc_id % 5 <> 0 THEN (doc_id % 40)::VARCHAR ELSE '' END, coalesce(text, ''))) AS texto
  FROM documents LEFT JOIN labels USING (doc_id) WHERE lang IS NOT NULL),
w AS (SELECT i, list_filter(regexp_extract_all(texto, '[\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Pc}}]{{2,}}'), lambda x: NOT list_contains({_STOP}, x)) AS w FROM d),
t AS (SELECT i, unnest(list_concat(w, list_transform(list_zip(w[:-2], w[2:]), lambda x: x[1] || ' ' || x[2]))) AS term FROM w),
c AS (SELECT i, term, count(*) AS n FROM t GROUP BY ALL),
v AS (SELECT term, count(*) AS df FROM c GROUP BY term ORDER BY sum(n) DESC, term LIMIT {C.VOCABULARY}),
x AS (SELECT i, n * (ln((1 + (SELECT count(*) FROM d)) / (1 + df)::DOUBLE) + 1) AS x FROM c JOIN v USING (term)),
s AS (SELECT i, count(*)::INT AS terms, max(x) / sqrt(sum(x * x)) AS top FROM x GROUP BY i)
SELECT grupo, cuenta_contable, coalesce(terms, 0)::INT AS terms, round(coalesce(top, 0), 6) AS top_weight FROM d LEFT JOIN s USING (i)""",
        "read_source": _with(_STAR, _norm(_SA)),
        "canonical_a": _with(("lines", "client"), _all_lines(_CANON_A, "CONIX")),
        "canonical_b": _with(("lines", "client"), _all_lines(_CANON_B, "GFO")),
        "canonical_c": _with(("lines",), f"{_all_lines(_CANON_C, 'LTCP')} UNION ALL {_all_lines(_CANON_C, 'NC LEASING PERU')}"),
        "canonical_d": _with(_STAR, """SELECT empresa, fecha_transaccion, cuenta_contable, id_proveedor, nombre_tercero, descripcion_gasto, valor
  FROM canon_d"""),
        "canonical_e": _with(("lines",), _all_lines(_CANON_E.format(closing=""), "INCOFIN LEASING")),
        "normalize_ledger": """SELECT lang AS empresa, last_day(f) AS fecha_corte, f AS fecha_transaccion, doc_id::VARCHAR AS cuenta_contable,
  CASE WHEN doc_id % 3 <> 0 THEN source ELSE 'SIN_ID' END AS id_proveedor,
  CASE WHEN doc_id % 5 <> 0 THEN source ELSE '' END AS nombre_tercero, left(coalesce(text, ''), 500) AS descripcion_gasto,
  CASE WHEN doc_id % 4 = 0 THEN 0 ELSE n_chars / 4::DOUBLE END AS valor
  FROM (SELECT *, CASE WHEN doc_id % 13 <> 0 THEN CAST('2025-0' || (doc_id % 9 + 1) || '-15' AS DATE) END AS f FROM documents)""",
        "consolidate": _with(_STAR, _CONSOLIDATE),
        "ledger_full_refresh": _with(_STAR, f"""SELECT *, NULL::VARCHAR AS grupo, NULL::VARCHAR AS subgrupo, 'Pendiente' AS status_gestion,
  FALSE AS clasificacion_manual FROM ({_CONSOLIDATE})"""),
        "ingest_audit": _with(_STAR, f"""SELECT c.empresa, count(l.empresa) AS filas,
  CASE WHEN c.empresa <> 'GFO' THEN 'ok' WHEN count(l.empresa) > 0 THEN 'conservado' ELSE 'error' END AS estado, c.empresa = 'GFO' AS con_error
  FROM (SELECT unnest({_COMPANIES}) AS empresa) c LEFT JOIN ({_CONSOLIDATE}) l ON c.empresa = l.empresa GROUP BY c.empresa"""),
        "load_ids": _with(_STAR, f"""SELECT count(*) AS filas, count(*) AS ids, 1::BIGINT AS primero, count(*) AS ultimo
  FROM ({_CONSOLIDATE})"""),
        "audit_totals": _with(_STAR, f"""SELECT c.empresa, count(l.empresa) AS filas, coalesce({_TOTAL}, 0) AS total, 0::BIGINT AS fechas_rechazadas,
  0::BIGINT AS importes_rechazados FROM (SELECT unnest({_COMPANIES}) AS empresa) c LEFT JOIN ({_CONSOLIDATE}) l ON c.empresa = l.empresa
  GROUP BY c.empresa"""),
        "rejections": """SELECT doc_id::VARCHAR AS cuenta_contable,
  CASE WHEN doc_id % 13 <> 0 THEN CAST('2025-0' || (doc_id % 9 + 1) || '-15' AS DATE) END AS fecha_transaccion,
  CASE WHEN doc_id % 4 = 0 THEN 0 ELSE n_chars / 4::DOUBLE END AS valor,
  concat_ws(';', CASE WHEN doc_id % 13 = 0 THEN 'fecha_transaccion=sin fecha' END, CASE WHEN doc_id % 4 = 0 THEN 'valor=n/a' END) AS rechazo
  FROM documents WHERE doc_id % 13 = 0 OR doc_id % 4 = 0""",
        "concept_template": _with(_PARAMS, """SELECT c.categoria, c.concepto, c.ord::INTEGER AS ord, count(p.concepto) AS guardados
  FROM concepts c LEFT JOIN params p ON p.categoria = c.categoria AND p.concepto = c.concepto GROUP BY ALL"""),
        "debt_book": f"""SELECT b.country, b.type, b.balance_usd::DOUBLE AS balance_usd, b.rate::DOUBLE AS rate, b.term_years::DOUBLE AS term_years,
  p.perf::DOUBLE AS perf, p.npa::DOUBLE AS npa, coalesce(n, 0) AS instruments
  FROM (VALUES {", ".join(map(str, C.DEBT_BOOK))}) b(country, type, balance_usd, rate, term_years)
  LEFT JOIN (VALUES {", ".join(map(str, C.PORTFOLIO))}) p(country, perf, npa) ON b.country = p.country
  LEFT JOIN (SELECT (['Chile','Colombia','Perú','Brasil','EEUU'])[1 + c_custkey % 5] AS country, ({list(C.CONCEPTS["Deuda"])})[1 + c_custkey % 8] AS type,
    count(*) AS n FROM customer GROUP BY ALL) d ON d.country = b.country AND d.type = b.type""",
        "source_registry": _with(_LEDGER, f"""SELECT r.empresa, layout, since, prefixes, voucher_rule, filas
  FROM (SELECT unnest({_COMPANIES}) AS empresa, unnest(['A','B','C','C','C','C','D','D','D','D','D','D','E']) AS layout,
    unnest(['5','5','31,32,42','31,32,42','31,32,42','31,32,42','31,32,42','31,32,42','31,32,42','31,32,42','3,42','31,32,42',
      '31,32,42']) AS prefixes,
    unnest([NULL,NULL,NULL,NULL,NULL,NULL,'number','number','status','status','status','status',NULL]) AS voucher_rule) r
  JOIN (SELECT empresa, CASE WHEN empresa = 'GFO' THEN DATE '1996-01-01' ELSE DATE '1997-01-01' END AS since,
    count(*) FILTER (fecha_transaccion >= CASE WHEN empresa = 'GFO' THEN DATE '1996-01-01' ELSE DATE '1997-01-01' END) AS filas
    FROM ledger GROUP BY ALL) c ON r.empresa = c.empresa"""),
        "account_prefix_filter": _with(_LEDGER, f"SELECT id_transaccion, empresa, cuenta_contable, valor FROM ledger WHERE {_EXPENSE}"),
        "account_exclusion": _with((*_LEDGER, "excl"), """SELECT id_transaccion, empresa, cuenta_contable, valor FROM ledger l
  WHERE NOT EXISTS (SELECT 1 FROM excl e WHERE e.empresa = l.empresa AND e.cuenta = l.cuenta_contable)"""),
        "period_filter": _with(("lines", "star"), """SELECT 'period' AS kind, empresa, count(*) AS filas FROM star WHERE per >= '199701' GROUP BY ALL
  UNION ALL SELECT 'year', empresa, count(*) FROM star WHERE CAST(left(per, 4) AS INTEGER) >= 1997 GROUP BY ALL
  UNION ALL SELECT 'date', empresa, count(*) FROM star WHERE strptime(per || '01', '%Y%m%d') >= DATE '1996-01-01' GROUP BY ALL"""),
        "source_ranges": _with(("lines", "star"), """SELECT r AS rango, count(g) AS filas FROM (SELECT unnest(range(0, 25))::INTEGER AS r)
  LEFT JOIN (SELECT CASE WHEN per IS NULL OR per < '199701' THEN 0
    ELSE least(24, (CAST(left(per, 4) AS INTEGER) - 1997) * 12 + CAST(substr(per, 5, 2) AS INTEGER)) END AS g FROM star) ON r = g GROUP BY r"""),
        "voucher_valid": _with(("lines", "star", "voucher"), """SELECT s.empresa, count(s.num) AS con_numero,
  count(CASE WHEN v.estado <> 'A' THEN 1 END) AS vigentes
  FROM star s LEFT JOIN voucher v ON s.num = v.num AND s.per = v.per GROUP BY ALL"""),
        "enrich_dims": _with(("lines", "client", "star", "rich"), """SELECT num AS "Com_Numero", cuenta AS "Cta_Codigo", rut AS "Cli_Rut", cdc AS "Cdc_Codigo",
  nombre AS "Cli_Nombre", cta_glosa AS "Cta_Glosa", cdc_glosa AS "Cdc_glosa", monto AS "Dco_Valor" FROM rich"""),
        "join_header": _with(("lines", "star", "voucher"), """SELECT s.num AS "Com_Numero", s.per AS "Com_Periodo", cuenta AS "Cta_Codigo",
  monto AS "Dco_Valor", estado AS "Com_Estado" FROM star s JOIN voucher v ON s.num = v.num AND s.per = v.per"""),
        "join_detail_header": _with(("lines",), """SELECT l_orderkey::VARCHAR AS num_comp, cuenta AS cod_cuenta,
  CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE 0 END AS "mto_deb_$",
  CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_extendedprice END AS "mto_hab_$", posted AS fecha_comp
  FROM lines"""),
        "assign_ids": """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS id_transaccion,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem""",
        "evolve_schema": _with(_LEDGER, """SELECT id_transaccion, NULL::VARCHAR AS grupo, NULL::VARCHAR AS subgrupo,
  'Pendiente' AS status_gestion, FALSE AS clasificacion_manual FROM ledger"""),
        "ledger_version": _with(_LEDGER, f"""SELECT empresa, count(*) AS filas, {_TOTAL} AS total, max(fecha_corte) AS ultima_fecha
  FROM ledger GROUP BY ALL"""),
        "export_csv_bom": _with(_LEDGER, f"""SELECT empresa, count(*) AS filas, {_TOTAL} AS total,
  count(nullif(grupo, '')) AS con_grupo FROM ledger GROUP BY ALL"""),
        "scalar_functions": """SELECT doc_id, concat_ws(' ', lang, part, 'x') AS skipping,
  coalesce(lang, '') || ' ' || coalesce(part, '') || ' x' AS keeping, d AS period_day, last_day(d) AS month_end,
  strftime(d, '%Y-%m') AS month, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE n_chars END::DOUBLE AS number,
  format('${:,.0f}', n_chars * CASE WHEN doc_id % 2 = 0 THEN 1234.5 ELSE -1234.25 END::DOUBLE) AS label,
  contains(lower(text), 'the') AS has_the, (2020 + doc_id % 6) IN (2021, 2023) AS odd_year
  FROM (SELECT *, CASE WHEN doc_id % 3 <> 0 THEN source END AS part,
    CASE WHEN doc_id % 14 BETWEEN 1 AND 12 THEN make_date(2020 + doc_id % 6, doc_id % 14, 1) END AS d FROM documents)""",
        "ledger_scan": _with(_LEDGER, f"""SELECT id_transaccion, cuenta_contable, id_proveedor, descripcion_gasto FROM ledger WHERE {_PENDING}"""),
        "summary": _with(_LEDGER, f"""SELECT empresa, strftime(fecha_corte, '%Y-%m') AS periodo, {_TOTAL} AS total FROM ledger
  WHERE year(fecha_corte) = 1998 AND {_EXPENSE} GROUP BY ALL ORDER BY 2, 1"""),
        "categories": _with(_LEDGER, """SELECT DISTINCT 'grupo' AS kind, grupo AS value FROM ledger WHERE grupo <> ''
  UNION ALL SELECT DISTINCT 'subgrupo', subgrupo FROM ledger WHERE subgrupo <> ''"""),
        "transactions": _with(_TX, f"""SELECT * FROM tx WHERE {_EXPENSE}
  AND empresa IN ('CONIX','GFO','LTCP','LTCP2','NCPF','NC LEASING PERU','AFI','LTC')"""),
        "transactions_account": _with(_TX, "SELECT * EXCLUDE (descripcion_gasto) FROM tx WHERE cuenta_contable LIKE '33%'"),
        "transactions_vendor": _with(_TX, "SELECT * EXCLUDE (descripcion_gasto) FROM tx WHERE nombre_tercero ILIKE '%SUPPLIER#00000000%'"),
        "sort_date_value": _with(_TX, f"""SELECT id_transaccion, empresa, fecha_corte, cuenta_contable, valor, grupo, subgrupo, status_gestion,
  clasificacion_manual FROM tx WHERE {_EXPENSE} ORDER BY fecha_corte DESC, valor DESC, id_transaccion LIMIT 500"""),
        "pending": _with(_LEDGER, f"""SELECT id_transaccion, empresa, fecha_corte, cuenta_contable, valor, grupo, clasificacion_manual FROM ledger
  WHERE {_PENDING} AND {_EXPENSE} ORDER BY fecha_corte DESC, id_transaccion LIMIT 100"""),
        "pending_all": _with(_LEDGER, f"SELECT id_transaccion, grupo, clasificacion_manual FROM ledger WHERE {_PENDING}"),
        "pending_count": _with(_LEDGER, f"SELECT count(*) AS pendientes FROM ledger WHERE {_PENDING}"),
        "classified_count": _with(_LEDGER, "SELECT count(*) AS clasificados FROM ledger WHERE grupo <> ''"),
        "display_defaults": _with(_VIEW, """SELECT id_transaccion, empresa, fecha_corte, nombre_tercero, grupo, subgrupo, status_gestion,
  clasificacion_manual, valor, pais FROM view_"""),
        "country_of": _with(_VIEW, "SELECT pais, empresa, count(*) AS filas FROM view_ GROUP BY ALL"),
        "explorer_view": _with(_LEDGER, """SELECT fecha_transaccion, empresa, cuenta_contable, descripcion_gasto, nombre_tercero, valor, grupo, subgrupo
  FROM ledger"""),
        "explorer_kpis": _with(_TX, f"""SELECT count(*) AS registros, {_TOTAL} AS monto_total, count(DISTINCT empresa) AS empresas
  FROM tx WHERE {_EXPENSE}"""),
        "facet_filter": _with(_VIEW, f"""SELECT id_transaccion, pais, empresa, grupo, subgrupo, nombre_tercero, valor FROM view_
  WHERE {' AND '.join(_CHOSEN.values())}"""),
        "facet_values": _with(_VIEW, _facets()),
        "status_filter": _with(_VIEW, f"""SELECT status_gestion, count(*) AS filas, {_TOTAL} AS total FROM view_
  WHERE status_gestion IN ('Pendiente', 'En Revisión') GROUP BY ALL"""),
        "kpi_country_totals": _with(_VIEW, """SELECT CAST(sum(v) AS DOUBLE) AS total, CAST(sum(v) FILTER (pais = 'Chile') AS DOUBLE) AS total_chile,
  CAST(sum(v) FILTER (pais = 'Colombia') AS DOUBLE) AS total_colombia, CAST(sum(v) FILTER (pais = 'Perú') AS DOUBLE) AS total_peru
  FROM (SELECT pais, CAST(valor AS DECIMAL(28,6)) AS v FROM view_)"""),
        "top_groups": _with(_VIEW, f"""SELECT * FROM (SELECT grupo || ' / ' || subgrupo AS grupo, {_TOTAL} AS valor FROM view_ GROUP BY ALL
  ORDER BY valor DESC, grupo LIMIT 10) ORDER BY valor, grupo DESC"""),
        "vendor_rollup": _with(_VIEW, f"""SELECT t.nombre_tercero, t.empresa, g.grupo, s.subgrupo, t.valor, st.status_gestion,
  format('${{:,.0f}}', t.valor) AS valor_fmt
  FROM (SELECT nombre_tercero, string_agg(DISTINCT empresa, ', ' ORDER BY empresa) AS empresa, {_TOTAL} AS valor FROM chosen GROUP BY ALL) t
  JOIN {_mode('grupo')} g USING (nombre_tercero) JOIN {_mode('subgrupo')} s USING (nombre_tercero)
  JOIN {_mode('status_gestion')} st USING (nombre_tercero) ORDER BY valor DESC, nombre_tercero LIMIT 200""",
            extra="chosen AS (SELECT * FROM view_ WHERE status_gestion IN ('Pendiente', 'En Revisión'))"),
        "vendor_class_counts": _with(_TX, """SELECT nombre_tercero, grupo, subgrupo, count(*) AS registros FROM tx
  WHERE lower(nombre_tercero) LIKE '%supplier#0000000%' GROUP BY ALL"""),
        "monthly_trend": _with(_VIEW, """SELECT strftime(m, '%Y-%m') AS mes, coalesce(CAST(t AS DOUBLE), 0) AS valor
  FROM (SELECT unnest(generate_series(DATE '1994-01-01', DATE '2002-12-01', INTERVAL 1 MONTH)) AS m)
  LEFT JOIN (SELECT strftime(fecha_corte, '%Y-%m') AS mes, sum(CAST(valor AS DECIMAL(28,6))) AS t FROM view_ GROUP BY ALL) x
    ON strftime(m, '%Y-%m') = x.mes"""),
        "vendor_trend": _with(_VIEW, f"""SELECT strftime(fecha_corte, '%Y-%m') AS mes, grupo, {_TOTAL} AS valor FROM view_
  WHERE nombre_tercero = 'Supplier#000000005' GROUP BY ALL"""),
        "month_vendor_matrix": _with(_VIEW, """SELECT m.mes, n.nombre_tercero, coalesce(CAST(t AS DOUBLE), 0) AS valor
  FROM (SELECT DISTINCT strftime(fecha_corte, '%Y-%m') AS mes FROM view_) m
  CROSS JOIN (SELECT DISTINCT nombre_tercero FROM view_) n
  LEFT JOIN (SELECT strftime(fecha_corte, '%Y-%m') AS mes, nombre_tercero, sum(CAST(valor AS DECIMAL(28,6))) AS t FROM view_ GROUP BY ALL) x
    ON m.mes = x.mes AND n.nombre_tercero = x.nombre_tercero"""),
        "growth_alerts": _with(_VIEW, _alerts("nombre_tercero", "view_"), extra=_LAST3),
        "alerts_sorted": _with(_VIEW, _alerts("nombre", "(SELECT *, nombre_tercero || ' / ' || grupo AS nombre FROM view_)")
                               + " ORDER BY mes_actual DESC, proveedor", extra=_LAST3),
        "update_by_id": _with((*_LEDGER, "upd_id"), """SELECT id_transaccion, nombre_tercero, coalesce(u.g, grupo) AS grupo,
  coalesce(u.s, subgrupo) AS subgrupo, coalesce(u.st, status_gestion) AS status_gestion, clasificacion_manual
  FROM ledger LEFT JOIN upd_id u ON id_transaccion = u.id"""),
        "updates_submitted": """SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey % 50 = 0)
  + (SELECT count(*) FROM lineitem WHERE l_orderkey % 100 = 0) + (SELECT count(*) FROM lineitem WHERE l_orderkey % 150 = 0) AS updated_rows""",
        "update_by_vendor": _with((*_LEDGER, "upd_vendor_raw", "upd_vendor"), """SELECT id_transaccion, nombre_tercero,
  coalesce(u.g, grupo) AS grupo, subgrupo, coalesce(u.st, status_gestion) AS status_gestion,
  CASE WHEN u.g IS NOT NULL THEN TRUE ELSE clasificacion_manual END AS clasificacion_manual
  FROM ledger LEFT JOIN upd_vendor u ON nombre_tercero = u.nombre"""),
        "corrected_by_id": _with(_BY_ID, _CORRECTED, extra=_after("fixed")),
        "corrected_twice": _with(_BY_BOTH, _CORRECTED, extra=_after("fixed", True)),
        "rollup_summary": _with(_BY_ID, f"""SELECT empresa, strftime(fecha_corte, '%Y-%m') AS periodo, {_TOTAL} AS total FROM fixed
  WHERE year(fecha_corte) = 1998 AND {_EXPENSE} GROUP BY ALL ORDER BY 2, 1""", extra=_after("fixed")),
        "rollup_kpi_country_totals": _with(_BY_ID, """SELECT CAST(sum(v) AS DOUBLE) AS total, CAST(sum(v) FILTER (pais = 'Chile') AS DOUBLE) AS total_chile,
  CAST(sum(v) FILTER (pais = 'Colombia') AS DOUBLE) AS total_colombia, CAST(sum(v) FILTER (pais = 'Perú') AS DOUBLE) AS total_peru
  FROM (SELECT pais, CAST(valor AS DECIMAL(28,6)) AS v FROM shown)""", extra=_after("fixed")),
        "rollup_top_groups": _with(_BY_BOTH, f"""SELECT * FROM (SELECT grupo, {_TOTAL} AS valor FROM shown GROUP BY ALL
  ORDER BY valor DESC, grupo LIMIT 10) ORDER BY valor, grupo DESC""", extra=_after("fixed", True)),
        "rollup_monthly_trend": _with(_BY_ID, """SELECT strftime(m, '%Y-%m') AS mes, coalesce(CAST(t AS DOUBLE), 0) AS valor
  FROM (SELECT unnest(generate_series(DATE '1994-01-01', DATE '2002-12-01', INTERVAL 1 MONTH)) AS m)
  LEFT JOIN (SELECT strftime(fecha_corte, '%Y-%m') AS mes, sum(CAST(valor AS DECIMAL(28,6))) AS t FROM shown GROUP BY ALL) x
    ON strftime(m, '%Y-%m') = x.mes""", extra=_after("fixed")),
        "rollup_vendor_trend": _with(_BY_BOTH, f"""SELECT strftime(fecha_corte, '%Y-%m') AS mes, grupo, {_TOTAL} AS valor FROM shown
  WHERE nombre_tercero = 'Supplier#000000006' GROUP BY ALL""", extra=_after("fixed", True)),
        "vendor_update_hits": _with((*_LEDGER, "upd_vendor_raw"), """SELECT count(*) AS updated_rows FROM ledger
  JOIN upd_vendor_raw ON nombre_tercero = nombre"""),
        "read_params": _with(_PARAMS, "SELECT * FROM params WHERE fecha_corte = DATE '2024-03-31' ORDER BY categoria, concepto"),
        "params_pick": _with(_PARAMS, "SELECT * FROM params WHERE (categoria = 'PL_Close' AND pais = 'Perú') OR categoria = 'Macro'"),
        "upsert_params": _with(_PARAMS, """SELECT * EXCLUDE (seq) FROM all_params
  QUALIFY row_number() OVER (PARTITION BY fecha_corte, pais, categoria, concepto ORDER BY seq DESC) = 1"""),
        "template_fill": _with(_PARAMS, """SELECT d.fecha_corte, p.pais, c.categoria, c.concepto, c.ord, coalesce(s.valor, 0) AS valor,
  coalesce(s.descripcion, '') AS descripcion
  FROM (SELECT DISTINCT fecha_corte FROM params) d, concepts c, (VALUES ('Chile'),('Colombia'),('Perú'),('Brasil'),('Regional')) p(pais)
  LEFT JOIN (SELECT * FROM params WHERE descripcion IS NOT NULL) s
    ON s.fecha_corte = d.fecha_corte AND s.pais = p.pais AND s.categoria = c.categoria AND s.concepto = c.concepto
  WHERE (c.categoria = 'Macro') = (p.pais = 'Regional')"""),
        "vendor_modes": _with((*_LEDGER, "modes"), "SELECT * FROM modes"),
        "unify_vendor": _with((*_LEDGER, "modes", "unified"), f"""SELECT * FROM (SELECT * REPLACE (
  CASE WHEN hit THEN grupo_comun ELSE grupo END AS grupo, CASE WHEN hit THEN subgrupo_comun ELSE subgrupo END AS subgrupo) FROM unified)
  """.replace("SELECT * FROM (SELECT *", f"SELECT {_UPDATED} FROM (SELECT *")),
        "unify_stored": _with((*_LEDGER, "modes", "unified"), f"""SELECT {_UPDATED} FROM (SELECT * REPLACE (
  CASE WHEN hit THEN grupo_comun ELSE grupo END AS grupo, CASE WHEN hit THEN subgrupo_comun ELSE subgrupo END AS subgrupo) FROM unified)"""),
        "counted_vendor_modes": _with(_BY_BOTH, "SELECT * FROM modes", extra=_after("fixed", True) + ",\n" + _CTE["modes"].replace("FROM ledger", "FROM fixed")),
        "unified_count": _with((*_LEDGER, "modes", "unified"), "SELECT count(*) AS unificados FROM unified WHERE hit"),
        "apply_predictions": _with(_LEDGER, f"""SELECT id_transaccion, cuenta_contable,
  CASE WHEN {_PENDING} THEN 'G' || left(cuenta_contable, 2) ELSE grupo END AS grupo,
  CASE WHEN {_PENDING} THEN 'S' || right(cuenta_contable, 2) ELSE subgrupo END AS subgrupo, clasificacion_manual FROM ledger"""),
        "read_training_set": _with(("sheet",), """SELECT grupo, count(*) AS filas, count(subgrupo) AS con_subgrupo,
  CAST(sum(length(glosa)) AS BIGINT) AS letras FROM sheet GROUP BY ALL"""),
        "clean_training_set": _with(("sheet",), """SELECT grupo, coalesce(subgrupo, 'General') AS subgrupo, cuenta AS cuenta_contable,
  coalesce(rut, '') AS id_proveedor, coalesce(glosa, '') AS descripcion_gasto FROM sheet WHERE grupo IS NOT NULL"""),
        "feature_text": _with(_LEDGER, """SELECT id_transaccion, lower(cuenta_contable || ' ' || id_proveedor || ' ' || descripcion_gasto) AS texto
  FROM ledger"""),
        "debt_schedule": _with(("loans", "schedule"), "SELECT id AS loan_id, month, round(interest, 4) AS interest FROM schedule"),
        "debt_interest_total": _with(("scenario_loans", "schedule"), """SELECT id AS scenario_id, month, round(sum(interest), 4) AS interest
  FROM schedule GROUP BY ALL"""),
        "debt_allocation": _with(("debts",), "SELECT debt_id, vista, country, type, round(balance, 6) AS balance, rate FROM allocated"),
        "debt_union": _with(("debts",), """SELECT vista, country = 'EEUU' AS shared, type, round(sum(balance), 6) AS balance FROM allocated GROUP BY ALL"""),
        "debt_total": _with(("debts",), "SELECT vista, round(sum(balance), 6) AS total FROM allocated GROUP BY ALL"),
        "new_debt_schedule": _with(("scenarios", "newdebt"), """SELECT id AS scenario_id, month, round(balance, 4) AS balance, round(interest, 4) AS interest,
  round(principal, 4) AS principal FROM nd_month""", recursive=True),
        "npa_runoff": _with(("scenarios",), """SELECT id AS scenario_id, m AS month, round(npa * pow(1 - r_rec, m), 4) AS npa,
  round(npa * pow(1 - r_rec, m) * r_rec, 4) AS recovery FROM scenarios, (SELECT unnest(range(60))::INTEGER AS m) t WHERE m < n"""),
        "project_pnl": _with(_PNL, f"SELECT scenario_id, month, month_end, {_MEASURES} FROM pnl", recursive=True),
        "annualize": _with(_ANNUAL, f"SELECT scenario_id, year, {_MEASURES} FROM annual", recursive=True),
        "pnl_statement": _with(_ANNUAL, _STATEMENT, recursive=True),
        "pnl_display": _with(_ANNUAL, f"""SELECT scenario_id, line_no, line, {', '.join(
            f"max(value) FILTER (period = '{y}') AS " + f'"{y}"' for y in range(2025, 2032))}
  FROM ({_STATEMENT}) GROUP BY ALL""", recursive=True),
        "project_countries_annual": _with(
            ("debts", "country_loans", "schedule", "country_scenarios", "newdebt", "pnl", "annual"),
            f"SELECT scenario_id, year, {_MEASURES} FROM annual", recursive=True),
        "projection_kpis": _with(_ANNUAL, """SELECT scenario_id, round(sum(earnings), 4) AS total_earnings, round(avg(ebitda), 4) AS avg_ebitda,
  round(arg_max(fiu_performing + fiu_npa, year), 4) AS final_portfolio FROM annual GROUP BY ALL""", recursive=True),
        "margin_shift": _with(_ANNUAL, """SELECT scenario_id, round(arg_min(m, year), 4) AS first_margin, round(arg_max(m, year), 4) AS last_margin
  FROM (SELECT *, CASE WHEN revenues = 0 THEN 0 ELSE earnings / revenues * 100 END AS m FROM annual) GROUP BY ALL""", recursive=True),
    }
