"""Rules and null cases of load, queries and write-back on small literal tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens import schemas as S
from ledgerlens.operators import aggregates as A
from ledgerlens.operators import canonical as K
from ledgerlens.operators import filters as P
from ledgerlens.operators import joins as J
from ledgerlens.operators import ledger as L
from ledgerlens.operators import trends as T
from ledgerlens.operators import writeback as W


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def make_ledger(spark, entries):
    base = dict(
        id_transaccion=1, empresa="AFI", fecha_corte=date(2025, 1, 31), fecha_transaccion=date(2025, 1, 2),
        cuenta_contable="3101", id_proveedor="7", nombre_tercero="Uno", descripcion_gasto="x", valor=1.0,
        grupo=None, subgrupo=None, status_gestion=None, clasificacion_manual=False,
    )
    filled = [{**base, "id_transaccion": i, **e} for i, e in enumerate(entries, 1)]
    return spark.createDataFrame([tuple(e[n] for n in S.LEDGER.names) for e in filled], S.LEDGER)


def test_flag_layout_signs_and_zeroes_other_flags(spark):
    journal = spark.createDataFrame(
        [(date(2025, 1, 31), date(2025, 1, 2), "51", "1", None, None, "a", None, "b", 5.0, f) for f in ("D", "C", "X", None)],
        S.JOURNAL_B,
    )
    out = K.canonical_b(journal, "GFO")
    assert [r.valor for r in out.collect()] == [5.0, -5.0, 0.0, 0.0]
    assert out.first().descripcion_gasto == "a b"


def test_debit_credit_layout_takes_null_as_zero(spark):
    journal = spark.createDataFrame(
        [(date(2025, 1, 31), date(2025, 1, 2), "31", None, None, "cc", 4.0, None),
         (date(2025, 1, 31), date(2025, 1, 2), "31", None, "c", None, None, 3.0)], S.JOURNAL_C)
    out = K.canonical_c(journal, "LTCP").collect()
    assert [(r.valor, r.descripcion_gasto, r.nombre_tercero) for r in out] == [(4.0, "cc", None), (-3.0, "c", None)]


def test_normalize_keeps_given_closing_date_and_derives_missing_one(spark):
    raw = spark.createDataFrame(
        [("AFI", "2025-02-10", "31", None, None, "é" * 600, "12.5"), ("AFI", "nada", "31", "9", "N", None, "zzz")],
        "empresa string, fecha_transaccion string, cuenta_contable string, id_proveedor string, "
        "nombre_tercero string, descripcion_gasto string, valor string",
    )
    first, second = K.normalize_ledger(raw).collect()
    assert (first.fecha_corte, first.id_proveedor, first.nombre_tercero, len(first.descripcion_gasto), first.valor) == (
        date(2025, 2, 28), C.NO_VENDOR_ID, "", 500, 12.5)
    assert (second.fecha_corte, second.fecha_transaccion, second.valor) == (None, None, 0.0)
    given = K.normalize_ledger(raw.withColumn("fecha_corte", F.lit("2024-12-31"))).first()
    assert given.fecha_corte == date(2024, 12, 31)


def test_transactions_prefix_rule(spark):
    ledger = make_ledger(spark, [
        {"cuenta_contable": "3101"}, {"cuenta_contable": "3301"}, {"cuenta_contable": "3301", "nombre_tercero": "UBER 10%"},
    ])
    span = (date(2025, 1, 1), date(2025, 1, 31))
    ids = lambda df: [r.id_transaccion for r in df.orderBy("id_transaccion").collect()]
    assert ids(P.transactions(ledger, *span)) == [1]
    assert ids(P.transactions(ledger, *span, account="33")) == [2, 3]
    # Wildcards are plain characters, case is ignored, and the default prefixes do not apply.
    assert ids(P.transactions(ledger, *span, vendor="uber 10%")) == [3]
    assert ids(P.transactions(ledger, *span, vendor="u_er")) == []
    assert ids(P.transactions(ledger, *span, ["GFO"])) == []
    first = P.transactions_sorted(ledger, *span, limit=1).first()
    assert (first.grupo, first.subgrupo, first.status_gestion) == (C.NO_GROUP, C.NO_SUBGROUP, C.DEFAULT_STATUS)


def test_pending_needs_no_group_and_no_hand(spark):
    ledger = make_ledger(spark, [
        {}, {"grupo": ""}, {"grupo": "G"}, {"clasificacion_manual": True}, {"clasificacion_manual": None},
        {"cuenta_contable": "9"},
    ])
    assert rows(P.pending_all(ledger), "id_transaccion") == [(1,), (2,), (5,), (6,)]
    assert rows(P.pending(ledger, 2), "id_transaccion") == [(1,), (2,)]
    assert A.pending_count(ledger).first()[0] == 4


def test_facets_cascade_and_empty_lists(spark):
    view = K.display_defaults(make_ledger(spark, [
        {"empresa": "GFO", "grupo": "A"}, {"empresa": "LTCP", "grupo": "B"}, {"empresa": "AFI", "nombre_tercero": ""},
    ]))
    left = P.facet_values(view, {"pais": ["Perú"]})
    assert rows(left.filter("nivel = 'pais'"), "valor") == [("Chile",), ("Colombia",), ("Perú",)]
    assert rows(left.filter("nivel = 'empresa'"), "valor") == [("LTCP",)]
    assert P.facet_filter(view, {"grupo": []}).count() == 0
    assert P.facet_filter(view, {"nombre_tercero": []}).count() == 3
    assert P.status_filter(view, []).count() == 3


def test_display_defaults_drop_rows_without_closing_date(spark):
    view = K.display_defaults(make_ledger(spark, [{"fecha_corte": None}, {"empresa": " nc leasing peru "}]))
    assert rows(view, "pais", "grupo", "subgrupo", "status_gestion") == [
        ("Perú", C.NO_GROUP, C.NO_SUBGROUP, C.DEFAULT_STATUS)]


def test_modes_take_smallest_of_equals_and_ignore_unnamed(spark):
    ledger = make_ledger(spark, [
        {"grupo": "B", "subgrupo": "x"}, {"grupo": "A", "subgrupo": None}, {"grupo": None, "subgrupo": "z"},
        {"nombre_tercero": "", "grupo": "A"}, {"nombre_tercero": C.NO_VENDOR_ID, "grupo": "A"},
        {"nombre_tercero": None, "grupo": "A"}, {"nombre_tercero": "Dos", "grupo": "C"},
    ])
    assert rows(A.vendor_modes(ledger), "nombre_tercero", "grupo_comun", "subgrupo_comun") == [
        ("Dos", "C", None), ("Uno", "A", "x")]


def test_unify_spares_hand_set_and_unclassified_rows(spark):
    ledger = make_ledger(spark, [
        {"grupo": "A", "subgrupo": "x"}, {"grupo": "A", "subgrupo": "x"}, {"grupo": "B", "subgrupo": "x"},
        {"grupo": "B", "subgrupo": "x", "clasificacion_manual": True}, {"grupo": None, "subgrupo": None},
        {"grupo": "A", "subgrupo": None}, {"grupo": "", "subgrupo": None},
        {"nombre_tercero": "Dos", "grupo": "A", "subgrupo": None}, {"nombre_tercero": "Dos", "grupo": "A", "subgrupo": None},
        {"nombre_tercero": "Dos", "grupo": "B", "subgrupo": None},
    ])
    flagged = W.unify_vendor_flagged(ledger)
    out = {r.id_transaccion: (r.grupo, r.subgrupo) for r in flagged.collect()}
    assert out == {
        1: ("A", "x"), 2: ("A", "x"), 3: ("A", "x"), 4: ("B", "x"), 5: (None, None),
        # Null against a value is no difference by itself.
        6: ("A", None), 7: ("A", "x"), 8: ("A", None), 9: ("A", None),
        # A null mode overwrites when the group differs.
        10: ("A", None),
    }
    assert W.unified_count(flagged).first()[0] == 3
    again = W.unified_count(W.unify_vendor_flagged(W.unify_vendor(ledger))).first()[0]
    assert again == 0


def test_update_by_id_applies_in_order_per_field(spark):
    ledger = make_ledger(spark, [{"grupo": "A", "subgrupo": "s", "status_gestion": "Pendiente"}, {}])
    updates = spark.createDataFrame(
        [(1, 1, "B", "", None), (2, 1, "", "t", "Cerrado"), (3, 1, "C", None, None), (4, 99, "Z", None, None), (5, 2, "", None, None)],
        S.UPDATES_BY_ID)
    out = W.update_by_id(ledger, updates)
    assert rows(out, "grupo", "subgrupo", "status_gestion", "clasificacion_manual") == [
        ("C", "t", "Cerrado", False), (None, None, None, False)]
    assert W.updates_submitted(updates).first()[0] == 4
    assert rows(W.update_by_id(out, updates), *S.LEDGER.names) == rows(out, *S.LEDGER.names)


def test_update_by_vendor_marks_hand_set_only_with_labels(spark):
    ledger = make_ledger(spark, [{}, {}, {"nombre_tercero": "Dos"}, {"nombre_tercero": None}])
    updates = spark.createDataFrame(
        [(1, "Uno", "Cerrado", None, None), (2, "Dos", None, "G", ""), (3, "Dos", "", "", ""), (4, "Dos", "Revisado", None, None)],
        S.UPDATES_BY_VENDOR)
    out = W.update_by_vendor(ledger, updates)
    assert rows(out, "id_transaccion", "grupo", "status_gestion", "clasificacion_manual") == [
        (1, None, "Cerrado", False), (2, None, "Cerrado", False), (3, "G", "Revisado", True), (4, None, None, False)]
    assert W.vendor_update_hits(ledger, updates).first()[0] == 4


def test_upsert_takes_last_of_batch(spark):
    d = date(2025, 1, 31)
    params = spark.createDataFrame([(d, "Chile", "FIU", "FIU NPA", 1.0, "a"), (d, "Chile", "FIU", "x", 2.0, "b")], S.PARAMETERS)
    batch = spark.createDataFrame(
        [(d, "Chile", "FIU", "FIU NPA", 5.0, "n", 1), (d, "Chile", "FIU", "FIU NPA", 6.0, None, 2), (d, "Perú", "FIU", "x", 7.0, "c", 3)],
        "fecha_corte date, pais string, categoria string, concepto string, valor double, descripcion string, seq int")
    out = W.upsert_params(params, batch)
    assert rows(out, "pais", "concepto", "valor", "descripcion") == [
        ("Chile", "FIU NPA", 6.0, None), ("Chile", "x", 2.0, "b"), ("Perú", "x", 7.0, "c")]
    assert rows(W.upsert_params(out, batch), *S.PARAMETERS.names) == rows(out, *S.PARAMETERS.names)


def test_template_has_every_concept_and_regional_rates(spark):
    d = date(2025, 1, 31)
    params = spark.createDataFrame(
        [(d, "Chile", "FIU", "FIU NPA", 1.5, None), (d, "Regional", "Macro", "USD/CLP", 900.0, "bc")], S.PARAMETERS)
    out = J.template_fill(params)
    assert out.count() == 19 * 4 + 4
    filled = rows(out.filter("valor <> 0"), "pais", "concepto", "valor", "descripcion")
    assert filled == [("Chile", "FIU NPA", 1.5, ""), ("Regional", "USD/CLP", 900.0, "bc")]
    other = spark.createDataFrame([(date(2025, 2, 28),)], "fecha_corte date")
    assert J.template_fill(params, other).filter("valor <> 0").count() == 0


def test_alerts_use_observed_months(spark):
    def sums(vendor, *values):
        months = (date(2024, 11, 30), date(2025, 1, 31), date(2025, 3, 31), date(2025, 6, 30))
        return [{"nombre_tercero": vendor, "fecha_corte": m, "valor": v} for m, v in zip(months, values)]

    ledger = make_ledger(spark, sums("up", 9.0, 10.0, 20.0, 150.0) + sums("small", 1.0, 2.0, 3.0, 100.0)
                         + sums("zero", 0.0, 0.0, 5.0, 101.0) + sums("down", 1.0, 300.0, 200.0, 400.0)
                         + sums("loss", 0.0, -50.0, 10.0, 200.0))
    out = {r.proveedor: r for r in T.growth_alerts(ledger).collect()}
    assert set(out) == {"up", "zero", "loss"}
    assert (out["up"].mes_1, out["up"].mes_actual, out["up"].var_pct) == (10.0, 150.0, 14.0)
    assert (out["zero"].var_pct, out["loss"].var_pct) == (1.0, -5.0)
    assert T.growth_alerts(ledger.filter("fecha_corte > '2025-02-01'")).count() == 0


def test_month_series(spark):
    ledger = make_ledger(spark, [{"valor": 2.0}, {"valor": 3.0, "fecha_corte": date(2025, 3, 31), "nombre_tercero": "Dos"}])
    trend = T.monthly_trend(ledger, date(2024, 12, 1), date(2025, 4, 15))
    assert rows(trend, "mes", "valor") == [
        ("2024-12", 0.0), ("2025-01", 2.0), ("2025-02", 0.0), ("2025-03", 3.0), ("2025-04", 0.0)]
    assert T.monthly_trend(ledger.filter("false"), date(2024, 12, 1), date(2025, 4, 15)).count() == 0
    assert rows(T.month_vendor_matrix(ledger), "mes", "nombre_tercero", "valor") == [
        ("2025-01", "Dos", 0.0), ("2025-01", "Uno", 2.0), ("2025-03", "Dos", 3.0), ("2025-03", "Uno", 0.0)]


def test_ids_are_dense_unique_and_stable_over_partitions(spark):
    # A third of the rows are equal.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k")).repartition(7)
    out = L.assign_ids(df, "k")
    ids = [r.id_transaccion for r in out.orderBy("id_transaccion").collect()]
    assert ids == list(range(1, 3001))
    assert [r.k for r in out.orderBy("id_transaccion").collect()] == sorted(r.k for r in df.collect())
    plain = L.assign_ids(df)
    assert sorted(r.id_transaccion for r in plain.collect()) == list(range(1, 3001))
    assert sorted(r.k for r in plain.collect()) == sorted(r.k for r in df.collect())


def test_evolve_schema_keeps_existing_columns(spark):
    out = L.evolve_schema(spark.createDataFrame([("G",)], "grupo string"))
    assert out.first().asDict() == {
        "grupo": "G", "subgrupo": None, "status_gestion": C.DEFAULT_STATUS, "clasificacion_manual": False}


def test_exclusion_is_per_company(spark):
    ledger = make_ledger(spark, [{"cuenta_contable": "31"}, {"cuenta_contable": "31", "empresa": "GFO"}])
    excluded = spark.createDataFrame([("GFO", "31")], S.EXCLUSIONS)
    assert rows(L.account_exclusion(ledger, excluded), "empresa") == [("AFI",)]


def test_repeated_dimension_key_fails_with_the_key(spark):
    client = spark.createDataFrame([("1", "a"), ("1", "b"), (None, "c"), (None, "d")], S.CLIENT)
    account, centre = spark.createDataFrame([], S.ACCOUNT), spark.createDataFrame([], S.COST_CENTRE)
    detail = spark.createDataFrame([("9", "202501", "31", "1", None, "g", "D", 1.0)], S.JOURNAL_D)
    with pytest.raises(ValueError, match="client: repeated values of Cli_Rut: 1"):
        J.check_dims(client, account, centre)
    only_nulls = client.filter("Cli_Rut is null")
    assert J.enrich_dims(detail, J.check_dims(only_nulls, account, centre)).first().Cli_Nombre is None


def test_lookup_of_hot_and_null_keys(spark):
    facts = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).alias("k"))
    lookup = spark.range(0, 4000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(
        spark.createDataFrame([(7, 77)], "k long, v long"))
    found = {r["id"]: r.v for r in J.lookup_join(facts, lookup, "k").collect()}
    assert found == {
        i: None if i % 3 == 0 else 77 if i % 3 == 1 else 2 * i if i % 2 == 0 and i < 4000 else None for i in range(5000)}


def test_many_repeated_keys_are_counted(spark):
    client = spark.createDataFrame([(f"{i:02d}", "a") for i in range(30)] * 2, S.CLIENT)
    account, centre = spark.createDataFrame([], S.ACCOUNT), spark.createDataFrame([], S.COST_CENTRE)
    with pytest.raises(ValueError, match="Cli_Rut: 00, 01, .*19 and 10 more"):
        J.check_dims(client, account, centre)


def test_amounts_that_are_none_do_not_end_a_report(spark):
    from ledgerlens.functions import columns as X

    amounts = spark.createDataFrame([(x,) for x in (1.00005, 2.0, float("inf"), float("-inf"), float("nan"), 1e17, 1e300, None)], "v double")
    assert amounts.agg(X.money_sum("v")).first()[0] == pytest.approx(1e17 + 3.00005)
    small = amounts.filter("v < 1e10 and v > 0").agg(X.money_sum("v")).first()[0]
    assert small == 3.00005
    texts = spark.createDataFrame([("1.5",), ("Infinity",), ("NaN",), ("n/a",), (None,)], "t string")
    assert [r[0] for r in texts.select(X.number_or_zero("t")).collect()] == [1.5, 0.0, 0.0, 0.0, 0.0]


def test_explorer_kpis_of_nothing(spark):
    assert tuple(A.explorer_kpis(make_ledger(spark, [{}]).filter("false")).first()) == (0, 0.0, 0)
    assert tuple(A.kpi_country_totals(K.display_defaults(make_ledger(spark, [{}]))).first()) == (1.0, 1.0, 0.0, 0.0)
