"""Versions, reports, registry and the load of several sources."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens import schemas as S
from ledgerlens.catalog import fixtures as X
from ledgerlens.functions import columns as E
from ledgerlens.operators import canonical as K
from ledgerlens.operators import joins as J
from ledgerlens.operators.aggregates import observed
from ledgerlens.operators.ledger import assign_ids_stored
from ledgerlens.operators.writeback import apply_predictions
from ledgerlens.plans.corrections import correct_by_id
from ledgerlens.plans.load import extract, ledger_full_refresh, rejected_lines
from ledgerlens.sources.exports import export_csv_bom
from ledgerlens.sources.readers import ledger_scan, read_source, read_table, read_training_set
from ledgerlens.sources.ranges import PERIODS, by_period, months, range_predicates
from ledgerlens.sources.registry import SOURCES, Location, exclusions_table, spec_of
from ledgerlens.sources.tables import read_beside, read_version, versions, write_version


def test_registry_covers_every_company_once():
    assert sorted(s.empresa for s in SOURCES) == sorted(C.COMPANIES)
    assert spec_of("GFO").since == date(2024, 1, 1)
    assert all(s.since == date(2025, 1, 1) for s in SOURCES if s.empresa != "GFO")
    with pytest.raises(ValueError, match="IN SA: no location for"):
        spec_of("IN SA").located({"detail": Location(path="x")})


def test_versions_are_complete_or_invisible(spark, tmp_path):
    root = str(tmp_path / "ledger")
    assert versions(spark, root) == []
    with pytest.raises(FileNotFoundError):
        read_version(spark, root)
    df = spark.createDataFrame([("GFO", date(2025, 1, 31), 1.0), ("AFI", date(2025, 1, 31), 2.0)],
                               "empresa string, fecha_corte date, valor double")
    assert write_version(df, root) == 1
    assert write_version(df.filter("valor > 1"), root) == 2
    # A version that was never finished is not read.
    (tmp_path / "ledger" / "version=000003").mkdir()
    assert versions(spark, root) == [1, 2]
    assert read_version(spark, root).count() == 1
    assert read_version(spark, root, 1).count() == 2
    plan = read_version(spark, root, 1).filter("empresa = 'GFO'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(empresa" in plan
    # The next version takes the place of the unfinished one.
    assert write_version(df, root) == 3
    assert read_version(spark, root).count() == 2


def test_report_files_start_with_the_mark(spark, tmp_path):
    rows = [(date(2025, 1, 2), "GFO", "51", "año, \"uno\"", "N", -1.5)]
    df = spark.createDataFrame(rows, "fecha_transaccion date, empresa string, cuenta_contable string, "
                                     "descripcion_gasto string, nombre_tercero string, valor double")
    export_csv_bom(df.union(df).repartition(2), str(tmp_path / "r"))
    parts = [p.read_bytes() for p in Path(tmp_path / "r").glob("part-*")]
    assert len(parts) == 2 and all(p.startswith(b"\xef\xbb\xbffecha_transaccion,empresa,") for p in parts)
    assert "año" in parts[0].decode("utf-8-sig") and "-1.5" in parts[0].decode("utf-8-sig")


def test_report_cells_are_what_a_spreadsheet_reads(spark, tmp_path):
    import csv

    odd = '  tail "q", x\nnext  '
    df = spark.createDataFrame([("GFO", odd, 1.0)], "empresa string, descripcion_gasto string, valor double").coalesce(1)
    export_csv_bom(df, str(tmp_path / "r"))
    (part,) = Path(tmp_path / "r").glob("part-*")
    with open(part, encoding="utf-8-sig", newline="") as file:
        assert list(csv.DictReader(file)) == [{"empresa": "GFO", "descripcion_gasto": odd, "valor": "1.0"}]


def test_training_sheet_and_exclusions_from_csv(spark, tmp_path):
    # Columns are found by name, in any order, behind a byte-order mark.
    (tmp_path / "t.csv").write_text(
        '\ufeffSubgrupo,Grupo,Rut Nuevo,Otra,Glosa Documento nuevo,Código Cuenta\n,A,7,x,"taxi ""uno""\nal centro ",51\n', encoding="utf-8")
    sheet = read_training_set(spark, Location("csv", str(tmp_path / "t.csv"), {"header": "true"}))
    assert tuple(sheet.first()) == ("A", None, 'taxi "uno"\nal centro ', "51", "7")
    (tmp_path / "u.csv").write_text("Grupo,Glosa\nA,taxi\n", encoding="utf-8")
    with pytest.raises(ValueError, match="columns not in the header: Subgrupo"):
        read_training_set(spark, Location("csv", str(tmp_path / "u.csv"), {"header": "true"}))
    (tmp_path / "e.csv").write_text("empresa,cuenta_contable\nGFO,0052\n")
    assert tuple(exclusions_table(spark, str(tmp_path / "e.csv")).first()) == ("GFO", "0052")


class Recorder:
    """Stands in for a session and records what a reader is asked for."""

    def __init__(self):
        self.calls = {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def load(self, *args):
        self.calls["load"] = args
        return "frame"


def test_jdbc_options_pass_through():
    session = Recorder()
    where = Location("jdbc", options={"url": "jdbc:x", "dbtable": "t", "partitionColumn": "id", "lowerBound": "0",
                                      "upperBound": "9", "numPartitions": "3"})
    assert read_table(session, where) == "frame"
    assert session.calls["format"] == "jdbc" and session.calls["load"] == ()
    assert session.calls["options"] == {**where.options, "fetchsize": "50000"}
    assert "fetchsize" not in where.options


class JdbcRecorder(Recorder):
    def jdbc(self, url, table, **given):
        self.calls["jdbc"] = (url, table, given)
        return "frame"


def test_journals_in_a_database_are_read_by_period():
    where = {r: Location("jdbc", options={"url": "jdbc:x", "dbtable": r, "user": "u"}) for r in S.JOURNAL_TABLES["D"]}
    spec = by_period(spec_of("NC SPA").located(where), date(2025, 3, 20))
    assert spec.tables["detail"].predicates == (
        "\"Com_Periodo\" < '202501' OR \"Com_Periodo\" IS NULL", "\"Com_Periodo\" >= '202501' AND \"Com_Periodo\" < '202502'",
        "\"Com_Periodo\" >= '202502' AND \"Com_Periodo\" < '202503'", "\"Com_Periodo\" >= '202503'",
    )
    assert spec.tables["voucher"].predicates == spec.tables["detail"].predicates
    assert {r for r, t in spec.tables.items() if not t.predicates} == {"client", "account", "cost_centre"}
    session = JdbcRecorder()
    assert read_source(session, spec)["detail"] == "frame"
    assert read_table(session, spec.tables["detail"]) == "frame"
    assert session.calls["jdbc"] == ("jdbc:x", "detail", {"predicates": list(spec.tables["detail"].predicates), "properties": {"user": "u", "fetchsize": "50000"}})
    assert spec.tables["detail"].options == where["detail"].options
    # What is a file, a statement or already divided stays as it is.
    for options in ({"url": "x", "query": "q"}, {"url": "x", "dbtable": "t", "partitionColumn": "id"}):
        one = spec_of("GFO").located({"journal": Location("jdbc", options=options)})
        assert by_period(one, date(2025, 1, 1)) == one
    files = spec_of("GFO").located({"journal": Location(path="x")})
    assert by_period(files, date(2025, 1, 1)) == files
    assert all(c in dict(S.JOURNAL_TABLES[layout])[role].names for layout, roles in PERIODS.items() for role, (c, _) in roles.items())


@pytest.mark.parametrize(("column", "kind", "form"), [("FEC DOC", "DATE", "%Y-%m-%d"), ('odd "name', "VARCHAR", "%Y%m")])
@pytest.mark.parametrize("step", [1, 5])
def test_every_row_is_in_one_range(column, kind, form, step):
    import duckdb

    bounds = [m.strftime(form) for m in months(date(2024, 11, 7), date(2026, 2, 1), step)]
    given = ["2024-10-31", "2024-11-01", "2024-11-30", "2025-01-01", "2025-12-31", "2026-02-01", "2030-01-01", "1900-01-01", None]
    if kind == "VARCHAR":
        given = [g and g.replace("-", "")[:6] for g in given] + ["", "zz", "2025", "20251", "202511x", " 202503"]
    told = range_predicates(column, bounds)
    con = duckdb.connect()
    con.execute(f'CREATE TABLE t ("{column.replace(chr(34), chr(34) * 2)}" {kind})')
    con.executemany("INSERT INTO t VALUES (?)", [(g,) for g in given * 2])
    hits = con.execute(f"SELECT {' + '.join(f'coalesce(CAST(({p}) AS INTEGER), 0)' for p in told)} FROM t").fetchall()
    assert len(hits) == 2 * len(given) and set(hits) == {(1,)} and len(told) == len(bounds) + 1
    assert sum(con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in told) == len(hits)


def test_ranges_need_ascending_bounds():
    assert range_predicates("c", []) == ["1 = 1"]
    assert range_predicates("c", ["a'b"]) == ["\"c\" < 'a''b' OR \"c\" IS NULL", "\"c\" >= 'a''b'"]
    with pytest.raises(ValueError, match="do not ascend"):
        range_predicates("c", ["2", "2"])
    with pytest.raises(ValueError, match="at least one month"):
        list(months(date(2025, 1, 1), date(2025, 2, 1), 0))


def located(spark, sf_dir, spec, folder):
    tables = {}
    for role, df in X.journal(spark, sf_dir, spec).items():
        path = f"{folder}/{spec.empresa}/{role}"
        df.write.parquet(path)
        tables[role] = Location(path=path)
    assert set(tables) == set(S.JOURNAL_TABLES[spec.layout])
    return spec.located(tables)


def test_load_keeps_going_without_a_broken_source(spark, sf_dir, tmp_path):
    specs = [s for s in X.specs() if s.empresa in ("CONIX", "NC LEASING PERU", "IN SA", "INCOFIN LEASING", "GFO")]
    ready = [located(spark, sf_dir, s, tmp_path) for s in specs if s.empresa != "GFO"]
    broken = [s for s in specs if s.empresa == "GFO"][0].located({"journal": Location(path=str(tmp_path / "none"))})
    # No driver knows this url; the failure comes from the reader itself.
    unknown = spec_of("LTCP").located({"journal": Location("jdbc", options={"url": "jdbc:none:x", "dbtable": "t"})})
    excluded = X.exclusions(spark, sf_dir)
    audit = ledger_full_refresh(spark, [broken, unknown, *ready], str(tmp_path / "out"), excluded)
    found = {r.empresa: r for r in audit.collect()}
    for name in ("GFO", "LTCP"):
        assert found[name].estado == "error" and found[name].filas == 0 and found[name].error
    ledger = read_version(spark, str(tmp_path / "out"))
    assert set(ledger.columns) == set(S.LEDGER.names)
    expected = {s.empresa: extract(X.journal(spark, sf_dir, s), s, excluded).count() for s in ready}
    assert {e: found[e].filas for e in expected} == expected
    assert {r.empresa: r["count"] for r in ledger.groupBy("empresa").count().collect()} == expected
    total = sum(expected.values())
    low, high, distinct = ledger.selectExpr("min(id_transaccion)", "max(id_transaccion)", "count(distinct id_transaccion)").first()
    assert (low, high, distinct) == (1, total, total)
    assert ledger.filter("status_gestion = 'Pendiente' and not clasificacion_manual").count() == total
    assert ledger_scan(ledger).count() == total


def test_failed_source_keeps_its_rows_and_labels(spark, sf_dir, tmp_path):
    specs = [located(spark, sf_dir, s, tmp_path) for s in X.specs() if s.empresa in ("CONIX", "LTCP")]
    root, excluded = str(tmp_path / "out"), X.exclusions(spark, sf_dir).limit(0)
    ledger_full_refresh(spark, specs, root, excluded)
    before = read_version(spark, root)
    write_version(before.withColumn("grupo", F.when(F.col("empresa") == "CONIX", F.lit("Luz"))), root)
    audit = ledger_full_refresh(spark, [X.unreadable(specs[0]), specs[1]], root, excluded)
    assert versions(spark, root) == [1, 2, 3]
    after = read_version(spark, root)
    counts = {r.empresa: r["count"] for r in before.groupBy("empresa").count().collect()}
    assert {(r.empresa, r["count"]) for r in after.filter("grupo = 'Luz'").groupBy("empresa").count().collect()} == {("CONIX", counts["CONIX"])}
    assert after.filter("empresa = 'LTCP' and grupo is null").count() == counts["LTCP"]
    low, high, distinct = after.selectExpr("min(id_transaccion)", "max(id_transaccion)", "count(distinct id_transaccion)").first()
    assert (low, high, distinct) == (1, sum(counts.values()), sum(counts.values()))
    found = {r.empresa: (r.filas, r.estado) for r in audit.collect()}
    assert found == {"CONIX": (counts["CONIX"], "conservado"), "LTCP": (counts["LTCP"], "ok")}
    assert {tuple(r) for r in read_beside(spark, root, "audit").collect()} == {tuple(r) for r in audit.collect()}


def test_kept_rows_keep_their_ids(spark, sf_dir, tmp_path):
    specs = [located(spark, sf_dir, s, tmp_path) for s in X.specs() if s.empresa in ("CONIX", "LTCP")]
    root, excluded = str(tmp_path / "out"), X.exclusions(spark, sf_dir).limit(0)
    ledger_full_refresh(spark, specs, root, excluded)
    lines = lambda e: {tuple(r) for r in read_version(spark, root).filter(F.col("empresa") == e).select("id_transaccion", "cuenta_contable", "descripcion_gasto", "valor").collect()}
    before = lines("LTCP")
    chosen = max(before)
    ledger_full_refresh(spark, [specs[0], X.unreadable(specs[1])], root, excluded)
    assert lines("LTCP") == before
    # Those read anew follow, and a correction by an id of before finds its row.
    assert min(r[0] for r in lines("CONIX")) == chosen[0] + 1
    ids = read_version(spark, root).select("id_transaccion")
    assert ids.count() == ids.distinct().count()
    updates = spark.createDataFrame([(1, chosen[0], "Luz", None, None)], S.UPDATES_BY_ID)
    correct_by_id(spark, root, updates)
    (fixed,) = read_version(spark, root).filter("grupo = 'Luz'").collect()
    assert (fixed.empresa, fixed.id_transaccion, fixed.descripcion_gasto) == ("LTCP", chosen[0], chosen[2])


def test_versions_are_claimed_once(spark, tmp_path):
    df = spark.createDataFrame([("A", "x")], "empresa string, fecha_corte string")
    (tmp_path / "t" / "_claims").mkdir(parents=True)
    (tmp_path / "t" / "_claims" / "000001").touch()
    assert write_version(df, str(tmp_path / "t")) == 2
    assert versions(spark, str(tmp_path / "t")) == [2]


def test_repeated_key_marks_the_source_as_failed(spark, sf_dir, tmp_path):
    spec = [s for s in X.specs() if s.empresa == "IN SA"][0]
    tables = X.journal(spark, sf_dir, spec)
    tables["client"] = tables["client"].union(tables["client"])
    with pytest.raises(ValueError, match="client: repeated values"):
        extract(tables, spec)


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from ledgerlens import session

    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")

    class Elsewhere:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere())


@pytest.mark.parametrize("empresa, header", [
    ("LTCP", "fecha_corte,FEC DOC,CUENTA,ANEXO,CONCEPTO,C COSTO,DEBE  - MN,HABER - MN"),
    ("NC LEASING PERU", "fecha_corte,fec_doc,cuenta,anexo,concepto,centro_costo,debe_mn,haber_mn"),
])
def test_text_journals_get_their_types(spark, tmp_path, empresa, header):
    (tmp_path / "j.csv").write_text(f"{header}\n2025-01-31,2025-01-05,3101,7,luz,CC1,,4.5\n2025-01-31,2024-12-31,3101,7,luz,CC1,9,\n")
    spec = spec_of(empresa).located({"journal": Location("csv", str(tmp_path / "j.csv"), {"header": "true"})})
    rows = extract(read_source(spark, spec), spec).collect()
    assert [(r.empresa, r.fecha_corte, r.cuenta_contable, r.descripcion_gasto, r.valor) for r in rows] == [
        (empresa, date(2025, 1, 31), "3101", "luz CC1", -4.5)]


def test_the_audit_counts_what_was_rejected_and_keeps_the_lines(spark, tmp_path):
    """Amounts that add nothing and dates that are none are counted by the pass that writes, and kept with their text."""
    spec = spec_of("CONIX")
    values = [("1e23", "2025-03-01"), ("inf", "2025-03-01"), ("5", "sin fecha"), ("7.5", "2025-03-02"), ("n/a", "sin fecha"), (None, "2025-03-02")]
    lines = spark.createDataFrame([("CONIX", d, "5100", "1", "x", "y", v) for v, d in values],
                                  "empresa string, fecha_transaccion string, cuenta_contable string, id_proveedor string, nombre_tercero string, descripcion_gasto string, valor string")
    seen = Observation()
    rows = K.normalize_ledger(lines, traced=True)
    table = observed(rows, seen)
    table.write.parquet(str(tmp_path / "rows"))
    assert seen.get == {"filas": 6, "total": 12.5, "fechas_rechazadas": 2, "importes_rechazados": 3}
    kept = {r.rechazo for r in spark.read.parquet(str(tmp_path / "rows")).filter("rechazo is not null").collect()}
    assert kept == {"valor=1e23", "valor=inf", "fecha_transaccion=sin fecha", "fecha_transaccion=sin fecha;valor=n/a"}
    assert spec.empresa == "CONIX" and K.normalize_ledger(lines).columns == list(S.CANONICAL)


def test_the_load_keeps_rejected_lines_beside_the_version(spark, sf_dir, tmp_path):
    specs = [located(spark, sf_dir, s, tmp_path) for s in X.specs() if s.empresa == "CONIX"]
    root = str(tmp_path / "out")
    audit = ledger_full_refresh(spark, specs, root, X.exclusions(spark, sf_dir).limit(0)).first()
    ledger = read_version(spark, root)
    assert audit.filas == ledger.count() and (audit.fechas_rechazadas, audit.importes_rechazados) == (0, 0)
    assert audit.total == ledger.agg(E.money_sum("valor")).first()[0]
    assert rejected_lines(spark, root).count() == 0 and "rechazo" in rejected_lines(spark, root).columns


def test_files_without_a_part_number_do_not_share_ids(spark, tmp_path):
    for k in range(2):
        spark.createDataFrame([(f"{k}{i}",) for i in range(3)], "v string").coalesce(1).write.parquet(str(tmp_path / f"w{k}"))
        file, = (tmp_path / f"w{k}").glob("part-*")
        (tmp_path / "odd").mkdir(exist_ok=True)
        (tmp_path / "odd" / f"{'ab'[k]}.parquet").write_bytes(file.read_bytes())
    ids = [r[0] for r in assign_ids_stored([spark.read.parquet(str(tmp_path / "odd"))]).collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6]


def test_repeated_predictions_multiply_no_row(spark):
    ledger = spark.createDataFrame([(1, None, None), (2, "A", "B")], "id_transaccion long, grupo string, subgrupo string")
    found = spark.createDataFrame([(1, "X", "Y"), (1, "X", "Z"), (1, "W", "Z")], "id_transaccion long, grupo string, subgrupo string")
    assert {tuple(r) for r in apply_predictions(ledger, found).collect()} == {(1, "X", "Z"), (2, "A", "B")}


def test_star_journals_are_written_for_the_companies_that_have_them(spark, tmp_path):
    def put(name, rows, columns):
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    put("lineitem", [(k, 1, 1, k, 1.0, 10.0, "O", "N") for k in range(39)],
        "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_linestatus string, l_returnflag string")
    put("orders", [(k, "1998-03-01", "O", "1-URGENT") for k in range(39)], "o_orderkey long, o_orderdate string, o_orderstatus string, o_orderpriority string")
    put("supplier", [(k, f"S{k}") for k in range(39)], "s_suppkey long, s_name string")
    put("part", [(1, "n", "t", "b")], "p_partkey long, p_name string, p_type string, p_brand string")
    put("nation", [(k, f"N{k}") for k in range(25)], "n_nationkey int, n_name string")
    found = X.stored_sources(spark, str(tmp_path))
    star = [s for s in found if s.layout == "D"]
    detail = spark.read.parquet(star[0].tables["detail"].path.rsplit("/", 1)[0])
    assert {r[0] for r in detail.select("empresa").distinct().collect()} == {s.empresa for s in star} and detail.count() == 3 * len(star)
    for spec in found:
        for role in spec.tables:
            if role in ("journal", "detail", "voucher", "header"):
                assert spark.read.parquet(spec.tables[role].path).count() == 3
