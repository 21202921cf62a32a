"""Corrections rewrite only what they hit, and the rollup follows them."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.operators import aggregates as A
from ledgerlens.operators import classifier as M
from ledgerlens.operators import rollup as R
from ledgerlens.operators import trends as T
from ledgerlens.operators import vendor_counts as V
from ledgerlens.operators import writeback as W
from ledgerlens.operators.canonical import display_defaults
from ledgerlens.plans import corrections
from ledgerlens.sources.tables import StaleVersion, amend_version, partition_folders, parts_of_partition, read_version, versions, write_version

DAY = date(2025, 3, 31)


def _rows():
    """Six companies, one of them without a name; odd amounts and dates."""
    names = ["AFI", "NC SA", "A/B=1", "GFO", "007 é", None]
    rows = []
    for i in range(60):
        amount = {7: None, 8: float("inf"), 9: 1e23, 10: float("nan")}.get(i, round(1.1 * i - 20, 2))
        day = None if i % 13 == 0 else date(2025, 1 + i % 12, 15)
        rows.append((i, names[i % 6], day, DAY, ("31", "5", "1", None)[i % 4] and f"{('31', '5', '1', None)[i % 4]}00{i}", "id", ["ACME", "", None, "Uber"][i % 4], "x", amount,
                     ["G1", None, "G2", ""][i % 4], None, None, None))
    return rows


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "ledger")
    write_version(spark.createDataFrame(_rows(), S.LEDGER), path)
    corrections.read_rollup(spark, path)
    return path


def _by_id(spark, *rows):
    return spark.createDataFrame(list(rows), S.UPDATES_BY_ID)


def _told(df):
    """Rows of a ledger, with NaN as text."""
    return sorted(map(str, (tuple(r) for r in df.select(*S.LEDGER.names).collect())))


def _files(tmp_path, folder):
    return {p.name: p.stat().st_mtime_ns for p in (tmp_path / "ledger" / folder).rglob("*.parquet")}


def test_only_the_companies_hit_are_rewritten(spark, root, tmp_path):
    before, files = _told(read_version(spark, root, 1)), _files(tmp_path, "version=000001")
    done = corrections.correct_by_id(spark, root, _by_id(spark, (1, 1, "N1", None, None), (2, 7, "N2", None, "Cerrado"), (3, 999, "N3", None, None)))
    assert done.version == 2 and done.companies == ("NC SA",)
    folders = partition_folders(spark, root, 2)
    assert [n for n, f in folders.items() if f == "changed=000002"] == ["empresa=NC SA"]
    assert sum(f == "version=000001" for f in folders.values()) == 5
    assert [p.name for p in (tmp_path / "ledger" / "changed=000002").iterdir() if p.is_dir()] == ["empresa=NC SA"]
    assert _files(tmp_path, "version=000001") == files and _told(read_version(spark, root, 1)) == before
    want = W.update_by_id(read_version(spark, root, 1), _by_id(spark, (1, 1, "N1", None, None), (2, 7, "N2", None, "Cerrado")))
    assert _told(read_version(spark, root)) == _told(want)


def test_corrections_chain_and_hit_companies_without_a_name(spark, root):
    first = corrections.correct_by_id(spark, root, _by_id(spark, (1, 5, "N", None, None), (2, 2, "N", None, None)))
    assert set(first.companies) == {None, "A/B=1"}
    vendor = spark.createDataFrame([(1, "Uber", "Cerrado", "TAXI", None)], S.UPDATES_BY_VENDOR)
    second = corrections.correct_by_vendor(spark, root, vendor)
    assert second.version == 3 and versions(spark, root) == [1, 2, 3]
    start = read_version(spark, root, 1)
    want = W.update_by_vendor(W.update_by_id(start, _by_id(spark, (1, 5, "N", None, None), (2, 2, "N", None, None))), vendor)
    assert _told(read_version(spark, root)) == _told(want)
    again = write_version(read_version(spark, root), root)
    assert again == 4 and set(partition_folders(spark, root, 4).values()) == {"version=000004"}
    assert _told(read_version(spark, root)) == _told(want)


def test_nothing_hit_makes_no_version(spark, root):
    assert corrections.correct_by_id(spark, root, _by_id(spark, (1, 999, "N", None, None))) == corrections.Corrected(1, ())
    assert corrections.correct_by_id(spark, root, _by_id(spark)).version == 1 and versions(spark, root) == [1]


def test_an_amended_version_must_be_the_latest(spark, root):
    rows = read_version(spark, root, 1).filter("empresa = 'GFO'")
    amend_version(rows, root, 1)
    with pytest.raises(StaleVersion):
        amend_version(rows, root, 1)
    assert versions(spark, root) == [1, 2]


def test_companies_not_hit_are_not_read(spark, root):
    corrections.correct_by_id(spark, root, _by_id(spark, (1, 1, "N1", None, None)))
    plan = read_version(spark, root).filter("empresa = 'GFO'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(empresa") == 2


def _sums(df):
    return {tuple(r) for r in df.select(*R.KEY, "total", "filas", "con_importe").collect()}


def test_rollup_after_corrections_equals_a_new_one(spark, root):
    corrections.correct_by_id(spark, root, _by_id(spark, *[(i, i, f"N{i % 3}", None, None) for i in range(0, 60, 7)]))
    vendor = spark.createDataFrame([(1, "ACME", None, "MANO", None), (2, "Uber", "Cerrado", None, None)], S.UPDATES_BY_VENDOR)
    corrections.correct_by_vendor(spark, root, vendor)
    assert versions(spark, f"{root}/rollup") == [1, 2, 3]
    ledger, known = read_version(spark, root), corrections.read_rollup(spark, root)
    assert _sums(known) == _sums(R.rollup(ledger))
    assert known.agg(F.sum("filas")).first()[0] == 60


def test_answers_from_the_rollup_equal_the_scan(spark, root):
    corrections.correct_by_id(spark, root, _by_id(spark, *[(i, i, "N", None, None) for i in range(0, 60, 5)]))
    for number in (1, 2):
        ledger, known = read_version(spark, root, number), corrections.read_rollup(spark, root, number)
        view, short = display_defaults(ledger), R.as_view(known)
        pairs = [
            (A.summary(ledger, 2025), A.summary(R.as_ledger(known), 2025)),
            (A.kpi_country_totals(view), A.kpi_country_totals(short)),
            (A.top_groups(view), A.top_groups(short)),
            (T.monthly_trend(view, date(2024, 12, 1), date(2025, 12, 1)), T.monthly_trend(short, date(2024, 12, 1), date(2025, 12, 1))),
            (T.vendor_trend(view, "ACME"), T.vendor_trend(short, "ACME")),
        ]
        for scan, answer in pairs:
            assert scan.collect() == answer.collect() or sorted(scan.collect()) == sorted(answer.collect())


def test_answers_read_no_line(spark, root):
    plan = A.summary(R.as_ledger(corrections.read_rollup(spark, root)), 2025)._jdf.queryExecution().executedPlan().toString()
    assert "ledger/rollup/version=000001" in plan and "id_transaccion" not in plan


def test_a_version_without_a_rollup_gets_one(spark, tmp_path):
    path = str(tmp_path / "ledger")
    write_version(spark.createDataFrame(_rows(), S.LEDGER), path)
    corrections.correct_by_id(spark, path, _by_id(spark, (1, 1, "N1", None, None)))
    assert versions(spark, f"{path}/rollup") == []
    assert _sums(corrections.read_rollup(spark, path)) == _sums(R.rollup(read_version(spark, path)))
    assert versions(spark, f"{path}/rollup") == [2]


def _counted(df):
    return {tuple(r) for r in df.select(*V.KEY, "filas").collect()}


def _modes(df):
    return sorted(map(tuple, df.select("nombre_tercero", "grupo_comun", "subgrupo_comun").collect()), key=str)


def test_vendor_counts_follow_corrections(spark, root):
    corrections.read_vendor_counts(spark, root)
    corrections.correct_by_id(spark, root, _by_id(spark, *[(i, i, f"N{i % 3}", f"S{i % 2}", None) for i in range(0, 60, 7)]))
    corrections.correct_by_vendor(spark, root, spark.createDataFrame([(1, "ACME", None, "MANO", None)], S.UPDATES_BY_VENDOR))
    assert versions(spark, f"{root}/vendor_counts") == [1, 2, 3]
    ledger, known = read_version(spark, root), corrections.read_vendor_counts(spark, root)
    assert _counted(known) == _counted(V.counts(ledger)) and _modes(V.modes(known)) == _modes(A.vendor_modes(ledger))
    plan = V.modes(known)._jdf.queryExecution().executedPlan().toString()
    assert "id_transaccion" not in plan and "ledger/version=" not in plan


@pytest.fixture
def mixed(spark, tmp_path):
    """Vendors of one class in AFI, and of several, set by hand or not, in GFO and a company without a name."""
    def row(i, company, vendor, group, sub, manual):
        return (i, company, DAY, DAY, "511", "1", vendor, "x", 1.0 * i, group, sub, None, manual)

    path = str(tmp_path / "mixed")
    write_version(spark.createDataFrame([
        row(1, "AFI", "Uno", "A", "a", False), row(2, "AFI", "Uno", "A", "a", True), row(3, "GFO", "Uno", "B", "a", None), row(4, "GFO", "Uno", "B", "b", True),
        row(5, "GFO", "Dos", "C", None, False), row(6, None, "Dos", None, "z", False), row(7, None, "Dos", "C", "c", False), row(8, "NC SA", None, "A", "a", False),
        row(9, "NC SA", "", "A", "a", False), row(10, "NC SA", "", "B", "a", False), row(11, "LTC", "Tres", "", "", False), row(12, "AFI", "Tres", None, None, None),
    ], S.LEDGER), path)
    corrections.read_rollup(spark, path)
    return path


def test_unifying_rewrites_only_companies_with_a_row_to_change(spark, mixed, tmp_path):
    want = _told(W.unify_vendor(read_version(spark, mixed, 1)))
    done = corrections.unify_stored(spark, mixed)
    assert done.version == 2 and set(done.companies) == {"GFO", None}
    assert _told(read_version(spark, mixed)) == want
    folders = partition_folders(spark, mixed, 2)
    assert {n for n, f in folders.items() if f != "version=000001"} == {"empresa=GFO", "empresa=__HIVE_DEFAULT_PARTITION__"}
    ledger = read_version(spark, mixed)
    assert _counted(corrections.read_vendor_counts(spark, mixed)) == _counted(V.counts(ledger))
    assert _sums(corrections.read_rollup(spark, mixed)) == _sums(R.rollup(ledger))
    again = corrections.unify_stored(spark, mixed)
    assert again.version == 2 or _told(read_version(spark, mixed)) == _told(W.unify_vendor(ledger))


def test_classified_ledger_equals_the_job_over_all_lines(spark, mixed, monkeypatch):
    guess = lambda rows, model: rows.withColumns({"grupo_predicho": F.lit("P"), "subgrupo_predicho": F.concat(F.lit("p"), F.col("id_transaccion") % 2), "confianza": F.lit(1.0)})
    monkeypatch.setattr(M, "predict", guess)
    want = _told(M.classify_pending(read_version(spark, mixed, 1), None))
    done = corrections.classify_stored(spark, mixed, None)
    ledger = read_version(spark, mixed)
    assert done.version == 2 and _told(ledger) == want and "NC SA" not in done.companies
    assert _counted(corrections.read_vendor_counts(spark, mixed)) == _counted(V.counts(ledger))
    assert _sums(corrections.read_rollup(spark, mixed)) == _sums(R.rollup(ledger))


def test_corrected_sums_are_neither_read_nor_rewritten(spark, root, tmp_path, monkeypatch):
    corrections.read_vendor_counts(spark, root)
    corrections.correct_by_id(spark, root, _by_id(spark, (1, 1, "N1", None, None), (2, 7, None, None, "Cerrado"), (3, 9, "", "S", None)))
    for name, rows in (("rollup", 2), ("vendor_counts", 4)):
        # A line with a new group leaves one combination and comes to another; a new status brings nothing, a new subgroup only to the counts.
        written = spark.read.parquet(str(tmp_path / "ledger" / name / "changed=000002"))
        assert written.count() == rows and written.agg(F.sum("filas")).first()[0] == 0
        assert parts_of_partition(spark, f"{root}/{name}", 2) == 2
    monkeypatch.setattr(corrections, "MERGE_AFTER", 2)
    corrections.correct_by_id(spark, root, _by_id(spark, (1, 1, "G2", None, None)))
    assert parts_of_partition(spark, f"{root}/rollup", 3) == 1
    ledger = read_version(spark, root)
    assert _sums(corrections.read_rollup(spark, root)) == _sums(R.rollup(ledger))
    assert _counted(corrections.read_vendor_counts(spark, root)) == _counted(V.counts(ledger))
