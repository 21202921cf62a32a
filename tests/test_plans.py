"""Properties of the physical plans."""

from datetime import date

import pytest

import __spark_entry__ as driver
from ledgerlens.catalog import oracle
from ledgerlens.operators import aggregates as A
from ledgerlens.operators import filters as P
from ledgerlens.operators import trends as T
from ledgerlens.sources.tables import read_version, write_version
from ledgerlens.catalog import fixtures as X

#: The corpus operators' plans are tested beside them.
SQL = oracle.oracle_sql()


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    write_version(X.ledger(spark, sf_dir), root)
    return read_version(spark, root)


@pytest.mark.parametrize("name", sorted(SQL))
def test_no_python_no_products_no_global_windows(name, spark, sf_dir):
    text = plan(driver.queries()[name](spark, sf_dir))
    for operator in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                     "BroadcastNestedLoopJoin"):
        assert operator not in text
    # The only window runs over the sizes of the written partitions.
    assert ("Window [" in text) == (name == "assign_ids")


def test_summary_reads_three_columns_of_one_year(stored):
    text = plan(A.summary(stored, 1998))
    assert "ReadSchema: struct<fecha_corte:date,cuenta_contable:string,valor:double>" in text
    assert "GreaterThanOrEqual(fecha_corte,1998-01-01)" in text
    assert "StringStartsWith(cuenta_contable,31)" in text
    physical = text[text.index("== Physical Plan =="):]
    assert "partial_sum" in physical
    # One shuffle for the groups, one for the order of the report.
    assert physical.count("Exchange hashpartitioning") == 1


def test_transactions_prune_companies_and_dates(stored):
    text = plan(P.transactions(stored, date(1998, 1, 1), date(1998, 3, 31), ["GFO"]))
    assert "PartitionFilters: [isnotnull(empresa" in text or "PartitionFilters: [(empresa" in text
    assert "LessThanOrEqual(fecha_corte,1998-03-31)" in text
    assert "Exchange" not in text


def test_top_k_does_not_sort_everything(stored):
    text = plan(P.transactions_sorted(stored, date(1998, 1, 1), date(1998, 12, 31), limit=5))
    assert "TakeOrderedAndProject" in text and "Exchange rangepartitioning" not in text


def test_vendor_counts_combine_before_the_shuffle(stored):
    physical = plan(A.vendor_modes(stored)).split("== Physical Plan ==")[1]
    first_exchange = physical.rindex("Exchange hashpartitioning")
    assert "partial_count" in physical[first_exchange:]


def test_alerts_skip_old_files(stored):
    assert "GreaterThanOrEqual(fecha_corte," in plan(T.growth_alerts(stored))
