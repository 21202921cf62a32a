"""Properties of the corpus queries' plans."""

import re

import pytest

from ledgerlens.llm import catalog

SQL = catalog.oracle_sql()


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(SQL))
def test_no_products_and_no_python_rows(name, spark, sf_dir):
    text = plan(catalog.queries()[name](spark, sf_dir))
    for operator in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    # Ranks within a group are what op11 returns; no other query needs a window.
    assert ("Window [" in text) == (name == "op11_source_divergence")


def test_ranks_are_by_group_and_cut_before_the_shuffle(spark, sf_dir):
    text = plan(catalog.op11_source_divergence(spark, sf_dir))
    physical = text[text.index("== Physical Plan =="):]
    assert "SinglePartition" not in physical
    for window in re.findall(r"Window \[row_number\(\).*", physical):
        assert "[lang#" in window and "source#" in window
    assert "WindowGroupLimit" in physical and "Partial" in physical[physical.index("WindowGroupLimit"):]
