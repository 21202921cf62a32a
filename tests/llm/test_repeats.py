"""Sorted anchors spread over many Arrow batches."""

from __future__ import annotations

import pytest

from ledgerlens.llm import repeats


@pytest.mark.parametrize("size", [1, 2, 3, 4, 10])
def test_stretches_of_a_run_are_told_across_batches(size, spark):
    """A stretch of document 5 meets one of document 3, which an earlier batch held."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rows = [(1, 10, 5, 100), (1, 20, 3, 200), (1, 30, 5, 300), (1, 40, 5, 400), (2, 10, 5, 500), (3, 10, 4, 600), (3, 10, 6, 700), (4, 10, 9, 800)]
    try:
        spark.conf.set(key, size)
        told = repeats._settled(spark.createDataFrame(rows, repeats.ROWS), 1).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted(tuple(r) for r in told) == [(3, 200), (5, 100), (5, 300), (5, 400), (6, ~700)]
