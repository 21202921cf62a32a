"""Column expressions shared by the corpus operators: words, lines, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, and words as the runs between it.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"


def given(text: Column) -> Column:
    """A missing text counts as empty."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """All words of a text, in order."""
    return F.array_remove(F.split(given(text), GAP, -1), "")


def only(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns of the input cannot clash with an operator's own."""
    return docs.select(*[docs[n] for n in names])
