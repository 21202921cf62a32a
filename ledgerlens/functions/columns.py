"""Scalar and aggregate column expressions; all of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens import config as C

# Amounts are doubles at rest and are added up as exact decimals, so that totals do not depend
# on the order in which partitions arrive. What is no amount of at most 22 digits before the point adds
# nothing rather than ending the report.
MONEY = "decimal(28,6)"

_Col = Column | str


def _c(col: _Col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def exact(col: _Col) -> Column:
    return _c(col).try_cast(MONEY)


def money_sum(col: _Col) -> Column:
    """Exact total, null over no rows."""
    return F.sum(exact(col)).cast("double")


def text(col: _Col) -> Column:
    """Text with null as ''."""
    return F.coalesce(_c(col).cast("string"), F.lit(""))


def joined_skipping_nulls(*cols: _Col) -> Column:
    return F.concat_ws(" ", *[_c(c) for c in cols])


def joined_keeping_blanks(*cols: _Col) -> Column:
    """Blank-separated text that keeps the separators of missing parts."""
    return F.array_join(F.array(*[text(c) for c in cols]), " ")


def number_or_zero(col: _Col) -> Column:
    """Number of a text or number; 0 for what is none, or not finite."""
    parsed = _c(col).try_cast("double")
    return F.when(F.abs(parsed) < F.lit(float("inf")), parsed).otherwise(F.lit(0.0))


def day(col: _Col) -> Column:
    """Date of a date, timestamp or ISO text; null when it is none."""
    return _c(col).try_cast("date")


def period_start(col: _Col) -> Column:
    """First day of a ``yyyymm`` period."""
    return F.try_to_date(_c(col), "yyyyMM")


def month(col: _Col) -> Column:
    return F.date_format(_c(col), "yyyy-MM")


def starts_with_any(col: _Col, prefixes: Sequence[str]) -> Column:
    return reduce(or_, [_c(col).startswith(p) for p in prefixes])


def contains_ignoring_case(col: _Col, needle: str) -> Column:
    return F.contains(F.lower(_c(col)), F.lower(F.lit(needle)))


def signed(flag: _Col, amount: _Col, plus: str, minus: str) -> Column:
    """+amount or -amount by flag, 0 for any other flag."""
    return (
        F.when(_c(flag) == plus, _c(amount))
        .when(_c(flag) == minus, -_c(amount))
        .otherwise(F.lit(0.0))
    )


def given(col: _Col) -> Column:
    """True when a value was sent: neither null nor ''."""
    return F.coalesce(_c(col) != "", F.lit(False))


def not_manual() -> Column:
    return ~F.coalesce(F.col("clasificacion_manual"), F.lit(False))


def country_of(company: _Col) -> Column:
    name = F.upper(F.trim(text(company)))
    has = lambda marks: reduce(or_, [name.contains(m) for m in marks])
    return (
        F.when(has(C.COLOMBIA_MARKS), F.lit("Colombia"))
        .when(has(C.PERU_MARKS), F.lit("Perú"))
        .otherwise(F.lit("Chile"))
    )


def amount_label(col: _Col) -> Column:
    """Amount without decimals and with thousands separators, like $1,234."""
    return F.concat(F.lit("$"), F.format_number(_c(col), 0))


def percent_of(part: _Col, whole: _Col) -> Column:
    """Share in percent, 0 when the whole is 0."""
    return F.when(_c(whole) == 0, F.lit(0.0)).otherwise(_c(part) / _c(whole) * 100)
