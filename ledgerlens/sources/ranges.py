"""Reading a journal from a database in ranges of its posting period.

Each range is one predicate and so one connection's query. Whatever the column holds, each row meets exactly one of the predicates of a column: they part
its values at ascending bounds, and the rows without a value go with the first range. Start dates and account prefixes need no part in
them, as Spark sends such filters along with every range.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import replace
from datetime import date

from ledgerlens import schemas as S
from ledgerlens.sources.registry import SourceSpec

#: Quote of column names, as both database systems of the journals accept it.
QUOTE = '"'

#: Columns that tell when a line was posted, by layout and role (fixed values), and how they write a month. Tables without one are read as they are.
PERIODS = {
    "A": {"journal": ("d_fecha_documento", "%Y-%m-%d")},
    "B": {"journal": ("fecha_docto", "%Y-%m-%d")},
    "C": {"journal": ("FEC DOC", "%Y-%m-%d")},
    "D": {"detail": ("Com_Periodo", "%Y%m"), "voucher": ("Com_Periodo", "%Y%m")},
    "E": {"header": ("fecha_comp", "%Y-%m-%d")},
}
PLAIN_PERIOD = {"journal": ("fec_doc", "%Y-%m-%d")}


def months(since: date, until: date, step: int = 1) -> Iterator[date]:
    """The first day of every ``step``-th month from that of ``since`` to that of ``until``."""
    if step < 1:
        raise ValueError("step must be at least one month")
    for m in range(since.year * 12 + since.month - 1, until.year * 12 + until.month, step):
        yield date(m // 12, m % 12 + 1, 1)


def range_predicates(column: str, bounds: Sequence[str], quote: str = QUOTE) -> list[str]:
    """Conditions that part the rows of a table: below the first bound or without a value, from each bound to the next, from the last on.

    Bounds must ascend in the order of the column; without any, all rows are one range.
    """
    if any(a >= b for a, b in zip(bounds, bounds[1:])):
        raise ValueError(f"bounds of {column} do not ascend")
    if not bounds:
        return ["1 = 1"]
    name = quote + column.replace(quote, quote * 2) + quote
    told = ["'" + b.replace("'", "''") + "'" for b in bounds]
    between = [f"{name} >= {low} AND {name} < {high}" for low, high in zip(told, told[1:])]
    return [f"{name} < {told[0]} OR {name} IS NULL", *between, f"{name} >= {told[-1]}"]


def period_column(spec: SourceSpec, role: str) -> tuple[str, str] | None:
    """The column of a table that holds the posting period, and its format."""
    return (PLAIN_PERIOD if spec.empresa == S.PLAIN_JOURNAL_C else PERIODS[spec.layout]).get(role)


def by_period(spec: SourceSpec, until: date, step: int = 1, quote: str = QUOTE, roles: Iterable[str] | None = None) -> SourceSpec:
    """The source with its database tables read in ranges of ``step`` months, from its start to ``until``; what lies beyond either end is one range each.

    Files, tables without a period column, statements of the caller's (``query``) and tables that are already divided are left as they are.
    """
    tables = dict(spec.tables)
    for role, where in spec.tables.items():
        known = period_column(spec, role)
        divided = where.predicates or {"query", "partitionColumn"} & set(where.options)
        if where.format != "jdbc" or known is None or divided or (roles is not None and role not in roles):
            continue
        column, written = known
        bounds = [m.strftime(written) for m in months(spec.since, until, step)]
        tables[role] = replace(where, predicates=tuple(range_predicates(column, bounds, quote)))
    return replace(spec, tables=tables)
