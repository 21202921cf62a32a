"""Making the consolidated ledger: exclusions, union of sources, ids, late columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens import schemas as S
from ledgerlens.session import materialize

# monotonically_increasing_id keeps the partition above this many bits and the row below.
_ROW_BITS = 33


def account_exclusion(df: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Rows whose account is not excluded for their company. Catalyst broadcasts the list while it
    is small and otherwise shuffles both sides."""
    return df.join(exclusions.select("empresa", "cuenta_contable"), ["empresa", "cuenta_contable"], "left_anti")


def consolidate(sources: Iterable[DataFrame]) -> DataFrame:
    """All sources one below the other; nothing is de-duplicated."""
    return reduce(DataFrame.unionByName, [s.select(*S.CANONICAL) for s in sources])


def _first_ids(sizes: DataFrame, key: str) -> DataFrame:
    """(key, n) -> (key, _first): how many rows lie before each written part. One row per part."""
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))


def assign_ids(df: DataFrame, *order: Column | str) -> DataFrame:
    """Dense unique ``id_transaccion`` from 1 on, in the given order, else in the order of arrival.

    Rows are written once with their position inside their partition; the few partition sizes then
    give each partition its first id. No window runs over rows, and equal rows may lie in several
    partitions, as the position is the last sort key.
    """
    if order:
        df = df.withColumn("_seen", F.monotonically_increasing_id()).orderBy(*order, "_seen").drop("_seen")
    placed = materialize(df.withColumn("_pos", F.monotonically_increasing_id()), "ids")
    placed = placed.withColumn("_part", F.shiftright("_pos", _ROW_BITS))
    firsts = _first_ids(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")), "_part")
    row = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # As many rows as there are written partitions.
    return placed.join(F.broadcast(firsts), "_part").select(
        (F.col("_first") + row + 1).alias("id_transaccion"), *df.columns
    )


def assign_ids_stored(tables: Iterable[DataFrame], after: int = 0) -> DataFrame:
    """:func:`assign_ids` for tables that are parquet at rest, one below the other; ids start behind ``after``.

    A row is known by its table, the part number of its file and its place in the file, so nothing is sorted or written again
    and the ids do not depend on how folders are called, unless files share a part number or have none. The offsets are one row per file.
    """
    name = F.col("_metadata.file_name")
    number = lambda pattern: F.regexp_extract(name, pattern, 1).try_cast("bigint")
    place = F.shiftleft(F.coalesce(number(r"part-(\d+)"), F.lit(0)), 20) + F.coalesce(number(r"[.-]c(\d+)"), F.lit(0))
    placed = reduce(DataFrame.unionByName, [
        t.select("*", F.struct(F.lit(i).alias("table"), place.alias("part"), F.col("_metadata.file_path").alias("path")).alias("_file"), F.col("_metadata.row_index").alias("_row"))
        for i, t in enumerate(tables)
    ])
    firsts = _first_ids(placed.groupBy("_file").agg(F.count(F.lit(1)).alias("n")), "_file")
    numbered = placed.join(F.broadcast(firsts), "_file")
    columns = [c for c in placed.columns if c not in ("_file", "_row")]
    return numbered.select((F.col("_first") + F.col("_row") + (after + 1)).alias("id_transaccion"), *columns)


def evolve_schema(df: DataFrame) -> DataFrame:
    """Add the late columns that are missing, with their defaults."""
    missing = {
        name: F.lit(default).cast(kind)
        for name, (kind, default) in S.LATE_COLUMNS.items() if name not in df.columns
    }
    return df.withColumns(missing) if missing else df
