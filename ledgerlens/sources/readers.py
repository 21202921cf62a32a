"""Scans. Filters and column lists written on the result reach the scan through Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas as S
from ledgerlens.operators.filters import pending_all
from ledgerlens.sources.exports import BYTE_ORDER_MARK
from ledgerlens.sources.registry import Location, SourceSpec

# Rows a JDBC driver fetches per round trip.
FETCH_SIZE = "50000"
_UNTYPED = ("csv", "json")
_CSV = {"header": "true", "multiLine": "true", "escape": '"'}


def read_table(spark: SparkSession, location: Location, schema: T.StructType | None = None) -> DataFrame:
    """One table, from files or by JDBC.

    For JDBC give predicates (``ranges.by_period``), or ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``, with
    ``dbtable`` to read in parallel, or ``query`` to let the remote side run a statement.
    """
    reader = spark.read.format(location.format)
    options = dict(location.options)
    if location.format == "jdbc":
        options.setdefault("fetchsize", FETCH_SIZE)
        if location.predicates:
            url, table = options.pop("url"), options.pop("dbtable")
            return spark.read.jdbc(url, table, predicates=list(location.predicates), properties=options)
        return reader.options(**options).load()
    if schema is not None and location.format == "csv":
        return _by_header(reader.options(**{**_CSV, **options}).load(location.path), schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(location.path)


def _by_header(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a text table by the names in its header, in any order; text that is no value of a column's type is null."""
    known = {c.removeprefix(BYTE_ORDER_MARK): c for c in raw.columns}
    if missing := [f.name for f in schema if f.name not in known]:
        raise ValueError(f"columns not in the header: {', '.join(missing)}")
    return raw.select(*[F.col(f"`{known[f.name]}`").try_cast(f.dataType).alias(f.name) for f in schema])


def read_source(spark: SparkSession, spec: SourceSpec) -> dict[str, DataFrame]:
    """The tables of one journal by role. Text files get their fixed schema; other formats bring
    their own types."""
    schemas = dict(S.JOURNAL_TABLES[spec.layout])
    if spec.empresa == S.PLAIN_JOURNAL_C:
        schemas["journal"] = S.JOURNAL_C_PLAIN
    return {
        role: read_table(spark, location, schemas[role] if location.format in _UNTYPED else None)
        for role, location in spec.tables.items()
    }


def read_training_set(spark: SparkSession, location: Location) -> DataFrame:
    """Labelled sheet, as CSV or parquet."""
    return read_table(spark, location, S.TRAINING)


def ledger_scan(ledger: DataFrame) -> DataFrame:
    """What the classifiers need of the rows still to be classified."""
    return pending_all(ledger).select(
        "id_transaccion", "cuenta_contable", "id_proveedor", "descripcion_gasto"
    )
