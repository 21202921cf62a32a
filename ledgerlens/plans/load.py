"""The batch load: journals in, next ledger version out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import canonical as K
from ledgerlens.operators.aggregates import OBSERVED, ingest_audit, observed
from ledgerlens.operators.filters import (
    account_prefix_filter,
    period_filter,
    voucher_not_void,
    voucher_numbered,
)
from ledgerlens.operators.joins import (
    Dimensions,
    check_dims,
    enrich_dims,
    join_detail_header,
    join_header,
)
from ledgerlens.operators.ledger import (
    account_exclusion,
    assign_ids_stored,
    evolve_schema,
)
from ledgerlens.session import materialize
from ledgerlens.sources.readers import read_source
from ledgerlens.sources.registry import SourceSpec, registry_table
from ledgerlens.sources.tables import read_beside, read_version, versions, write_beside, write_version

Tables = Mapping[str, DataFrame]
#: Sources read at a time.
AT_ONCE = 4
AUDIT = "audit"
REJECTED_LINES = "rejected"


def _star_lines(tables: Tables, spec: SourceSpec, dims: Dimensions | None) -> DataFrame:
    """Star-layout lines, filtered before they are joined."""
    lines = account_prefix_filter(tables["detail"], spec.prefixes, "Cta_Codigo")
    lines = period_filter(lines, spec.since, "Com_Periodo", "year" if spec.by_year else "period")
    if spec.voucher_rule == "status":
        lines = join_header(lines, voucher_not_void(tables["voucher"]))
    else:
        lines = voucher_numbered(lines)
    return enrich_dims(lines, dims or check_dims(tables["client"], tables["account"], tables["cost_centre"]))


def extract(
    tables: Tables,
    spec: SourceSpec,
    exclusions: DataFrame | None = None,
    dims: Dimensions | None = None,
    traced: bool = False,
) -> DataFrame:
    """One journal in ledger shape: filtered, without excluded accounts, cleaned; ``traced`` names what was rejected of a line.

    Star journals that share their dimensions may be given them checked.
    """
    if spec.layout == "D":
        rows = K.canonical_d(_star_lines(tables, spec, dims), spec.empresa)
    elif spec.layout == "E":
        detail = account_prefix_filter(tables["detail"], spec.prefixes, "cod_cuenta")
        header = period_filter(tables["header"], spec.since, "fecha_comp")
        rows = K.canonical_e(join_detail_header(detail, header), spec.empresa)
    else:
        to_canonical = {"A": K.canonical_a, "B": K.canonical_b, "C": K.canonical_c}[spec.layout]
        rows = to_canonical(tables["journal"], spec.empresa)
        rows = period_filter(account_prefix_filter(rows, spec.prefixes), spec.since, "fecha_transaccion")
    if exclusions is not None:
        rows = account_exclusion(rows, exclusions)
    return K.normalize_ledger(rows, traced)


def _written(rows: DataFrame, empresa: str, label: str) -> tuple[DataFrame, tuple]:
    """The rows, written once, and what that pass counted of them."""
    seen = Observation()
    table = materialize(observed(rows, seen), label)
    told = seen.get
    return table, (empresa, *[told.get(name, 0) for name in OBSERVED])


def load_sources(
    spark: SparkSession, specs: Iterable[SourceSpec], exclusions: DataFrame
) -> tuple[list[DataFrame], list[tuple], list[tuple[str, str]]]:
    """The readable journals in the order of ``specs``, each written once, what was counted of each, and the failed ones with their errors.

    A source that fails leaves the others alone, as its rows are read before the union is made. Several are read at a time.
    """
    def load(spec: SourceSpec) -> tuple:
        try:
            return _written(extract(read_source(spark, spec), spec, exclusions, traced=True), spec.empresa, "source")
        except (PySparkException, Py4JJavaError, ValueError) as error:
            return None, (spec.empresa, str(error).splitlines()[0])

    with ThreadPoolExecutor(AT_ONCE) as pool:
        done = list(pool.map(load, specs))
    return [t for t, _ in done if t is not None], [c for t, c in done if t is not None], [c for t, c in done if t is None]


def _carried(spark: SparkSession, root: str, failed: Iterable[str]) -> list[tuple[DataFrame, tuple]]:
    """The failed companies' rows of the version in use, with their ids and what was set in them."""
    names = list(failed)
    if not names or not versions(spark, root):
        return []
    kept = read_version(spark, root)
    return [_written(kept.filter(F.col("empresa") == name), name, "carried") for name in names]


def ledger_full_refresh(
    spark: SparkSession, specs: Iterable[SourceSpec], root: str, exclusions: DataFrame
) -> DataFrame:
    """Load everything as the next ledger version and return the audit of the sources, which is stored beside it.

    The version in use stays until the new one is complete. A company whose source fails keeps the rows it has there, and
    the audit says so. Kept rows keep their ids, so a correction by id made before the load still hits them; the ids of the rows read anew follow the highest kept one, and
    may be ids that replaced rows had. The audit is counted by the passes that write the sources; lines of which something was rejected are kept beside the version
    (:func:`rejected_lines`). ``exclusions`` may be empty but must be given.
    """
    specs = list(specs)
    loaded, counted, failures = load_sources(spark, specs, exclusions)
    if not loaded:
        raise ValueError("no source could be read")
    carried = _carried(spark, root, [name for name, _ in failures])
    kept = [t for t, _ in carried]
    last = max((t.agg(F.max("id_transaccion")).first()[0] or 0 for t in kept), default=0)
    fresh = assign_ids_stored([evolve_schema(t.drop(K.REJECTED)) for t in loaded], after=last)
    number = write_version(reduce(DataFrame.unionByName, kept, fresh), root, cluster_by=["id_transaccion"])
    rejected = reduce(DataFrame.unionByName, loaded).filter(F.col(K.REJECTED).isNotNull())
    write_beside(rejected, root, number, REJECTED_LINES, files=None)
    # A row per source.
    kinds = "empresa string, filas long, total double, fechas_rechazadas long, importes_rechazados long"
    counts = spark.createDataFrame([*counted, *[c for _, c in carried if c[1]]], kinds)
    failed = spark.createDataFrame(failures, "empresa string, error string")
    write_beside(ingest_audit(registry_table(spark, specs), counts, failed), root, number, AUDIT)
    return read_beside(spark, root, AUDIT, number)


def rejected_lines(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The lines of a load of which a date or an amount was not taken over, as they were stored, with ``rechazo``."""
    return read_beside(spark, root, REJECTED_LINES, number)
