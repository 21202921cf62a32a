"""Corrections: each takes a table version and gives the next one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.functions import columns as X
from ledgerlens.operators.aggregates import vendor_modes
from ledgerlens.operators.joins import lookup_join
from ledgerlens.session import materialize


def _last_given(field: str) -> Column:
    """Latest non-empty value of a field, in order of ``seq``."""
    return F.max_by(field, F.when(X.given(field), F.col("seq")))


def _any_given(fields: Sequence[str]) -> Column:
    test = X.given(fields[0])
    for field in fields[1:]:
        test = test | X.given(field)
    return test


_FIELDS = ("grupo", "subgrupo", "status_gestion")


def reduced_by_id(updates: DataFrame) -> DataFrame:
    """One row per id: the last non-empty value sent of each field."""
    return updates.groupBy("id_transaccion").agg(*[_last_given(f).alias(f"_{f}") for f in _FIELDS])


def set_by_id(ledger: DataFrame, reduced: DataFrame) -> DataFrame:
    """The ledger with the values of :func:`reduced_by_id`."""
    joined = lookup_join(ledger, reduced, "id_transaccion")
    return joined.withColumns({f: F.coalesce(f"_{f}", f) for f in _FIELDS}).select(*ledger.columns)


def update_by_id(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """Set the non-empty fields sent for each id; later updates of an id win field by field.
    The manual flag stays as it is."""
    return set_by_id(ledger, materialize(reduced_by_id(updates), "updates"))


def updates_submitted(updates: DataFrame) -> DataFrame:
    """Updates by id that carry at least one value, whether their id exists or not."""
    return updates.agg(F.count(F.when(_any_given(_FIELDS), 1)).alias("updated_rows"))


def reduced_by_vendor(updates: DataFrame) -> DataFrame:
    return updates.groupBy("nombre_tercero").agg(
        *[_last_given(f).alias(f"_{f}") for f in _FIELDS],
        F.max(_any_given(("grupo", "subgrupo"))).alias("_manual"),
        F.count(F.when(_any_given(_FIELDS), 1)).alias("_sent"),
    )


def set_by_vendor(ledger: DataFrame, reduced: DataFrame) -> DataFrame:
    """The ledger with the values of :func:`reduced_by_vendor`."""
    joined = lookup_join(ledger, reduced, "nombre_tercero")
    return joined.withColumns({
        **{f: F.coalesce(f"_{f}", f) for f in _FIELDS},
        "clasificacion_manual": F.when(F.col("_manual"), F.lit(True)).otherwise(F.col("clasificacion_manual")),
    }).select(*ledger.columns)


def update_by_vendor(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """Set the non-empty fields sent for all rows of a vendor. A group or subgroup sent by hand
    also protects the rows from the classifiers."""
    return set_by_vendor(ledger, materialize(reduced_by_vendor(updates), "updates"))


def vendor_update_hits(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """Rows hit by updates by vendor, a row counting once per update that hits it."""
    rows = ledger.groupBy("nombre_tercero").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(reduced_by_vendor(updates), "nombre_tercero").agg(
        F.coalesce(F.sum(F.col("n") * F.col("_sent")), F.lit(0)).alias("updated_rows")
    )


def upsert_params(params: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert or replace value and note by key; the last row of a key in the batch wins."""
    key = list(S.PARAMETER_KEY)
    latest = (
        batch.groupBy(*key)
        .agg(F.max_by(F.struct("valor", "descripcion"), "seq").alias("last"))
        .select(*key, "last.valor", "last.descripcion")
    )
    kept = params.join(latest.select(*key), key, "left_anti")
    return kept.select(*S.PARAMETERS.names).unionByName(latest)


def apply_predictions(ledger: DataFrame, predictions: DataFrame) -> DataFrame:
    """Ledger with predicted group and subgroup for the predicted ids. Of several predictions for an id the largest pair counts, so no row is multiplied."""
    found = predictions.groupBy("id_transaccion").agg(F.max(F.struct("grupo", "subgrupo")).alias("_found"))
    return (
        ledger.join(found, "id_transaccion", "left")
        .withColumns({c: F.coalesce(F.col("_found")[c], c) for c in ("grupo", "subgrupo")})
        .select(*ledger.columns)
    )


def unify_vendor_flagged(ledger: DataFrame, modes: DataFrame | None = None) -> DataFrame:
    """:func:`unify_vendor` with a column ``unificado`` that marks the rows it changed."""
    modes = materialize(vendor_modes(ledger), "modes") if modes is None else modes
    joined = lookup_join(ledger, modes, "nombre_tercero")
    # Plain comparisons: a row whose group and subgroup are both null is left alone.
    differs = (F.col("grupo") != F.col("grupo_comun")) | (F.col("subgrupo") != F.col("subgrupo_comun"))
    return (
        joined.withColumn("unificado", F.coalesce(differs & X.not_manual(), F.lit(False)))
        .withColumns({
            "grupo": F.when(F.col("unificado"), F.col("grupo_comun")).otherwise(F.col("grupo")),
            "subgrupo": F.when(F.col("unificado"), F.col("subgrupo_comun")).otherwise(F.col("subgrupo")),
        })
        .select(*ledger.columns, "unificado")
    )


def unify_vendor(ledger: DataFrame, modes: DataFrame | None = None) -> DataFrame:
    """Give the rows of a vendor its most frequent group and subgroup, except rows set by hand."""
    return unify_vendor_flagged(ledger, modes).drop("unificado")


def unified_count(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count(F.when(F.col("unificado"), 1)).alias("unificados"))
