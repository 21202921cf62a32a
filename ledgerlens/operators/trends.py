"""Month series and vendor growth."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.functions import columns as X


def observed_months(df: DataFrame, last: int | None = None) -> list[date]:
    """Months with rows, oldest first; the list has one date per calendar month at most."""
    months = (
        df.select(F.trunc("fecha_corte", "MM").alias("m")).filter("m is not null")
        .distinct().orderBy(F.desc("m"))
    )
    if last is not None:
        months = months.limit(last)
    return sorted(r.m for r in months.collect())


def monthly_trend(view: DataFrame, start: date, end: date) -> DataFrame:
    """Total per month over the whole range, 0 for months without rows; nothing when no month has any."""
    totals = (
        view.filter(F.col("fecha_corte").between(F.trunc(F.lit(start), "MM"), F.last_day(F.lit(end))))
        .groupBy(X.month("fecha_corte").alias("mes"))
        .agg(F.sum(X.exact("valor")).alias("t"))
    )
    # One row: the totals by month, as a map with one entry per month of the range at most.
    by_month = totals.agg(F.map_from_entries(F.collect_list(F.struct("mes", "t"))).alias("totals"))
    months = F.sequence(
        F.trunc(F.lit(start), "MM"), F.trunc(F.lit(end), "MM"), F.expr("interval 1 month")
    )
    return (
        by_month.filter(F.size("totals") > 0)
        .select("totals", F.explode(months).alias("m"))
        .select(
            X.month("m").alias("mes"),
            F.coalesce(F.try_element_at("totals", X.month("m")).cast("double"), F.lit(0.0)).alias("valor"),
        )
    )


def vendor_trend(view: DataFrame, vendor: str) -> DataFrame:
    """Total per month and group of one vendor."""
    return (
        view.filter(F.col("nombre_tercero") == vendor)
        .groupBy(X.month("fecha_corte").alias("mes"), "grupo")
        .agg(X.money_sum("valor").alias("valor"))
    )


def month_vendor_matrix(view: DataFrame, months: Sequence[date] | None = None) -> DataFrame:
    """Total of every vendor in every month, 0 where the vendor has no rows.

    Totals are made per vendor and month first; a vendor then holds one entry per month.
    """
    months = observed_months(view) if months is None else months
    wanted = F.array(*[F.lit(m.strftime("%Y-%m")) for m in months]).cast("array<string>")
    return (
        view.groupBy("nombre_tercero", X.month("fecha_corte").alias("mes"))
        .agg(F.sum(X.exact("valor")).alias("t"))
        .groupBy("nombre_tercero")
        .agg(F.map_from_entries(F.collect_list(F.struct("mes", "t"))).alias("totals"))
        .select("nombre_tercero", "totals", F.explode(wanted).alias("mes"))
        .select(
            "mes",
            "nombre_tercero",
            F.coalesce(F.try_element_at("totals", F.col("mes")).cast("double"), F.lit(0.0)).alias("valor"),
        )
    )


def growth_alerts(view: DataFrame) -> DataFrame:
    """Vendors whose total rose over the last three observed months and ended above the floor."""
    months = observed_months(view, C.ALERT_MONTHS)
    if len(months) < C.ALERT_MONTHS:
        view, months = view.filter(F.lit(False)), [date(1970, 1, 1)] * C.ALERT_MONTHS
    starts = F.trunc("fecha_corte", "MM")
    amount, none = X.exact("valor"), F.lit(0).cast(X.MONEY)
    # The first date alone reaches the scan and skips files and row groups.
    recent = view.filter((F.col("fecha_corte") >= F.lit(months[0])) & starts.isin(months))
    sums = recent.groupBy("nombre_tercero").agg(*[
        F.sum(F.when(starts == F.lit(m), amount).otherwise(none)).alias(f"m{i}")
        for i, m in enumerate(months, 1)
    ])
    first, now = F.col("mes_1"), F.col("mes_actual")
    return (
        sums.filter((F.col("m3") > F.col("m2")) & (F.col("m2") > F.col("m1")) & (F.col("m3") > C.ALERT_FLOOR))
        .select(
            F.col("nombre_tercero").alias("proveedor"),
            F.lit(C.TREND_LABEL).alias("tendencia"),
            F.col("m1").cast("double").alias("mes_1"),
            F.col("m2").cast("double").alias("mes_2"),
            F.col("m3").cast("double").alias("mes_actual"),
        )
        .withColumn("var_pct", F.when(first == 0, F.lit(1.0)).otherwise((now - first) / first))
    )


def alerts_sorted(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.desc("mes_actual"), F.asc("proveedor"))
