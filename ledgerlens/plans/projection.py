"""Projections of the country views from their portfolio and their share of the debt."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens import schemas as S
from ledgerlens.operators.finance import project_pnl
from ledgerlens.operators.joins import debt_allocation
from ledgerlens.sources.literals import portfolio


def with_defaults(scenarios: DataFrame) -> DataFrame:
    """Scenarios with the usual drivers for those not given as columns."""
    missing = {k: F.lit(v) for k, v in C.SCENARIO_DEFAULTS.items() if k not in scenarios.columns}
    return scenarios.withColumns(missing).select(*S.SCENARIO.names)


def country_scenarios(spark: SparkSession, start: date) -> DataFrame:
    """One scenario per country view, with its opening portfolio and the usual drivers."""
    return with_defaults(portfolio(spark).select(
        F.col("country").alias("scenario_id"), F.lit(start).alias("start_date"),
        F.col("perf").alias("perf_start"), F.col("npa").alias("npa_start"),
    ))


def project_countries(debts: DataFrame, start: date) -> DataFrame:
    """Monthly profit and loss of every country view, given the debt book."""
    loans = debt_allocation(debts).select(
        F.col("vista").alias("scenario_id"), F.col("balance").alias("amount"), "rate", "term_years"
    )
    return project_pnl(country_scenarios(debts.sparkSession, start), loans)
