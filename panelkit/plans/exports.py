"""Flat table for BI tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelkit.config import ENTITY, PERIOD
from panelkit.operators.relational import enrich, latest_value

COLUMNS = ["country", "year", "co2_per_capita", "temperature_anomaly", "renewables_share", "risk_score", "forecast_co2"]


def bi_table(fact: DataFrame, risk: DataFrame, forecasts: DataFrame) -> DataFrame:
    """History with risk scores, then forecast rows of later periods only, by country and year.

    The score comes from the risk table alone, whether or not the fact already has one.
    """
    past = enrich(fact, risk, [ENTITY, PERIOD], ["risk_score"])
    future = forecasts.filter(F.col("forecast_co2").isNotNull() & (F.col(PERIOD) > latest_value(fact)))
    temperature = F.col("forecast_temp_anomaly") if "forecast_temp_anomaly" in forecasts.columns else F.lit(None).cast("double")
    rows = past.select("country", PERIOD, "co2_per_capita", "temperature_anomaly", "renewables_share", "risk_score").unionByName(
        future.select("country", PERIOD, temperature.alias("temperature_anomaly"), "forecast_co2"), allowMissingColumns=True)
    return rows.select(*COLUMNS).orderBy(F.asc_nulls_last("country"), PERIOD)
