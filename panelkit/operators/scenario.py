"""What-if scenarios as set operations: a table of scenarios applied to a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelkit.config import ENTITY, PERIOD
from panelkit.functions import expressions as x
from panelkit.operators.relational import keep_one

REDUCTION, INCREASE = "emission_reduction_pct", "renewables_increase_pct"
CARRIED = ["risk_score", "co2_per_capita", "renewables_share", "coal_share", "sustainability_score"]


def scenarios_for_all(risk: DataFrame, scenarios: Sequence[tuple[float, float]], entity=ENTITY) -> DataFrame:
    """One request per entity and scenario of a short fixed list."""
    options = F.array(*[
        F.struct(F.lit(float(r)).alias(REDUCTION), F.lit(float(p)).alias(INCREASE)) for r, p in scenarios
    ])
    return risk.select(entity).distinct().select(entity, F.explode(options).alias("s")).select(entity, "s.*")


def simulate(risk: DataFrame, requests: DataFrame, entity=ENTITY, period=PERIOD) -> DataFrame:
    """Latest values of each requested entity next to the simulated ones.

    Every reduction percent lowers the score by 0.3 and every added renewable point by 0.5;
    renewables displace coal half a point each. A missing input stays missing.
    """
    latest = keep_one(risk, [entity], [F.desc(period)]).select(entity, "country", F.col(period).alias("latest_year"), *CARRIED)
    j = requests.select(entity, F.col(REDUCTION).cast("double"), F.col(INCREASE).cast("double")).join(latest, entity)
    c, cut, add = F.col, F.col(REDUCTION), F.col(INCREASE)
    delta = -cut * 0.3 - add * 0.5
    renewables = x.clip(c("renewables_share") + add, hi=100)
    coal = x.clip(c("coal_share") - add * 0.5, lo=0)
    return j.select(
        entity, "country", "latest_year", REDUCTION, INCREASE, *CARRIED,
        F.round(x.clip(c("risk_score") + delta, 0, 100), 1).alias("sim_risk_score"),
        F.round(c("co2_per_capita") * (1 - cut / 100), 2).alias("sim_co2_per_capita"),
        F.round(renewables, 1).alias("sim_renewables_share"),
        F.round(coal, 1).alias("sim_coal_share"),
        F.round(renewables - coal, 1).alias("sim_sustainability_score"),
        F.round(delta, 1).alias("risk_delta"),
    )


def simulate_forecast(forecasts: DataFrame, simulated: DataFrame, entity=ENTITY, period=PERIOD) -> DataFrame:
    """Forecast path under each scenario: the reduction is phased in over five periods."""
    j = forecasts.select(entity, period, "forecast_co2").join(
        simulated.select(entity, "latest_year", REDUCTION, INCREASE), entity)
    phase = x.clip((F.col(period) - F.col("latest_year")) / 5, 0, 1)
    path = F.col("forecast_co2") * (1 - F.col(REDUCTION) * phase / 100)
    return j.select(
        entity, REDUCTION, INCREASE, period,
        F.round("forecast_co2", 2).alias("forecast_co2_original"),
        F.round(x.clip(path, lo=0), 2).alias("forecast_co2_simulated"),
    )


def rejected(requests: DataFrame, risk: DataFrame, entity=ENTITY) -> DataFrame:
    """Requests for entities that are not in the panel, with the reason."""
    return requests.join(risk.select(entity).distinct(), entity, "left_anti").withColumn(
        "error", F.concat(F.lit("Country "), F.col(entity), F.lit(" not found")))
