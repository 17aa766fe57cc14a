"""Read queries over the stage tables; each returns DataFrames ready to show or export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit import config
from panelkit.config import ENTITY, PERIOD
from panelkit.functions import expressions as x
from panelkit.operators import scenario
from panelkit.operators.relational import enrich, last_periods, latest_slice, ranked, search, top_k
from panelkit.operators.risk import recommendation_items

DIM_COLUMNS = ["continent", "income_group"]
HISTORY_COLUMNS = [
    "year", "co2", "co2_per_capita", "coal_share", "renewables_share", "risk_score",
    "temperature_anomaly", "energy_intensity", "sustainability_score", "population", "gdp",
]


def with_risk(fact: DataFrame, risk: DataFrame) -> DataFrame:
    return enrich(fact, risk, [ENTITY, PERIOD], ["risk_score"])


def of_entity(df: DataFrame, code: str) -> DataFrame:
    return df.filter(F.col(ENTITY) == x.normalise_code(code))


# Global overview -----------------------------------------------------------

def _latest_with_risk(fact: DataFrame, risk: DataFrame) -> DataFrame:
    """Both tables cut to the fact's last period before they are joined."""
    return with_risk(latest_slice(fact), latest_slice(risk, of=fact))


def global_kpis(fact: DataFrame, risk: DataFrame) -> DataFrame:
    latest = _latest_with_risk(fact, risk)
    return latest.agg(
        F.max(PERIOD).alias("latest_year"),
        F.count_distinct(ENTITY).alias("total_countries"),
        F.round(F.coalesce(F.sum("co2"), F.lit(0.0)) / 1000, 2).alias("total_co2_gt"),
        F.round(F.avg("temperature_anomaly"), 3).alias("avg_temperature_anomaly"),
        F.round(F.avg("renewables_share"), 1).alias("avg_renewables_share"),
        F.round(F.avg("risk_score"), 1).alias("avg_risk_score"),
    )


def top_emitters(fact: DataFrame, risk: DataFrame, k=10) -> DataFrame:
    latest = _latest_with_risk(fact, risk)
    return top_k(latest.select(ENTITY, "country", "co2", "co2_per_capita", "risk_score"), "co2", k)


def emissions_trend(fact: DataFrame, risk: DataFrame) -> DataFrame:
    return with_risk(fact, risk).groupBy(PERIOD).agg(
        F.coalesce(F.sum("co2"), F.lit(0.0)).alias("total_co2"),
        F.avg("temperature_anomaly").alias("avg_temp"),
        F.avg("risk_score").alias("avg_risk"),
    ).orderBy(PERIOD)


# Entities ------------------------------------------------------------------

def countries(risk: DataFrame, dim: DataFrame) -> DataFrame:
    latest = enrich(latest_slice(risk), dim, [ENTITY], DIM_COLUMNS)
    return ranked(latest.select(
        ENTITY, "country", "risk_score", "co2_per_capita", "coal_share", "renewables_share",
        "vulnerability_score", *DIM_COLUMNS), "risk_score")


def country_info(dim: DataFrame, code: str) -> DataFrame:
    return of_entity(dim, code)


def country_history(fact: DataFrame, risk: DataFrame, code: str) -> DataFrame:
    return enrich(of_entity(fact, code), of_entity(risk, code), [ENTITY, PERIOD], ["risk_score"]).orderBy(PERIOD)


def country_latest(fact: DataFrame, risk: DataFrame, code: str) -> DataFrame:
    return country_history(fact, risk, code).orderBy(F.desc(PERIOD)).limit(1)


def historical(fact: DataFrame, risk: DataFrame, code: str) -> DataFrame:
    rows = country_history(fact, risk, code)
    return rows.select([c for c in HISTORY_COLUMNS if c in rows.columns])


def actuals_and_forecast(fact: DataFrame, forecasts: DataFrame, code: str, last=20) -> DataFrame:
    """The entity's last known values and its forecast rows, told apart by ``kind``."""
    actual = last_periods(of_entity(fact, code).select(ENTITY, PERIOD, "co2").dropna(), last)
    future = of_entity(forecasts, code).select(ENTITY, PERIOD, "forecast_co2", "forecast_co2_lower", "forecast_co2_upper")
    return (
        actual.withColumn("kind", F.lit("historical"))
        .unionByName(future.withColumn("kind", F.lit("forecast")), allowMissingColumns=True)
        .orderBy(PERIOD)
    )


def risk_ranking(risk: DataFrame, dim: DataFrame) -> DataFrame:
    return ranked(enrich(latest_slice(risk), dim, [ENTITY], DIM_COLUMNS), "risk_score")


def attributions_of(shap: DataFrame, code: str) -> DataFrame:
    """(feature, value) of one entity, four decimals, missing as 0."""
    columns = [c for c in shap.columns if c.startswith("shap_")]
    long = of_entity(shap, code).select(ENTITY, *columns).unpivot([ENTITY], columns, "feature", "value")
    return long.select(ENTITY, F.replace("feature", F.lit("shap_"), F.lit("")).alias("feature"),
                       F.round(F.coalesce("value", F.lit(0.0)), 4).alias("value"))


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster_name").agg(F.count("*").alias("members"))


def cluster_table(clusters: DataFrame) -> DataFrame:
    """Missing emissions count as 0 in this ordering."""
    return clusters.orderBy(F.coalesce("co2_per_capita", F.lit(0.0)).desc(), ENTITY)


def what_if(spark: SparkSession, risk: DataFrame, forecasts: DataFrame, code: str,
            reduction: float, increase: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metrics, forecast path, rejected) for one request."""
    request = spark.createDataFrame(
        [(x.normalise_code(code), float(reduction), float(increase))],
        f"{ENTITY} string, {scenario.REDUCTION} double, {scenario.INCREASE} double")
    mine = of_entity(risk, code)
    simulated = scenario.simulate(mine, request)
    return simulated, scenario.simulate_forecast(of_entity(forecasts, code), simulated), scenario.rejected(request, mine)


def recommendations_of(recs: DataFrame, code: str) -> DataFrame:
    return recommendation_items(of_entity(recs, code))


def narrative_of(narratives: DataFrame, code: str) -> DataFrame:
    return of_entity(narratives, code).select(ENTITY, "country", "narrative", "risk_score")


def anomaly_count(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(F.count("*").alias("count"))


# Equity and targets --------------------------------------------------------

def equity(fact: DataFrame) -> DataFrame:
    """Emissions per unit of output (Mt per billion) and per head, latest period."""
    latest = latest_slice(fact).withColumn("co2_per_gdp", x.guarded_ratio(F.col("co2"), F.col("gdp") / 1e9))
    rows = latest.select(ENTITY, "country", "co2_per_capita", "co2_per_gdp", "co2", "population", "gdp")
    return ranked(rows.dropna(subset=["co2_per_capita"]), "co2_per_capita")


def reduction_targets(spark: SparkSession) -> DataFrame:
    rows = [(e, b, t, r) for e, (b, t, r) in config.REDUCTION_TARGETS.items()]
    return spark.createDataFrame(rows, f"{ENTITY} string, baseline_year int, target_year int, ndc_reduction_pct double")


def target_tracker(fact: DataFrame, targets: DataFrame) -> DataFrame:
    """Baseline, target and present value of each entity with a target."""
    values = fact.select(ENTITY, F.col(PERIOD).alias("baseline_year"), F.col("co2").alias("base"))
    now = latest_slice(fact).select(ENTITY, "country", F.col("co2").alias("now"))
    j = targets.join(values, [ENTITY, "baseline_year"]).join(now, ENTITY)
    c = F.col
    target = c("base") * (1 - c("ndc_reduction_pct") / 100)
    return j.select(
        ENTITY, "country", "baseline_year", "target_year", "ndc_reduction_pct",
        F.round(F.when(c("base") != 0, (1 - c("now") / c("base")) * 100), 1).alias("actual_reduction_pct"),
        F.round("base", 1).alias("baseline_co2"),
        F.round("now", 1).alias("current_co2"),
        F.round(target, 1).alias("target_co2"),
        F.round(c("now") - target, 1).alias("gap_mt"),
        (c("now") <= target).alias("on_track"),
    )


# Dashboard helpers ---------------------------------------------------------

def find_country(rows: DataFrame, text: str, k=15) -> DataFrame:
    return search(rows.select(ENTITY, "country"), text, ["country", ENTITY], k)


def map_metric(rows: DataFrame, metric: str) -> DataFrame:
    return rows.select(ENTITY, "country", F.coalesce(metric, F.lit(0.0)).alias("value"))


def energy_mix(latest: DataFrame) -> DataFrame:
    parts = ["coal_share", "gas_share", "oil_share", "renewables_share"]
    return latest.select(ENTITY, *[F.coalesce(p, F.lit(0.0)).alias(p) for p in parts]).unpivot(
        [ENTITY], parts, "source", "share")


def top_risks(risk: DataFrame, k=15) -> DataFrame:
    rows = latest_slice(risk).select(ENTITY, "country", "risk_score")
    return top_k(rows, "risk_score", k)


# SQL -----------------------------------------------------------------------

SQL_TOP_EMITTERS = """
SELECT country, year, co2, co2_per_capita
FROM {fact} WHERE year = (SELECT max(year) FROM {fact})
ORDER BY co2 DESC NULLS LAST, iso_code LIMIT 5"""

SQL_RISK_BY_CONTINENT = """
SELECT d.continent, round(avg(r.risk_score), 1) AS avg_risk, count(DISTINCT r.iso_code) AS countries
FROM {risk} r JOIN {dim} d ON r.iso_code = d.iso_code
WHERE r.year = (SELECT max(year) FROM {risk})
GROUP BY d.continent ORDER BY avg_risk DESC"""

SQL_GLOBAL_GROWTH = """
WITH yearly AS (SELECT year, sum(co2) AS total FROM {fact} GROUP BY year),
compared AS (SELECT year, total, lag(total) OVER (ORDER BY year) AS before FROM yearly)
SELECT year, round(total, 0) AS total_co2_mt,
       round(try_divide(total - before, before) * 100, 2) AS yoy_growth_pct
FROM compared ORDER BY year DESC LIMIT 10"""

SQL_CLUSTER_SUMMARY = """
SELECT cluster_name, count(*) AS countries, round(avg(co2_per_capita), 1) AS avg_co2_pc,
       round(avg(renewables_share), 1) AS avg_renewables
FROM {clusters} GROUP BY cluster_name ORDER BY avg_co2_pc DESC"""


def run_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """SQL over the given tables, named in braces in the text."""
    return spark.sql(text, **tables)
