"""Spikes against the previous period, and outliers among the entities of one period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelkit import config
from panelkit.config import ENTITY, PERIOD
from panelkit.functions.expressions import spike_direction
from panelkit.operators.relational import attach, enrich
from panelkit.operators.windows import percent_change


def yoy_spikes(fact: DataFrame, threshold_pct: float = 50, value="co2", entity=ENTITY, period=PERIOD) -> DataFrame:
    """Rows whose change exceeds the threshold in either direction; a zero base counts as +inf."""
    change = F.col("co2_yoy_pct")
    return (
        fact.withColumn("co2_yoy_pct", percent_change(value, entity, period))
        .filter(F.abs(change) > threshold_pct)
        .withColumn("spike_direction", spike_direction(change))
        .select(*[c for c in (entity, "country", period, value, "co2_yoy_pct", "spike_direction") if c in fact.columns
                  or c in ("co2_yoy_pct", "spike_direction")])
    )


def cross_sectional_outliers(
    fact: DataFrame, metrics: Sequence[str] = tuple(config.OUTLIER_METRICS), limit: float = 3,
    min_rows: int = 20, min_values: int = 10, entity=ENTITY, period=PERIOD,
) -> DataFrame:
    """Values more than ``limit`` sample standard deviations from their period's mean.

    Means and deviations are grouped aggregates (combined before the shuffle) attached back, not a
    window: a window would bring a period's rows into one task, and one period may hold most rows.
    """
    ids = [c for c in (entity, "country", period) if c in fact.columns]
    long = fact.select(*ids, *[m for m in metrics if m in fact.columns]).unpivot(
        ids, [m for m in metrics if m in fact.columns], "metric", "value")
    stats = (
        long.groupBy(period, "metric")
        .agg(F.count("*").alias("n_rows"), F.count("value").alias("n"),
             F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
        .filter((F.col("n_rows") >= min_rows) & (F.col("n") >= min_values) & (F.col("std") > 0))
        .select(period, "metric", "mean", "std")
    )
    scored = attach(long.filter("value is not null"), stats, [period, "metric"], "inner").withColumn(
        "z_score", (F.col("value") - F.col("mean")) / F.col("std"))
    return scored.filter(F.abs("z_score") > limit).select(*ids, "metric", "value", "z_score", "mean", "std")


def attach_flags(fact: DataFrame, flags: DataFrame, entity=ENTITY, period=PERIOD) -> DataFrame:
    """Anomaly score and flag per fact row; rows that were not scored get flag 0. Rerunnable."""
    out = enrich(fact, flags, [entity, period], ["anomaly_score", "is_anomaly"])
    return out.withColumn("is_anomaly", F.coalesce(F.col("is_anomaly"), F.lit(0)).cast("int"))


def summary(flagged: DataFrame, spikes: DataFrame, outliers: DataFrame) -> DataFrame:
    one = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("method"), "n")
    return (
        one(flagged.filter("is_anomaly = 1"), "isolation_forest")
        .unionByName(one(spikes, "yoy_spikes"))
        .unionByName(one(outliers, "cross_sectional"))
    )
