"""Generated texts: entity narratives, global summary, report and executive summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.config import ENTITY, GLOBAL_TEXT, NARRATIVE_TEXT, PERIOD, SUMMARY_TEXT
from panelkit.functions import expressions as x
from panelkit.operators.relational import bottom_k, latest_slice, ranked, top_k


def country_narrative(period=PERIOD) -> Column:
    """One paragraph per row; a sentence whose value is missing is left out."""
    c, text = F.col, NARRATIVE_TEXT
    risk, per_capita, coal = c("risk_score"), c("co2_per_capita"), c("coal_share")
    renewables, vulnerability, growth = c("renewables_share"), c("vulnerability_score"), c("co2_growth_rate")
    opening = F.when(
        risk.isNotNull(), F.format_string(text["risk"], c("country"), x.risk_word(risk), risk, c(period))
    ).otherwise(F.format_string(text["risk_missing"], c("country"), c(period)))
    emissions = (
        F.when(per_capita > 15, F.format_string(text["per_capita_high"], per_capita))
        .when(per_capita > 5, F.format_string(text["per_capita_mid"], per_capita))
        .when(per_capita.isNotNull(), F.format_string(text["per_capita_low"], per_capita))
    )
    clean = (
        F.when(renewables > 40, F.format_string(text["renewables_high"], renewables))
        .when(renewables < 15, F.format_string(text["renewables_low"], renewables))
    )
    priorities = F.concat_ws(
        ", ",
        x.sentence(coal > 30, text["priority_coal"]),
        x.sentence(renewables < 20, text["priority_renewables"]),
        x.sentence(per_capita > 10, text["priority_per_capita"]),
        x.sentence(vulnerability > 0.5, text["priority_vulnerability"]),
    )
    return F.concat_ws(
        " ", opening, emissions,
        x.sentence(coal > 30, text["coal"], coal),
        clean,
        x.sentence(F.abs(growth) > 1, text["trend"], x.trend_word(growth), growth),
        x.sentence(vulnerability > 0.5, text["vulnerability"], vulnerability),
        x.sentence(c("temperature_anomaly") > 1.0, text["temperature"], c("temperature_anomaly")),
        x.sentence(priorities != "", text["priorities"], priorities),
    )


def narratives(scored: DataFrame, entity=ENTITY, period=PERIOD) -> DataFrame:
    rows = latest_slice(scored, period).withColumn("narrative", country_narrative(period))
    return ranked(rows.select(entity, "country", "risk_score", "narrative"), "risk_score", [entity])


def global_narrative(scored: DataFrame, entity=ENTITY, period=PERIOD) -> DataFrame:
    """One row per line of the global summary: (line, text)."""
    text = GLOBAL_TEXT
    latest = latest_slice(scored, period)
    top = top_k(latest.select(entity, "country", "co2"), "co2", 3, [entity])
    order = F.struct((-F.coalesce(F.col("co2"), F.lit(0.0))).alias("o"), F.col(entity).alias("k"), F.col("country").alias("n"))
    names = top.agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda s: s["n"]), ", ")).scalar()
    kpi = latest.agg(
        F.max(period).alias("y"),
        (F.coalesce(F.sum("co2"), F.lit(0.0)) / 1000).alias("co2"),
        F.count_distinct(entity).alias("n"),
        F.avg("temperature_anomaly").alias("temp"),
        F.avg("renewables_share").alias("ren"),
        F.avg("risk_score").alias("risk"),
        F.count_if(F.col("risk_score") > 70).alias("high"),
    )
    c = F.col
    lines = [
        F.format_string(text["title"], c("y")),
        F.format_string(text["total"], c("co2"), c("n")),
        F.format_string(text["top"], names),
        x.sentence(c("temp").isNotNull(), text["temperature"], c("temp")),
        x.sentence(c("ren").isNotNull(), text["renewables"], c("ren")),
        x.sentence(c("risk").isNotNull(), text["risk"], c("risk")),
        F.format_string(text["high_risk"], c("high")),
    ]
    return kpi.select(F.posexplode(F.array(*lines)).alias("line", "text")).filter("text is not null")


def report(scored: DataFrame, texts: DataFrame, head=10, tail=5, entity=ENTITY, period=PERIOD) -> DataFrame:
    """(section, rank, text): the global lines, the riskiest and the least risky entities."""
    def section(df, name, order):
        return df.agg(F.collect_list(order).alias("_l")).select(
            F.lit(name).alias("section"),
            F.posexplode(F.transform(F.array_sort("_l"), lambda s: s["text"])).alias("rank", "text"))
    by_risk = F.struct(F.col("risk_score").isNull().alias("m"), (-F.col("risk_score")).alias("r"),
                       F.col(entity).alias("k"), F.col("narrative").alias("text"))
    overall = global_narrative(scored, entity, period).select(F.lit("global").alias("section"), F.col("line").alias("rank"), "text")
    return (
        overall
        .unionByName(section(top_k(texts, "risk_score", head, [entity]), "highest", by_risk))
        .unionByName(section(bottom_k(texts, "risk_score", tail, [entity]), "lowest", by_risk))
    )


def executive_summary(scored: DataFrame, texts: DataFrame, entity=ENTITY, period=PERIOD) -> DataFrame:
    """(section, rank, text): overview with two figures, the five riskiest entities, fixed advice."""
    latest = latest_slice(scored, period)
    overview = latest.agg(
        (F.coalesce(F.sum("co2"), F.lit(0.0)) / 1000).alias("co2"), F.avg("temperature_anomaly").alias("temp")
    ).select(F.lit("overview").alias("section"), F.lit(0).alias("rank"),
             F.format_string(SUMMARY_TEXT["overview"], "co2", "temp").alias("text"))
    by_risk = F.struct(F.col("risk_score").isNull().alias("m"), (-F.col("risk_score")).alias("r"), F.col(entity).alias("k"),
                       F.concat(F.lit("> "), F.col("country"), F.lit(": "), F.col("narrative")).alias("text"))
    riskiest = top_k(texts, "risk_score", 5, [entity]).agg(F.collect_list(by_risk).alias("l")).select(
        F.lit("critical").alias("section"),
        F.posexplode(F.transform(F.array_sort("l"), lambda s: s["text"])).alias("rank", "text"))
    advice = overview.select(
        F.lit("advice").alias("section"),
        F.posexplode(F.array(*map(F.lit, SUMMARY_TEXT["advice"]))).alias("rank", "text"))
    return overview.unionByName(riskiest).unionByName(advice)
