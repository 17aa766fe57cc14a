"""Heuristic risk score, blending, categories and recommendations; expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelkit import config
from panelkit.config import ENTITY, PERIOD, RECOMMENDATION_SEPARATOR, RECOMMENDATION_TEXT
from panelkit.functions import expressions as x
from panelkit.operators.relational import latest_slice, ranked

RISK_COLUMNS = [
    "iso_code", "country", "year", "risk_score", "risk_category", "co2_per_capita", "coal_share",
    "renewables_share", "vulnerability_score", "sustainability_score", "co2_growth_rate",
    "energy_intensity", "temperature_anomaly",
]


def bounds(df: DataFrame, columns) -> dict:
    """Minimum, maximum and known count of each column: one pass, one row on the driver.

    As literals they keep the plan small; as subqueries each use would plan the input again.
    """
    parts = []
    for c in columns:
        parts += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count(c).alias(f"n_{c}")]
    return df.agg(*parts).first().asDict()


def heuristic_score(df: DataFrame, weights: dict[str, tuple[int, bool]] | None = None, out="risk_score_heuristic") -> DataFrame:
    """Weighted mean of min-max scores. A missing value scores 50; a column without any value
    takes its weight out of the mean."""
    weights = {f: w for f, w in (weights or config.HEURISTIC_WEIGHTS).items() if f in df.columns}
    if not weights:
        return df.withColumn(out, F.lit(0.0))
    b = bounds(df, weights)
    known = {f: w for f, w in weights.items() if b[f"n_{f}"]}
    if not known:
        return df.withColumn(out, F.lit(0.0))
    parts = []
    for f, (weight, lowers) in known.items():
        scaled = x.min_max_score(F.col(f), F.lit(b[f"min_{f}"]), F.lit(b[f"max_{f}"]), lowers)
        parts.append(F.coalesce(scaled, F.lit(50.0)) * weight)
    score = reduce(lambda p, q: p + q, parts) / sum(w for w, _ in known.values())
    return df.withColumn(out, x.clip(score, 0, 100))


def blended_score(df: DataFrame, ml: str | None = None, heuristic="risk_score_heuristic", out="risk_score") -> DataFrame:
    """0.6 model + 0.4 heuristic, or the heuristic alone; one decimal."""
    score = F.col(heuristic) if ml is None else 0.6 * F.col(ml) + 0.4 * F.col(heuristic)
    return df.withColumn(out, F.round(score, 1))


def risk_scores(scored: DataFrame) -> DataFrame:
    out = scored.withColumn("risk_category", x.risk_category(F.col("risk_score")))
    return out.select([c for c in RISK_COLUMNS if c in out.columns])


def recommendation_text() -> Column:
    c, text = F.col, RECOMMENDATION_TEXT
    picked = F.concat_ws(
        RECOMMENDATION_SEPARATOR,
        x.sentence(c("coal_share") > 30, text["coal"], c("coal_share")),
        x.sentence(c("renewables_share") < 20, text["renewables"], c("renewables_share")),
        x.sentence(c("co2_growth_rate") > 2, text["growth"], c("co2_growth_rate")),
        x.sentence(c("energy_intensity") > 0.5, text["intensity"]),
        x.sentence(c("co2_per_capita") > 10, text["per_capita"], c("co2_per_capita")),
        x.sentence(c("vulnerability_score") > 0.5, text["vulnerability"]),
    )
    return F.when(picked == "", text["default"]).otherwise(picked)


def recommendations(scored: DataFrame, period=PERIOD, entity=ENTITY) -> DataFrame:
    """Recommendation list of each entity at the latest period, riskiest first."""
    rows = latest_slice(scored, period).withColumn("recommendations", recommendation_text())
    return ranked(rows.select(entity, "country", "risk_score", "recommendations"), "risk_score", [entity])


def recommendation_items(recs: DataFrame) -> DataFrame:
    """The list back as one row per item."""
    pattern = RECOMMENDATION_SEPARATOR.replace("|", "[|]")
    return recs.select("iso_code", "country", "risk_score",
                       F.posexplode(F.split("recommendations", pattern)).alias("position", "recommendation"))
