"""Gradient-boosted risk model: training, scoring and its fit on the training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelkit import config
from panelkit.functions import expressions as x
from panelkit.operators import boosting
from panelkit.operators.boosting import BoostedTrees
from panelkit.operators.risk import blended_score, bounds, heuristic_score
from panelkit.session import store


def training_rows(df: DataFrame, features: Sequence[str], target: str = config.RISK_TARGET) -> DataFrame:
    """The features and ``label`` of rows with every feature and the target known; the target scaled to 0-100.

    Infinite features count as 0, as they do when a row is scored.
    """
    known = df.select(*features, target).dropna()
    b = bounds(known, [target])
    label = x.min_max_score(F.col(target), F.lit(b[f"min_{target}"]), F.lit(b[f"max_{target}"])) if b[f"n_{target}"] else F.lit(0.0)
    return known.select(*[x.finite_or(F.col(f), 0.0).alias(f) for f in features], label.alias("label"))


def train(df: DataFrame, features: Sequence[str] | None = None, target: str = config.RISK_TARGET, trees=200, depth=5,
          rate=0.1, min_rows=100) -> tuple[BoostedTrees | None, DataFrame | None, list[str]]:
    """(model, one-row metrics, features used); no model below ``min_rows`` training rows."""
    features = [f for f in (features or config.RISK_FEATURES) if f in df.columns and f != target]
    rows = store(training_rows(df, features, target), "train")
    n = rows.count()
    if n < min_rows:
        return None, None, features
    model = boosting.fit(rows, features, "label", trees, depth, rate)
    r2 = boosting.r_squared(model.predict(rows), F.col("prediction"), F.col("label"))
    metrics = df.sparkSession.range(1).select(
        F.lit(trees).alias("trees"), F.lit(depth).alias("depth"), F.lit(rate).alias("rate"),
        F.lit(",".join(features)).alias("features"), F.lit(n).alias("train_rows"), F.lit(r2).alias("train_r2"))
    return model, metrics, features


def predict(df: DataFrame, model: BoostedTrees, out="risk_score_ml") -> DataFrame:
    """Score every row (missing features as 0), clipped to 0-100."""
    return model.predict(df, out).withColumn(out, x.clip(F.col(out), 0, 100))


def score_all(df: DataFrame, trees=200, depth=5) -> tuple[DataFrame, BoostedTrees | None, DataFrame | None, list[str]]:
    """Heuristic score, model score and their blend for every row."""
    base = heuristic_score(df)
    model, metrics, features = train(df, trees=trees, depth=depth)
    if model is None:
        return blended_score(base), None, None, features
    return blended_score(predict(base, model), "risk_score_ml"), model, metrics, features
