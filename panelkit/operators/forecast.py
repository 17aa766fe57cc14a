"""Forecasts of every entity's series at once.

Models of one series are closed forms over grouped sums (no Python, no per-entity loop) or, for a trend with
several changes of slope, a small group per entity; two are pooled regressions on lagged values,
trained once across all entities. Each returns one row per entity and future period with value,
lower and upper bound of a 90 % band.

  arima    AR(1) on first differences, by exact likelihood
  prophet  linear trend whose slope changes at few of many places (``trend.changepoint_forecast``), or with one
           change shrunk by a ridge penalty (``trend_forecast``)
  lstm     pooled gradient-boosted trees on five lags of the standardised series
  np       pooled linear regression on the same lags, with a +-5 % band
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit import config
from panelkit.config import BAND_90, ENTITY, HORIZON, PERIOD
from panelkit.functions.expressions import clip
from panelkit.operators import boosting
from panelkit.operators.relational import full_outer
from panelkit.operators.trees import tree_walk
from panelkit.operators.trend import changepoint_forecast
from panelkit.operators.windows import lagged_sequences, standardise_by_entity
from panelkit.session import store

MODELS = ["prophet", "lstm", "arima", "np"]
LAGS = 5


def known_series(df: DataFrame, value: str, entity=ENTITY, period=PERIOD) -> DataFrame:
    return df.select(entity, F.col(period).alias(period), F.col(value).cast("double").alias("y")).dropna()


def _future(horizon: int) -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")


def _band(model: str, floor: float | None, value: Column, lower: Column, upper: Column) -> list[Column]:
    names = (f"{model}_co2", f"{model}_lower", f"{model}_upper")
    return [clip(c, lo=floor).alias(n) if floor is not None else c.alias(n) for n, c in zip(names, (value, lower, upper))]


def _likeliest(all_, cross, inner, m) -> Column:
    """phi of the largest exact likelihood of m differences with d_t = phi d_(t-1) + e.

    ``all_``: the sum of all squares, ``cross``: of neighbours' products, ``inner``: of squares but the first and
    last. The first difference counts with its stationary variance, so this is what a state-space filter
    maximises; its derivative has one root between -1 and 1, found by halving.
    """
    def slope(p: Column) -> Column:
        return m * (p * inner - cross) * (1 - p * p) + p * (all_ - 2 * p * cross + p * p * inner)

    halves = F.array(*[F.lit(2.0**-i) for i in range(1, 51)])
    return F.when(all_ > 0, F.aggregate(halves, F.lit(0.0), lambda p, step: p + F.when(slope(p) < 0, step).otherwise(-step))).otherwise(0.0)


def difference_forecast(df: DataFrame, value="co2", horizon=HORIZON, min_points=10, entity=ENTITY, period=PERIOD) -> DataFrame:
    """AR(1) on differences, fitted by exact likelihood: d_t = phi d_(t-1) + e, summed up from the last value.

    All that the likelihood needs are grouped sums. The band grows with the variance of the summed-up errors.
    """
    w = Window.partitionBy(entity).orderBy(period)
    d = F.col("d")
    steps = (
        known_series(df, value, entity, period)
        .withColumn("d", F.col("y") - F.lag("y").over(w))
        .withColumn("d1", F.lag("d").over(w))
    )
    ends = lambda f: F.coalesce(f("d", F.when(d.isNotNull(), F.col(period))), F.lit(0.0))
    fit = steps.groupBy(entity).agg(
        F.count("*").alias("n"),
        F.max(period).alias("last"),
        F.max_by("y", period).alias("y_last"),
        ends(F.max_by).alias("d_last"),
        ends(F.min_by).alias("d_first"),
        F.sum(d * F.col("d1")).alias("cross"),
        F.sum(d * d).alias("all"),
        F.count("d").alias("m"),
    ).filter(F.col("n") >= min_points)
    c = F.col
    fit = fit.withColumn("inner", c("all") - c("d_first") * c("d_first") - c("d_last") * c("d_last"))
    fit = fit.withColumn("phi", _likeliest(c("all"), c("cross"), c("inner"), c("m")))
    fit = fit.withColumn("var", F.greatest(F.lit(0.0), c("all") - 2 * c("phi") * c("cross") + c("phi") * c("phi") * c("inner")) / c("m"))
    rows = fit.select("*", _future(horizon))
    p, h = F.col("phi"), F.col("h")
    ph = F.pow(p, h)
    mean = F.col("y_last") + F.col("d_last") * p * (1 - ph) / (1 - p)
    spread = (h - 2 * p * (1 - ph) / (1 - p) + p * p * (1 - ph * ph) / (1 - p * p)) / ((1 - p) * (1 - p))
    half = BAND_90 * F.sqrt(F.col("var") * F.greatest(F.lit(0.0), spread))
    return rows.select(entity, (F.col("last") + h).cast("int").alias(period), *_band("arima", 0, mean, mean - half, mean + half))


def trend_forecast(df: DataFrame, value="co2", horizon=HORIZON, min_points=10, prior=0.1, knot=0.8,
                   floor: float | None = 0, entity=ENTITY, period=PERIOD, model="prophet") -> DataFrame:
    """a + b t + c max(0, t - knot) with penalty c^2 / prior; t runs from 0 to 1 over the history.

    The 3x3 normal equations are solved by Cramer's rule over grouped sums.
    """
    series = known_series(df, value, entity, period)
    w = Window.partitionBy(entity)
    span = F.max(period).over(w) - F.min(period).over(w)
    pts = series.withColumn("t", F.when(span > 0, (F.col(period) - F.min(period).over(w)) / span))
    pts = pts.withColumn("k", F.greatest(F.lit(0.0), F.col("t") - knot)).withColumn("y0", F.col("y") - F.avg("y").over(w))
    t, k, y = F.col("t"), F.col("k"), F.col("y0")
    fit = pts.groupBy(entity).agg(
        F.count("*").cast("double").alias("n"), F.min(period).alias("first"), F.max(period).alias("last"),
        F.avg("y").alias("mean"),
        F.sum(t).alias("st"), F.sum(k).alias("sk"), F.sum(t * t).alias("stt"), F.sum(t * k).alias("stk"),
        F.sum(k * k).alias("skk"), F.sum(y).alias("sy"), F.sum(t * y).alias("sty"), F.sum(k * y).alias("sky"),
        F.sum(y * y).alias("syy"),
    ).filter((F.col("n") >= min_points) & (F.col("last") > F.col("first")))
    c = F.col
    pen = c("skk") + 1.0 / prior

    def det(a, b, d, e, f, g, h, i, j):
        return a * (f * j - g * i) - b * (e * j - g * h) + d * (e * i - f * h)

    base = det(c("n"), c("st"), c("sk"), c("st"), c("stt"), c("stk"), c("sk"), c("stk"), pen)
    fit = fit.withColumn("det", base).withColumns({
        "a": det(c("sy"), c("st"), c("sk"), c("sty"), c("stt"), c("stk"), c("sky"), c("stk"), pen) / c("det"),
        "b": det(c("n"), c("sy"), c("sk"), c("st"), c("sty"), c("stk"), c("sk"), c("sky"), pen) / c("det"),
        "c": det(c("n"), c("st"), c("sy"), c("st"), c("stt"), c("sty"), c("sk"), c("stk"), c("sky")) / c("det"),
    })
    a, b, s = c("a"), c("b"), c("c")
    rss = (
        c("syy") - 2 * (a * c("sy") + b * c("sty") + s * c("sky"))
        + a * a * c("n") + b * b * c("stt") + s * s * c("skk")
        + 2 * (a * b * c("st") + a * s * c("sk") + b * s * c("stk"))
    )
    fit = fit.withColumn("half", BAND_90 * F.sqrt(F.greatest(F.lit(0.0), rss) / c("n")))
    rows = fit.select("*", _future(horizon)).withColumn(
        "ft", (c("last") + c("h") - c("first")) / (c("last") - c("first")))
    mean = c("mean") + a + b * c("ft") + s * F.greatest(F.lit(0.0), c("ft") - knot)
    return rows.select(entity, (c("last") + c("h")).cast("int").alias(period),
                       *_band(model, floor, mean, mean - c("half"), mean + c("half")))


def temperature_forecast(df: DataFrame, value="temperature_anomaly", horizon=HORIZON, period=PERIOD) -> DataFrame:
    """The trend model on the one global series of distinct periods; not clipped."""
    series = (
        df.filter(F.col(value).isNotNull()).groupBy(period).agg(F.min(value).alias(value))
        .withColumn("_series", F.lit("global"))
    )
    out = trend_forecast(series, value, horizon, min_points=5, prior=0.05, floor=None, entity="_series", period=period, model="temp")
    return out.select(
        period, F.col("temp_co2").alias("forecast_temp_anomaly"),
        F.col("temp_lower").alias("forecast_temp_lower"), F.col("temp_upper").alias("forecast_temp_upper"))


def lag_table(df: DataFrame, value="co2", min_points=15, entity=ENTITY, period=PERIOD) -> DataFrame:
    """Standardised series with five lags, for entities with enough points and some variation."""
    w = Window.partitionBy(entity)
    enough = known_series(df, value, entity, period).withColumn("n", F.count("*").over(w)).filter(F.col("n") >= min_points)
    return lagged_sequences(standardise_by_entity(enough, "y", entity), "z", LAGS, entity, period)


def _start_state(lags: DataFrame, entity: str, period: str) -> DataFrame:
    """Per entity the last five standardised values as the inputs of the first future step."""
    last = lags.groupBy(entity).agg(F.max_by(
        F.struct("z", *[f"lag_{i}" for i in range(1, LAGS)], "series_mean", "series_std"), period).alias("s"),
        F.max(period).alias("last"))
    state = [F.col("s.z").alias("lag_1")] + [F.col(f"s.lag_{i}").alias(f"lag_{i + 1}") for i in range(1, LAGS)]
    return last.select(entity, "last", *state, "s.series_mean", "s.series_std")


def _steps(state: DataFrame, predict, horizon: int, entity: str) -> DataFrame:
    """(entity, last, h, v): predictions fed back as the newest lag, one after the other.

    ``predict`` is a function of the array of lags, the newest first.
    """
    lags = F.array(*[F.col(f"lag_{i}") for i in range(1, LAGS + 1)])
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), lags, lambda newest, _: F.concat(F.array(predict(newest)), newest))
    rows = state.select(entity, "last", "series_mean", "series_std", F.posexplode(F.reverse(F.slice(path, 1, horizon))).alias("at", "z"))
    return rows.select(entity, "last", (F.col("at") + 1).alias("h"), (F.col("z") * F.col("series_std") + F.col("series_mean")).alias("v"))


def pooled_tree_forecast(df: DataFrame, value="co2", horizon=HORIZON, trees=20, depth=4, rate=0.1,
                         entity=ENTITY, period=PERIOD) -> DataFrame:
    """Boosted trees on five lags of all series; the band is the spread of the series' own residuals."""
    lags = store(lag_table(df, value, entity=entity, period=period), "lags")
    names = [f"lag_{i}" for i in range(1, LAGS + 1)]
    model = boosting.fit(lags, names, "z", trees, depth, rate)
    walk = tree_walk(model.trees)
    residuals = model.predict(lags, "p").groupBy(entity).agg(F.stddev_pop((F.col("z") - F.col("p")) * F.col("series_std")).alias("resid"))
    rows = _steps(_start_state(lags, entity, period), lambda x: model.base + walk(x), horizon, entity).join(residuals, entity)
    v = clip(F.col("v"), lo=0)
    half = BAND_90 * F.col("resid")
    return rows.select(entity, (F.col("last") + F.col("h")).cast("int").alias(period),
                       v.alias("lstm_co2"), clip(v - half, lo=0).alias("lstm_lower"), (v + half).alias("lstm_upper"))


def linear_weights(rows: DataFrame, features: Sequence[str], label: str, ridge: float) -> list[float]:
    """Intercept and weights of a ridge regression, from one pass of grouped sums; the intercept is free."""
    one = [F.lit(1.0), *[F.col(f) for f in features]]
    sums = [F.sum(a * b).alias(f"a_{i}_{j}") for i, a in enumerate(one) for j, b in enumerate(one) if i <= j]
    s = rows.agg(*sums, *[F.sum(a * F.col(label)).alias(f"b_{i}") for i, a in enumerate(one)]).first()
    k = len(one)
    if s["a_0_0"] is None:
        return [0.0] * k
    a = np.array([[s[f"a_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    return np.linalg.lstsq(a + np.diag([0.0] + [ridge] * (k - 1)), np.array([s[f"b_{i}"] for i in range(k)]), rcond=None)[0].tolist()


def pooled_linear_forecast(df: DataFrame, value="co2", horizon=HORIZON, ridge=1e-3, entity=ENTITY, period=PERIOD) -> DataFrame:
    """A ridge regression on the same lags."""
    lags = store(lag_table(df, value, entity=entity, period=period), "lags")
    intercept, *weights = linear_weights(lags, [f"lag_{i}" for i in range(1, LAGS + 1)], "z", ridge)
    predict = lambda x: reduce(lambda p, q: p + q, [F.get(x, F.lit(i)) * w for i, w in enumerate(weights)]) + intercept
    rows = _steps(_start_state(lags, entity, period), predict, horizon, entity)
    v = F.col("v")
    return rows.select(entity, (F.col("last") + F.col("h")).cast("int").alias(period),
                       *_band("np", 0, v, v * 0.95, v * 1.05))


def ensemble(frames: dict[str, DataFrame], weights: dict[str, float] | None = None, entity=ENTITY, period=PERIOD) -> DataFrame:
    """Weighted mean over the models that have a row, their weights scaled to sum to one."""
    weights = weights or config.ENSEMBLE_WEIGHTS
    names = [m for m in MODELS if m in frames]
    merged = full_outer([frames[m] for m in names], [entity, period])
    add = lambda parts: reduce(lambda p, q: p + q, parts)
    present = {m: F.when(F.col(f"{m}_co2").isNotNull(), weights[m]).otherwise(0.0) for m in names}
    total = add(present.values())
    mix = lambda part: F.when(total > 0, add([F.coalesce(F.col(f"{m}_{part}"), F.lit(0.0)) * present[m] for m in names]) / total)
    label = F.concat_ws("+", *[F.when(F.col(f"{m}_co2").isNotNull(), config.MODEL_LABELS[m]) for m in names])
    return merged.withColumns({
        "forecast_co2": clip(mix("co2"), lo=0),
        "forecast_co2_lower": clip(mix("lower"), lo=0),
        "forecast_co2_upper": mix("upper"),
        "model_used": label,
    })


def last_known(fact: DataFrame, values: dict[str, str] | None = None, entity=ENTITY, period=PERIOD) -> DataFrame:
    """Last period of each entity, and the last non-missing value of each column (maybe older)."""
    values = values or {"co2": "last_co2", "co2_per_capita": "last_co2_per_capita"}
    picks = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(period))).alias(out) for c, out in values.items()]
    return fact.groupBy(entity).agg(F.max(period).alias("last_historical_year"), *picks)


def assemble(models: DataFrame, temperature: DataFrame, fact: DataFrame, entity=ENTITY, period=PERIOD) -> DataFrame:
    """Ensemble rows with the global series' forecast and each entity's history attached."""
    names = fact.groupBy(entity).agg(F.min_by("country", F.when(F.col("country").isNotNull(), F.col(period))).alias("country"))
    temperature = F.broadcast(temperature)  # one row per future period of one series
    return (
        models.join(temperature, period, "left")
        .join(names, entity, "left")
        .join(last_known(fact, entity=entity, period=period), entity, "left")
    )


def forecasts(fact: DataFrame, horizon=HORIZON, trees=20, depth=4, one_knot=False, entity=ENTITY, period=PERIOD) -> DataFrame:
    """All four models, the ensemble and the context columns for every entity. ``one_knot`` takes the closed form of the trend."""
    trend = trend_forecast if one_knot else changepoint_forecast
    frames = {
        "prophet": trend(fact, horizon=horizon, entity=entity, period=period),
        "lstm": pooled_tree_forecast(fact, horizon=horizon, trees=trees, depth=depth, entity=entity, period=period),
        "arima": difference_forecast(fact, horizon=horizon, entity=entity, period=period),
        "np": pooled_linear_forecast(fact, horizon=horizon, entity=entity, period=period),
    }
    return assemble(ensemble(frames, entity=entity, period=period),
                    temperature_forecast(fact, horizon=horizon, period=period), fact, entity, period)
