"""A trend with several changes of slope, most of them none: an L1 penalty decides where the slope changes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelkit.config import BAND_90, ENTITY, HORIZON, PERIOD

KNOTS = 25
HISTORY = 0.8  # share of the history in which the slope may change


def knots_of(t: np.ndarray, most: int = KNOTS, history: float = HISTORY) -> np.ndarray:
    """Places on the time axis at which the slope may change: evenly over the first points, the very first left out."""
    upto = int(np.floor(history * len(t)))
    at = np.unique(np.linspace(0, max(upto - 1, 0), min(most, max(upto - 1, 0)) + 1).round().astype(int))
    return t[at[1:]]


def design(t: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Columns 1, t, and max(0, t - knot) for every knot."""
    return np.column_stack([np.ones(len(t)), t, np.maximum(0.0, t[:, None] - knots)])


def _exact(gram: np.ndarray, with_y: np.ndarray, c: np.ndarray, penalty: float) -> np.ndarray | None:
    """The best coefficients if those that are not zero now, with their signs, are the right ones; else none."""
    on = np.flatnonzero(c)
    out = np.zeros_like(c)
    if len(on):
        out[on] = np.linalg.lstsq(gram[np.ix_(on, on)], with_y[on] - penalty * np.sign(c[on]), rcond=None)[0]
    pull = with_y - gram @ out
    fits = (np.sign(out[on]) == np.sign(c[on])).all() and np.abs(pull).max(initial=0.0) <= penalty * (1 + 1e-7) + 1e-14
    return out if fits and np.allclose(pull[on], penalty * np.sign(out[on]), atol=1e-10) else None


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, free: int = 2, sweeps: int = 4000) -> np.ndarray:
    """Coefficients of least half squared error plus ``penalty`` times the absolute values of all but the first ``free``.

    Coordinate descent: one coefficient after the other takes its best value given the others. It finds out
    early which stay zero and which signs the others have; then their values are solved for and
    checked. The free ones are taken out beforehand by projection, so they need no turns.
    """
    base, rest = x[:, :free], x[:, free:]
    onto = np.linalg.pinv(base)
    away = rest - base @ (onto @ rest)
    target = y - base @ (onto @ y)
    gram, with_y = away.T @ away, away.T @ target
    c = np.zeros(rest.shape[1])
    for turn in range(sweeps):
        before = c.copy()
        for j in np.flatnonzero(np.diag(gram) > 1e-15):
            pull = with_y[j] - gram[j] @ c + gram[j, j] * c[j]
            c[j] = np.sign(pull) * max(abs(pull) - penalty, 0.0) / gram[j, j]
        if turn % 20 == 19 or np.abs(c - before).max(initial=0.0) < 1e-13:
            solved = _exact(gram, with_y, c, penalty)
            if solved is not None:
                c = solved
                break
    return np.concatenate([onto @ (y - rest @ c), c])


def changepoint_forecast(df: DataFrame, value="co2", horizon=HORIZON, min_points=10, prior=0.1, floor: float | None = 0,
                         knots=KNOTS, entity=ENTITY, period=PERIOD, model="prophet") -> DataFrame:
    """Value and 90 % band of every future period: a line whose slope changes at few of ``knots`` places.

    Series are scaled by their largest absolute value and time to 0-1; a change of slope costs its size over
    ``prior``, against squared errors over the noise's variance, which second differences tell. Series with fewer
    than ``min_points`` known values are left out. A series has one row per period, so a group is small.
    """
    series = df.select(entity, F.col(period).cast("int").alias("_t"), F.col(value).cast("double").alias("_y")).dropna()
    kind = series.schema[entity].dataType.simpleString()
    names = [f"{model}_co2", f"{model}_lower", f"{model}_upper"]

    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_t", "ascending")])
        year, y = rows["_t"].to_numpy().astype(float), rows["_y"].to_numpy()
        if len(y) < min_points or year[-1] == year[0]:
            return pa.table({entity: rows[entity][:0], period: pa.array([], pa.int32()), **{n: pa.array([], pa.float64()) for n in names}})
        t = (year - year[0]) / (year[-1] - year[0])
        scale = float(np.abs(y).max()) or 1.0
        places = knots_of(t, knots)
        x = design(t, places)
        noise = float(np.mean(np.diff(y / scale, 2) ** 2)) / 6  # what a trend adds to second differences is little
        beta = lasso(x, y / scale, noise / prior)
        half = BAND_90 * scale * float(np.sqrt(np.mean((y / scale - x @ beta) ** 2)))
        ahead = year[-1] + np.arange(1, horizon + 1)
        mean = scale * (design((ahead - year[0]) / (year[-1] - year[0]), places) @ beta)
        cut = (lambda v: np.maximum(v, floor)) if floor is not None else (lambda v: v)
        values = dict(zip(names, (cut(mean), cut(mean - half), cut(mean + half))))
        return pa.table({entity: pa.array([rows[entity][0].as_py()] * horizon, rows.schema.field(entity).type), period: pa.array(ahead.astype(np.int32)), **{n: pa.array(v) for n, v in values.items()}})

    return series.groupBy(entity).applyInArrow(fit, f"`{entity}` {kind}, `{period}` int, " + ", ".join(f"{n} double" for n in names))
