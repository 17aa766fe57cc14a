"""The standard normal distribution: its share below a number, and the number below which a share lies."""

from __future__ import annotations

from functools import reduce
from math import exp, pi, sqrt

from pyspark.sql import Column, functions as F

# The five-term approximation of the distribution function (error below 1e-7), and the
# rational approximation of its inverse (relative error below 2e-9) for the middle and the tails.
SHARE_AT = 0.2316419
SHARE = [1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530]
MIDDLE_OVER = [-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239]
MIDDLE_UNDER = [-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572]
TAIL_OVER = [-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783]
TAIL_UNDER = [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416]
TAIL = 0.02425


def normal_share(x: float) -> float:
    t = 1 / (1 + SHARE_AT * abs(x))
    beyond = exp(-x * x / 2) / sqrt(2 * pi) * t * reduce(lambda s, c: s * t + c, SHARE)
    return 1 - beyond if x >= 0 else beyond


def normal_quantile(p: Column) -> Column:
    """Of shares from 0 to 1, both excluded; the ends give the numbers at 1e-300 of them."""
    series = lambda c, x: reduce(lambda s, k: s * x + k, c[1:], F.lit(c[0]))
    middle = p - 0.5
    r = middle * middle
    tail = F.sqrt(-2 * F.log(F.greatest(F.least(p, 1 - p), F.lit(1e-300))))
    far = series(TAIL_OVER, tail) / series([*TAIL_UNDER, 1.0], tail)  # below the middle
    return F.when(p < TAIL, far).when(p > 1 - TAIL, -far).otherwise(series(MIDDLE_OVER, r) * middle / series([*MIDDLE_UNDER, 1.0], r))
