"""The trend with several changes of slope against every possible choice of them."""

import itertools

import numpy as np
import pytest

from panelkit.operators.trend import changepoint_forecast, design, knots_of, lasso


def objective(x, y, beta, penalty):
    return 0.5 * ((y - x @ beta) ** 2).sum() + penalty * np.abs(beta[2:]).sum()


def brute(x, y, penalty):
    """The best over all choices of changed slopes and of their signs."""
    best, k = None, x.shape[1] - 2
    for signs in itertools.product((-1, 0, 1), repeat=k):
        on = [0, 1] + [j + 2 for j, s in enumerate(signs) if s]
        push = np.array([0, 0] + [s for s in signs if s], dtype=float)
        part = np.linalg.lstsq(x[:, on].T @ x[:, on], x[:, on].T @ y - penalty * push, rcond=None)[0]
        beta = np.zeros(k + 2)
        beta[on] = part
        value = objective(x, y, beta, penalty)
        if best is None or value < best[0]:
            best = (value, beta)
    return best


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("penalty", [0.001, 0.05, 1.0])
def test_coordinate_descent_equals_all_choices(seed, penalty):
    rng = np.random.default_rng(seed)
    t = np.linspace(0, 1, 12)
    x = design(t, knots_of(t, 5))
    assert x.shape[1] == 7
    y = rng.normal(size=12) * 0.1 + np.maximum(0, t - 0.4) * rng.normal() + t
    value, want = brute(x, y, penalty)
    got = lasso(x, y, penalty)
    assert objective(x, y, got, penalty) == pytest.approx(value, abs=1e-10)
    assert np.allclose(x @ got, x @ want, atol=1e-4)


def test_a_change_of_slope_is_followed(spark):
    rows = [("A", 2000 + i, 10.0 + i if i < 12 else 22.0 + 3 * (i - 12)) for i in range(20)] + [("B", 2000 + i, 3.0 + 2.0 * i) for i in range(20)]
    rows += [("short", 2000 + i, 1.0) for i in range(9)] + [("flat", 2000 + i, 7.0) for i in range(20)] + [("gap", 2000 + i, None if i % 3 == 1 else float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "iso_code string, year int, co2 double")
    got = {(r.iso_code, r.year): r for r in changepoint_forecast(df).collect()}
    assert {k[0] for k in got} == {"A", "B", "flat", "gap"} and len(got) == 40
    assert got[("A", 2029)].prophet_co2 == pytest.approx(22 + 3 * 17, rel=0.05)  # one slope for all would give about 55
    assert got[("B", 2029)].prophet_co2 == pytest.approx(61.0) and got[("flat", 2025)].prophet_co2 == pytest.approx(7.0)
    assert got[("gap", 2024)].prophet_co2 == pytest.approx(24.0)
    assert all(0 <= r.prophet_lower <= r.prophet_co2 <= r.prophet_upper for r in got.values())


def test_it_does_not_fall_below_the_floor(spark):
    df = spark.createDataFrame([("A", 2000 + i, 20.0 - i) for i in range(20)], "iso_code string, year int, co2 double")
    assert min(r.prophet_lower for r in changepoint_forecast(df).collect()) == 0
    assert min(r.prophet_co2 for r in changepoint_forecast(df, floor=None).collect()) == pytest.approx(-9.0)


def test_empty(spark):
    assert changepoint_forecast(spark.createDataFrame([], "iso_code string, year int, co2 double")).collect() == []
