"""Models against brute force or against what must hold for any correct result."""

import itertools
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import cluster, density, explain, forecast, isolation_forest as forest, risk_model, silhouette


def frame(spark, x, names=None, extra=None):
    names = names or [f"f{i}" for i in range(x.shape[1])]
    rows = [(f"p{i:04d}", *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "iso_code string, " + ", ".join(f"{n} double" for n in names)), names


def brute_dbscan(x, eps, m):
    near = [np.flatnonzero(((x - p) ** 2).sum(axis=1) <= eps * eps) for p in x]
    core = [len(n) >= m for n in near]
    labels, number = [-1] * len(x), 0
    for i in range(len(x)):
        if not core[i] or labels[i] >= 0:
            continue
        stack = [i]
        labels[i] = number
        while stack:
            for j in near[stack.pop()]:
                if labels[j] < 0:
                    labels[j] = number
                    if core[j]:
                        stack.append(j)
        number += 1
    return labels


def blobs(seed, d, n=150):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-4, 4, size=(4, d))
    parts = [c + rng.normal(scale=s, size=(n // 5, d)) for c, s in zip(centres, (0.2, 0.4, 0.6, 0.05))]
    return np.concatenate([*parts, rng.uniform(-6, 6, size=(n // 5, d)), np.repeat(centres[:1], 12, axis=0)])


@pytest.mark.parametrize("seed, d, eps", [(1, 2, 0.5), (4, 5, 1.2)])
def test_dbscan_of_pairs_equals_brute_force(spark, seed, d, eps):
    x = blobs(seed, d)
    df, names = frame(spark, x)
    got = {r.iso_code: r.dbscan_cluster for r in density.dbscan(df, names, eps).collect()}
    assert [got[f"p{i:04d}"] for i in range(len(x))] == brute_dbscan(x, eps, 5)


@pytest.mark.parametrize("seed, d, eps, direct", [(2, 3, 0.8, None), (3, 2, 0.6, 0)])
def test_dbscan_on_grid_equals_brute_force(spark, monkeypatch, seed, d, eps, direct):
    """``direct = 0`` forbids point comparisons, so every question is settled on halved boxes."""
    monkeypatch.setattr(density, "PAIR_WORK", 0)
    if direct is not None:
        monkeypatch.setattr(density, "DIRECT_WORK", direct)
    x = blobs(seed, d)
    if direct == 0:
        x = x[:60]
    df, names = frame(spark, x)
    got = {r.iso_code: r.dbscan_cluster for r in density.dbscan(df, names, eps).collect()}
    assert [got[f"p{i:04d}"] for i in range(len(x))] == brute_dbscan(x, eps, 5)


def test_dbscan_chain_is_one_cluster(spark):
    x = np.array([[0.1 * i, 0.0] for i in range(120)])
    df, names = frame(spark, x)
    assert {r.dbscan_cluster for r in density.dbscan(df, names, 0.35).collect()} == {0}


@pytest.mark.parametrize("pair_work", [0, 1000])
def test_dbscan_of_noise_only(spark, monkeypatch, pair_work):
    monkeypatch.setattr(density, "PAIR_WORK", pair_work)
    df, names = frame(spark, np.array([[10.0 * i, 0.0] for i in range(8)]))
    assert [r.dbscan_cluster for r in density.dbscan(df, names, 0.5).collect()] == [-1] * 8


def test_dbscan_many_copies_of_one_point(spark, monkeypatch):
    monkeypatch.setattr(density, "PAIR_WORK", 0)
    x = np.concatenate([np.zeros((400, 2)), np.array([[0.3, 0.0], [5.0, 5.0]])])
    df, names = frame(spark, x)
    got = {r.iso_code: r.dbscan_cluster for r in density.dbscan(df, names, 0.5).collect()}
    assert got["p0000"] == 0 and got["p0400"] == 0 and got["p0401"] == -1


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i, l in enumerate(labels):
        same = labels == l
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == k].mean() for k in set(labels) if k != l)
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("block", [16, 4096])
def test_silhouette_equals_brute_force(spark, block):
    """Small blocks split the large cluster and pack the small ones."""
    rng = np.random.default_rng(0)
    labels = np.array([0] * 60 + [1] * 9 + [2] * 8 + [3] * 5 + [4])
    x = rng.normal(size=(len(labels), 3)) + labels[:, None]
    rows = [(f"p{i:04d}", *map(float, r), int(l)) for i, (r, l) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, "iso_code string, f0 double, f1 double, f2 double, label int")
    got = {r.iso_code: r.s for r in silhouette.silhouette_values(df, ["f0", "f1", "f2"], "label", block=block).collect()}
    want = brute_silhouette(x, labels)
    assert np.allclose([got[f"p{i:04d}"] for i in range(len(x))], want)
    assert silhouette.silhouette(df, ["f0", "f1", "f2"], "label", block=block) == pytest.approx(want.mean())
    assert -1 <= silhouette.squared_silhouette(df, ["f0", "f1", "f2"], "label") <= 1


@pytest.mark.parametrize("block, bundle", [(4, 16), (8, 8), (16, 64), (4, 4096)])
def test_small_blocks_meet_in_bundles(spark, monkeypatch, block, bundle):
    """The same sums, also if bundles mix parts of large clusters and whole small ones; far fewer rows than points by blocks."""
    monkeypatch.setattr(silhouette, "BUNDLE", bundle)
    rng = np.random.default_rng(5)
    labels = np.array([0] * 70 + [1] * 50 + [2] * 9 + [3] * 5 + [4, 5, 6, 6])
    x = rng.normal(size=(len(labels), 2)) + labels[:, None] % 4
    df = spark.createDataFrame([(f"p{i:04d}", *map(float, r), int(l)) for i, (r, l) in enumerate(zip(x, labels))], "iso_code string, f0 double, f1 double, label int")
    got = {r.iso_code: r.s for r in silhouette.silhouette_values(df, ["f0", "f1"], "label", block=block).collect()}
    assert np.allclose([got[f"p{i:04d}"] for i in range(len(x))], brute_silhouette(x, labels))
    if bundle == 4096:
        made = []
        monkeypatch.setattr(silhouette, "store", lambda df, name, keep=silhouette.store: made.append((name, keep(df, name))) or made[-1][1])
        silhouette.silhouette_values(df, ["f0", "f1"], "label", block=block)
        assert made[-1][1].count() == 1  # one tile; each pair of 36 blocks was one


@pytest.fixture(scope="module")
def fact(spark):
    """60 entities x 30 years with the columns the models use."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        level, coal = rng.uniform(1, 20), rng.uniform(0, 80)
        co2 = 100 * level
        for t in range(30):
            co2 = max(co2 * (1 + rng.normal(0.01, 0.05)), 1.0)
            pc = level * (1 + 0.01 * t) + rng.normal(0, 0.3)
            ren = max(0.0, 90 - coal + rng.normal(0, 3))
            vul = 0.7 - 0.02 * level + 0.001 * coal + rng.normal(0, 0.01)
            rows.append((f"C{i:02d}", f"Country {i}", 1995 + t, float(co2), float(pc), float(rng.normal(1, 4)), float(coal),
                         float(ren), float(rng.uniform(0, 1)), 0.02 * t, float(ren - coal), float(vul), float(1 - vul)))
    return spark.createDataFrame(rows, "iso_code string, country string, year int, co2 double, co2_per_capita double, co2_growth_rate double, "
                                 "coal_share double, renewables_share double, energy_intensity double, temperature_anomaly double, "
                                 "sustainability_score double, vulnerability_score double, readiness_score double").cache()


@pytest.fixture(scope="module")
def trained(fact):
    return risk_model.train(fact, trees=8, depth=4)


def test_risk_model(spark, fact, trained):
    model, metrics, features = trained
    m = metrics.first()
    assert m.train_rows == 1800 and 0.5 < m.train_r2 <= 1 and "vulnerability_score" not in features
    rows, _, _, _ = risk_model.score_all(fact, trees=4)
    s = rows.agg(F.min("risk_score"), F.max("risk_score"), F.count_if(F.col("risk_score").isNull())).first()
    assert 0 <= s[0] and s[1] <= 100 and s[2] == 0


def test_risk_model_needs_rows(fact):
    model, metrics, _ = risk_model.train(fact.limit(50))
    assert model is None and metrics is None
    rows, none, _, _ = risk_model.score_all(fact.limit(50))
    assert none is None and "risk_score" in rows.columns


def test_shapley_adds_up_to_the_prediction(fact, trained):
    model, _, features = trained
    shap = {(r.iso_code, r.year): r for r in explain.shapley_values(fact, model, features, ["iso_code", "year"]).collect()}
    raw = {(r.iso_code, r.year): r.prediction for r in model.predict(fact).collect()}
    for k, r in shap.items():
        assert r.base_value + sum(r[f"shap_{f}"] for f in features) == pytest.approx(raw[k], abs=1e-6)


def test_shapley_equals_the_definition(fact, trained):
    """Against the sum over all coalitions, with the tree walked once per coalition."""
    model, _, features = trained
    x = np.array(fact.select(*features).limit(3).collect(), dtype=float)

    def value(row, known):
        def walk(nodes, n):
            if n.feature < 0:
                return n.value
            left, right = nodes[n.left], nodes[n.right]
            if n.feature in known:
                return walk(nodes, left if row[n.feature] <= n.cut else right)
            return (left.rows * walk(nodes, left) + right.rows * walk(nodes, right)) / n.rows
        return model.base + sum(walk(t, t[0]) for t in model.trees)

    k = len(features)
    leaves, base = explain.leaves_of(model)
    got = explain._attribute(x, leaves)
    for row, phi in zip(x, got):
        assert base == pytest.approx(value(row, set()))
        for i in range(k):
            want = 0.0
            for size in range(k):
                for s in itertools.combinations([j for j in range(k) if j != i], size):
                    w = factorial(size) * factorial(k - size - 1) / factorial(k)
                    want += w * (value(row, {*s, i}) - value(row, set(s)))
            assert phi[i] == pytest.approx(want, abs=1e-8)


def test_importance_is_ranked(fact, trained):
    model, _, features = trained
    imp = explain.feature_importance(explain.shapley_values(fact, model, features), features).collect()
    values = [r.importance for r in imp]
    assert len(imp) == len(features) and values == sorted(values, reverse=True)
    assert imp[0].feature == "co2_per_capita"


def test_local_rules(fact, trained):
    model, _, features = trained
    latest = fact.filter("year = 2024")
    run = lambda: sorted((r.iso_code, r.feature_rule, round(r.lime_weight, 9)) for r in
                         explain.local_rules_for_top(latest, model, features, n=4, samples=400).collect())
    rows = run()
    assert rows == run()
    assert len(rows) == 4 * len(features)
    by = latest.orderBy(F.desc("vulnerability_score")).limit(4).select("iso_code").collect()
    assert {r[0] for r in rows} == {r.iso_code for r in by}
    strongest = {}
    for iso, rule, w in rows:
        if abs(w) > abs(strongest.get(iso, ("", 0))[1]):
            strongest[iso] = (rule, w)
    assert all("co2_per_capita" in rule and w > 0 for rule, w in strongest.values())


def test_isolation_forest(spark, fact):
    odd = spark.createDataFrame([("ZZZ", "Odd", 2000, 1.0, 900.0, 900.0, 99.0, 0.0, 80.0, 9.0, -99.0, 0.5, 0.5)], fact.schema)
    run = lambda: {(r.iso_code, r.year): (r.anomaly_score, r.is_anomaly) for r in forest.isolation_forest(fact.unionByName(odd), trees=40).collect()}
    got = run()
    assert got == run()
    share = sum(f for _, f in got.values()) / len(got)
    assert share == pytest.approx(0.05, abs=0.005)
    assert min(got, key=lambda k: got[k][0]) == ("ZZZ", 2000)
    assert all((s < 0) == bool(f) for s, f in got.values())


def test_isolation_forest_needs_features(fact):
    assert forest.isolation_forest(fact.select("iso_code", "year", "co2_per_capita"), trees=2).count() == 0


def test_average_depth():
    assert float(forest.average_depth(1)) == 0 and float(forest.average_depth(2)) == 1
    assert float(forest.average_depth(256)) == pytest.approx(10.244, abs=1e-3)


def test_clusters(fact):
    clusters, comparison = cluster.cluster_entities(fact, restarts=2, eps_values=[0.7, 1.5])
    rows = clusters.collect()
    assert len(rows) == 60 and {r.cluster_name for r in rows} == {"Green Economies", "Transition Economies", "High Emitters"}
    med = {n: np.median([r.co2_per_capita for r in rows if r.cluster_name == n]) for n in {r.cluster_name for r in rows}}
    assert med["Green Economies"] <= med["Transition Economies"] <= med["High Emitters"]
    assert all(-1 <= r.silhouette_score <= 1 for r in comparison.collect())
    assert [r.chosen for r in comparison.collect()] == [True, False]


def test_too_few_entities_to_cluster(fact):
    clusters, comparison = cluster.cluster_entities(fact.filter("iso_code < 'C05'"))
    assert clusters.count() == 0 and comparison.count() == 0


def test_forecasts(fact):
    rows = forecast.forecasts(fact, trees=3).collect()
    assert len(rows) == 60 * 10 and {r.model_used for r in rows} == {"trend+pooled trees+AR(1) on differences+pooled linear"}
    for r in rows:
        parts = [r.prophet_co2, r.lstm_co2, r.arima_co2, r.np_co2]
        assert min(parts) - 1e-9 <= r.forecast_co2 <= max(parts) + 1e-9
        assert 0 <= r.forecast_co2_lower <= r.forecast_co2 <= r.forecast_co2_upper
        assert 2025 <= r.year <= 2034 and r.last_historical_year == 2024
        assert r.forecast_temp_anomaly == pytest.approx(0.02 * (r.year - 1995), abs=0.02)


def test_short_series_use_fewer_models(spark):
    rows = [("A", "A", 2000 + i, 10.0 + i % 3, 1.0) for i in range(12)] + [("B", "B", 2000 + i, 5.0 + i, 1.0) for i in range(5)]
    rows += [("C", "C", 2000 + i, 20.0 + (i * 7) % 5, 1.0) for i in range(20)]
    df = spark.createDataFrame([r + (0.1 * (r[2] - 2000),) for r in rows], "iso_code string, country string, year int, co2 double, co2_per_capita double, temperature_anomaly double")
    used = {r.iso_code: r.model_used for r in forecast.forecasts(df, trees=2).select("iso_code", "model_used").distinct().collect()}
    assert used == {"A": "trend+AR(1) on differences", "C": "trend+pooled trees+AR(1) on differences+pooled linear"}


def test_trend_of_a_straight_line(spark):
    df = spark.createDataFrame([("A", 2000 + i, 3.0 + 2.0 * i) for i in range(20)], "iso_code string, year int, co2 double")
    got = {r.year: r.prophet_co2 for r in forecast.trend_forecast(df).collect()}
    assert got[2020] == pytest.approx(43.0) and got[2029] == pytest.approx(61.0)


def kalman_likelihood(d, phi):
    """-2 log likelihood of differences by the filter's recursion, the error variance taken out."""
    state, variance, total, squares = 0.0, 1 / (1 - phi * phi), 0.0, 0.0
    for x in d:
        total += np.log(variance)
        squares += (x - state) ** 2 / variance
        state, variance = phi * x, 1.0
    return total + len(d) * np.log(squares / len(d)), squares / len(d)


@pytest.mark.parametrize("phi", [-0.6, 0.0, 0.3, 0.95])
def test_differences_are_fitted_as_a_filter_fits_them(spark, phi):
    rng = np.random.default_rng(int(100 * abs(phi)))
    d = [rng.normal()]
    for _ in range(24):
        d.append(phi * d[-1] + rng.normal())
    y = 100 + np.concatenate([[0], np.cumsum(d)])
    df = spark.createDataFrame([("A", 2000 + i, float(v)) for i, v in enumerate(y)], "iso_code string, year int, co2 double")
    grid = np.linspace(-0.9999, 0.9999, 40001)
    best = min(grid, key=lambda p: kalman_likelihood(d, p)[0])
    variance, level, step, spread, weights = kalman_likelihood(d, best)[1], y[-1], d[-1], 0.0, 0.0
    for h, r in enumerate(sorted(forecast.difference_forecast(df).collect(), key=lambda r: r.year), 1):
        step *= best
        level += step
        weights = 1 + best * weights  # what one error adds to the level h steps on
        spread += weights * weights
        assert r.arima_co2 == pytest.approx(max(level, 0), abs=0.02)
        assert r.arima_upper - r.arima_co2 == pytest.approx(1.645 * np.sqrt(variance * spread), rel=2e-3)


def test_constant_series(spark):
    df = spark.createDataFrame([("A", 2000 + i, 7.0) for i in range(20)], "iso_code string, year int, co2 double")
    assert {r.arima_co2 for r in forecast.difference_forecast(df).collect()} == {7.0}
    assert forecast.lag_table(df).count() == 0


def test_workers_need_no_package_on_their_path(tmp_path):
    """From another folder, with the package on the driver's path only."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
from panelkit.session import build_session
spark = build_session("far", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
import __spark_entry__ as e
for name in ("anomaly_isolation_forest", "explain_shapley", "cluster_silhouette"):
    assert e.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


@pytest.mark.parametrize("r2, better", [(0.42, True), (0.01, True), (1.0, True), (0.0, False), (1e-14, False), (-0.2, False)])
def test_fit_is_better_than_the_mean_above_zero(spark, monkeypatch, r2, better):
    """R2 of 0 is what the mean reaches; a weak fit of noisy rows still lies above."""
    from checks import models
    told = spark.createDataFrame([(200, 5, 0.1, "a", 500, r2)], "trees int, depth int, rate double, features string, train_rows long, train_r2 double")
    monkeypatch.setattr(models, "stored_fact", lambda *_: None)
    monkeypatch.setattr(models.risk_model, "train", lambda _: (None, told, ["a"]))
    assert models.risk_model_fit(spark, "").first().better_than_mean is better
