"""One case per decided rule, on tiny frames."""

import math

import pytest
from pyspark.sql import functions as F

from panelkit.functions import expressions as x
from panelkit.operators import anomaly, forecast, narrative, quantiles, relational as rel, risk, scenario, windows as win
from panelkit.plans import star


def column(df, expr, order="year"):
    return [r[0] for r in df.select(expr.alias("out"), order).orderBy(order).select("out").collect()]


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


INF = float("inf")


@pytest.mark.parametrize("values, expected", [
    ([1, None, 2, 0, 0, 3], [None, 0, 100, -100, None, INF]),
    ([5, None, None], [None, 0, 0]),
    ([None, 4, 5], [None, None, 25]),
    ([0, -2], [None, -INF]),
])
def test_percent_change(panel, values, expected):
    assert column(panel(values), win.percent_change("v")) == expected


def test_percent_change_stays_within_entity(spark, panel):
    df = panel([1, 2]).unionByName(panel([10, 30], entity="B"))
    out = {(r.iso_code, r.year): r.g for r in df.withColumn("g", win.percent_change("v")).collect()}
    assert out[("A", 2001)] == 100 and out[("B", 2001)] == 200 and out[("B", 2000)] is None


def test_rolling_mean(panel):
    assert column(panel([1, None, 2, 0, 0, 3]), win.rolling_mean("v")) == [None, None, 1.5, 1.0, 0.75, 1.25]


def test_fill_both(panel):
    assert column(panel([None, 3, None, 5, None]), win.fill_both("v")) == [3, 3, 3, 5, 5]
    assert column(panel([None, None]), win.fill_both("v")) == [None, None]


@pytest.mark.parametrize("shares, expected", [((None, None, None), None), ((60, None, 50), 0), ((10, 20, 30), 40), ((None, 25, None), 75)])
def test_residual_share(spark, shares, expected):
    cols = [F.lit(s).cast("double") for s in shares]
    assert one(spark, x.residual_share(*cols)) == expected


def test_min_max_constant_column(spark, panel):
    f = F.lit(4.0)
    assert one(spark, x.min_max_score(f, f, f)) == 50
    assert one(spark, x.min_max_score(F.lit(None).cast("double"), f, f)) is None
    assert one(spark, x.min_max_score(F.lit(3.0), F.lit(1.0), F.lit(5.0), invert=True)) == 50


def test_guarded_ratio(spark):
    assert one(spark, x.guarded_ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, x.guarded_ratio(F.lit(1.0), F.lit(-2.0))) is None
    assert one(spark, x.guarded_ratio(F.lit(1.0), F.lit(4.0))) == 0.25


def test_text_numbers(spark):
    assert one(spark, x.try_number(F.lit("  0.130"))) == 0.13
    assert one(spark, x.try_number(F.lit("*******"))) is None


def test_finite(spark):
    assert one(spark, x.finite(F.lit(INF))) is None
    assert one(spark, x.finite(F.lit(float("nan")))) is None
    assert one(spark, x.finite_or(F.lit(-INF), 0.0)) == 0


@pytest.mark.parametrize("score, category", [(70, "Medium"), (70.1, "High"), (40, "Low"), (40.1, "Medium"), (None, "Unknown")])
def test_risk_category(spark, score, category):
    assert one(spark, x.risk_category(F.lit(score).cast("double"))) == category


@pytest.mark.parametrize("growth, word", [
    (5, "increasing"), (5.1, "rapidly increasing"), (1, "stable"), (-1, "decreasing"), (-5, "rapidly declining"), (None, "stable")])
def test_trend_word(spark, growth, word):
    assert one(spark, x.trend_word(F.lit(growth).cast("double"))) == word


def test_period_parts(spark):
    y = F.lit(1999)
    assert one(spark, x.decade(y)) == 1990
    assert one(spark, x.period_label(y)) == "1990–1999"
    assert str(one(spark, x.first_day(y))) == "1999-01-01"


def test_quartile(spark):
    df = spark.createDataFrame([(float(v),) for v in (4, 1, 3, 2)], "v double")
    assert quantiles.quantile_columns(df, ["v"], {"q": 0.25}).first()["q_v"] == 1.75


@pytest.mark.parametrize("sort_rows", [20, 200, 20000])
def test_quantiles_equal_sorted_interpolation(spark, sort_rows):
    """Few rows to be sorted force passes over ever narrower ranges; one group is hot."""
    import numpy as np
    rng = np.random.default_rng(1)
    data = {"a": np.concatenate([rng.normal(size=3000), np.zeros(2000)]), "b": rng.exponential(size=37), "c": np.array([2.5])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.prob): r.value for r in quantiles.exact_quantiles(df, ["v"], probs, ["g"], sort_rows).collect()}
    for g, vs in data.items():
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile(vs, p), abs=1e-12), (g, p)


def test_quantiles_of_a_hot_group_sort_a_few_values_only(spark):
    """The largest window holds no more values than allowed, whatever the group holds."""
    df = spark.range(60_000).select(F.when(F.col("id") % 50 == 0, "small").otherwise("hot").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 7.0).alias("v"))
    stored, kept = [], quantiles.store

    def watch(table, name):
        out = kept(table, name)
        stored.append((name, out))
        return out

    quantiles.store = watch
    try:
        got = {(r.g, r.prob): r.value for r in quantiles.exact_quantiles(df, ["v"], [0.25, 0.5], ["g"], 500).collect()}
    finally:
        quantiles.store = kept
    last = [t for name, t in stored if name == "ranks"][-1]
    assert last.agg(F.max("n")).first()[0] <= 500 and len([n for n, _ in stored if n == "ranks"]) == 3
    import numpy as np
    rows = df.collect()
    for (g, p), value in got.items():
        assert value == np.quantile([r.v for r in rows if r.g == g], p)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_of_a_value_that_most_rows_share(spark, monkeypatch, by):
    """Each pass narrows a bracket, also if its upper end holds nearly all of it or a value between does."""
    import numpy as np
    rng = np.random.default_rng(2)
    tied = np.where(np.arange(4000) % 500 == 0, rng.normal(size=4000), 7.0)
    data = {"high": tied, "low": -tied, "middle": np.where(rng.random(4000) < 0.1, rng.normal(size=4000), 0.25), "few": rng.integers(0, 5, 4000) / 3.0, "all": rng.normal(size=4000)}
    names = list(data)
    rows = [("a", *map(float, r)) for r in zip(*data.values())] + [("a", *[None] * 4, float("nan"))]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"{n} double" for n in names))
    passes, kept = [], quantiles.store

    def counted(table, name):
        passes.append(name)
        assert passes.count("ranks") < 12
        return kept(table, name)

    monkeypatch.setattr(quantiles, "store", counted)
    probs = [0.0, 0.001, 0.3, 0.5, 0.999, 1.0]
    for lower, method in ((False, "linear"), (True, "lower")):
        got = {(r.metric, r.prob): r.value for r in quantiles.exact_quantiles(df, names, probs, by, 100, lower).collect()}
        assert len(got) == len(names) * len(probs)
        for (c, p), value in got.items():
            want = np.sort(data[c])[int(np.floor(p * 3999))] if method == "lower" else np.quantile(data[c], p)
            assert value == pytest.approx(want, abs=1e-12), (c, p, lower)
        passes.clear()


def test_lower_quantiles_are_values_of_the_column(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 4, 2, 3, 9]], "v double")
    got = {r.prob: r.value for r in quantiles.exact_quantiles(df, ["v"], [0.0, 0.3, 0.5, 1.0], lower=True).collect()}
    assert got == {0.0: 1.0, 0.3: 2.0, 0.5: 3.0, 1.0: 9.0}


def test_dense_key_over_many_ranges(spark):
    names = [f"k{i * 7919 % 5000:05d}" for i in range(5000)]
    df = spark.createDataFrame([(n,) for n in names + names[:100]], "k string")
    got = {r.k: r.id for r in rel.dense_key(df, "k", "id").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(set(names)))}


def test_attach_broadcast_and_merged_agree(spark):
    """Most rows are equal and have one key; the plan follows the key table's size."""
    big = spark.createDataFrame([("hot", 1) if i % 3 else (f"k{i}", i) for i in range(300)], "k string, v int")
    small = big.groupBy("k").agg(F.sum("v").alias("s")).filter("k <> 'k0'")
    expected = sorted(map(str, rel.attach(big, small, ["k"]).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how, rows in (("left", 300), ("inner", 299)):
            assert rel.attach(big, small, ["k"], how).count() == rows
        assert sorted(map(str, rel.attach(big, small, ["k"]).select("k", "v", "s").collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_dirty_column_has_quantiles(spark):
    df = spark.createDataFrame([(v,) for v in ["1", "2", "3", "N/A", "NaN", "1d", None]], "v string")
    assert quantiles.exact_quantiles(df, ["v"], [0.5]).first()["value"] == 2.0


def test_stored_tables_go_with_their_owner(spark):
    from panelkit.session import owned_tables, scratch_path, store
    from panelkit.sources.readers import path_exists
    with owned_tables(spark):
        assert store(spark.range(3), "kept").count() == 3
        path = scratch_path(spark, "own")
        spark.range(2).write.parquet(path)
        assert path_exists(spark, path)
    assert not path_exists(spark, path)


def test_attach_an_empty_key_table(spark):
    big = spark.createDataFrame([("a", 1)], "k string, v int")
    empty = big.filter("v > 5").groupBy("k").agg(F.sum("v").alias("s"))
    assert [(r.k, r.s) for r in rel.attach(big, empty, ["k"]).collect()] == [("a", None)]
    assert rel.attach(big, empty, ["k"], "inner").count() == 0


def test_keep_one_and_bottom_ranking(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 6.0), ("b", 1, None)], "iso_code string, year int, v double")
    assert [r.v for r in rel.keep_one(df, ["iso_code"], [F.desc("year")]).orderBy("iso_code").collect()] == [6.0, None]
    assert [r.v for r in rel.ranked(df, "v").collect()] == [6.0, 5.0, None]
    assert [r.v for r in rel.bottom_k(df, "v", 2).collect()] == [None, 5.0]


def test_full_outer_keeps_all_keys(spark):
    a = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0)], "iso_code string, year int, a double")
    b = spark.createDataFrame([("B", 1, 3.0), ("C", 2, 4.0)], "iso_code string, year int, b double")
    got = {(r.iso_code, r.year): (r.a, r.b) for r in rel.full_outer([a, b]).collect()}
    assert got == {("A", 1): (1.0, None), ("B", 1): (2.0, 3.0), ("C", 2): (None, 4.0)}


def test_wide_to_long_without_year_columns(spark):
    df = spark.createDataFrame([("AFG", "Afghanistan", 0.5, 1)], "ISO3 string, Name string, Value double, sign int")
    assert rel.wide_to_long(df, ["ISO3", "Name"], "v").count() == 0


def test_last_known_may_be_older(panel):
    r = forecast.last_known(panel([1, 3, None], "co2"), {"co2": "last_co2"}).first()
    assert (r.last_co2, r.last_historical_year) == (3, 2002)


def test_spikes_of_the_documented_series(spark):
    df = spark.createDataFrame([("TST", y, float(v)) for y, v in zip(range(2018, 2023), (100, 105, 200, 110, 115))],
                               "iso_code string, year int, co2 double")
    rows = anomaly.yoy_spikes(df, 50).collect()
    assert [(r.year, r.spike_direction) for r in rows] == [(2020, "SPIKE_UP")]
    assert rows[0].co2_yoy_pct == pytest.approx(90.476, abs=1e-3)


def test_zero_base_is_a_spike(panel):
    assert [r.co2_yoy_pct for r in anomaly.yoy_spikes(panel([0, 3], "co2")).collect()] == [INF]


RISK = ("iso_code string, country string, year int, risk_score double, co2_per_capita double, renewables_share double, "
        "coal_share double, sustainability_score double")


def test_scenario(spark):
    df = spark.createDataFrame([
        ("IND", "India", 2023, 60.0, 2.0, 20.0, 60.0, -40.0), ("IND", "India", 2022, 10.0, 1.0, 1.0, 1.0, 0.0),
        ("USA", "United States", 2023, 30.0, 15.0, 95.0, 3.0, 92.0), ("XXX", "Nowhere", 2023, None, None, None, None, None)], RISK)
    req = spark.createDataFrame([("IND", 20.0, 15.0), ("USA", 0.0, 0.0), ("USA", 0.0, 10.0), ("XXX", 10.0, 10.0), ("ZZZ", 1.0, 1.0)],
                                "iso_code string, emission_reduction_pct double, renewables_increase_pct double")
    out = {(r.iso_code, r.emission_reduction_pct, r.renewables_increase_pct): r for r in scenario.simulate(df, req).collect()}
    ind = out[("IND", 20.0, 15.0)]
    assert (ind.sim_risk_score, ind.risk_delta, ind.sim_co2_per_capita, ind.sim_renewables_share, ind.sim_coal_share) == (46.5, -13.5, 1.6, 35.0, 52.5)
    assert ind.sim_risk_score <= ind.risk_score
    assert out[("USA", 0.0, 0.0)].risk_delta == 0 and out[("USA", 0.0, 0.0)].sim_risk_score == 30.0
    usa = out[("USA", 0.0, 10.0)]
    assert (usa.sim_renewables_share, usa.sim_coal_share, usa.sim_sustainability_score) == (100.0, 0.0, 100.0)
    assert out[("XXX", 10.0, 10.0)].sim_risk_score is None and out[("XXX", 10.0, 10.0)].sim_renewables_share is None
    assert [r.error for r in scenario.rejected(req, df).collect()] == ["Country ZZZ not found"]


def test_scenario_forecast_phases_in(spark):
    sim = spark.createDataFrame([("A", 2020, 50.0, 0.0)], "iso_code string, latest_year int, emission_reduction_pct double, renewables_increase_pct double")
    fc = spark.createDataFrame([("A", y, 100.0) for y in (2020, 2021, 2025, 2030)], "iso_code string, year int, forecast_co2 double")
    got = {r.year: r.forecast_co2_simulated for r in scenario.simulate_forecast(fc, sim).collect()}
    assert got == {2020: 100.0, 2021: 90.0, 2025: 50.0, 2030: 50.0}


TEXT = ("iso_code string, country string, year int, risk_score double, co2_per_capita double, coal_share double, renewables_share double, "
        "vulnerability_score double, temperature_anomaly double, co2_growth_rate double, energy_intensity double")


def test_narrative(spark):
    df = spark.createDataFrame([
        ("TST", "TestCountry", 2023, 75.0, 12.5, 45.0, 10.0, 0.6, 1.2, 3.5, 0.1),
        ("NIL", "Nulland", 2023, None, None, None, None, None, None, None, None)], TEXT)
    text = {r.iso_code: r.narrative for r in narrative.narratives(df).collect()}
    assert len(text["TST"]) > 50 and "TestCountry" in text["TST"] and "high" in text["TST"].lower()
    assert "increasing (+3.5%)" in text["TST"] and text["TST"].endswith("protection from climate damage.")
    assert text["NIL"] == "Nulland has no risk score for 2023."


def test_recommendations(spark):
    df = spark.createDataFrame([
        ("A", "A", 2023, 75.0, 12.5, 45.0, 10.0, 0.6, 1.2, 3.5, 0.6), ("B", "B", 2023, None, 1.0, 0.0, 50.0, 0.1, 0.0, 0.0, 0.0)], TEXT)
    recs = risk.recommendations(df).collect()
    assert [r.iso_code for r in recs] == ["A", "B"]
    assert len(recs[0].recommendations.split(" | ")) == 6
    assert recs[1].recommendations.startswith("No rule applies")
    items = risk.recommendation_items(risk.recommendations(df)).filter("iso_code = 'A'").count()
    assert items == 6


def test_heuristic_ignores_weight_of_empty_columns(spark):
    df = spark.createDataFrame([("A", 1, 0.0, None), ("B", 1, 10.0, None)], "iso_code string, year int, co2_per_capita double, coal_share double")
    got = {r.iso_code: r.risk_score_heuristic for r in risk.heuristic_score(df).collect()}
    assert got == {"A": 0.0, "B": 100.0}


def test_heuristic_missing_scores_fifty(spark):
    df = spark.createDataFrame([("A", 0.0), ("B", 10.0), ("C", None)], "iso_code string, co2_per_capita double")
    assert {r.iso_code: r.risk_score_heuristic for r in risk.heuristic_score(df).collect()}["C"] == 50.0


def test_cross_sectional_limits(spark):
    many = [(f"E{i:03d}", "x", 2000, 1.0 + (i % 2)) for i in range(40)] + [("OUT", "x", 2000, 90.0)]
    few = [(f"E{i}", "x", 2001, 1.0) for i in range(10)] + [("OUT", "x", 2001, 1e6)]
    flat = [(f"E{i:03d}", "x", 2002, 3.0) for i in range(40)]
    df = spark.createDataFrame(many + few + flat, "iso_code string, country string, year int, co2_per_capita double")
    out = anomaly.cross_sectional_outliers(df).collect()
    assert [(r.iso_code, r.year, r.metric) for r in out] == [("OUT", 2000, "co2_per_capita")]


def test_duplicate_inputs_do_not_distort_the_fact(spark):
    cols = "iso_code string, country string, year int, co2 double, co2_per_capita double, population double, gdp double, energy_per_capita double, coal_co2 double, gas_co2 double, oil_co2 double"
    row = lambda y, v: ("A", "Aland", y, v, v, 1.0, 1.0, 1.0, v / 2, None, None)
    wide = spark.createDataFrame([row(2000, 1.0), row(2000, 1.0), row(2001, 2.0), row(2002, 4.0)], cols)
    temp = spark.createDataFrame([(2000, 0.5), (2000, 0.7)], "year int, temperature_anomaly double")
    wb = spark.createDataFrame([("A", 2001, 7.0), ("A", 2001, 7.0)], "iso_code string, year int, electricity_access_pct double")
    out = star.build_fact(wide, temp, wb).orderBy("year").collect()
    assert [r.year for r in out] == [2000, 2001, 2002]
    assert [r.co2_growth_rate for r in out] == [None, 100, 100]
    assert [r.electricity_access_pct for r in out] == [7.0, 7.0, 7.0]
    assert out[0].coal_share == 50 and out[0].renewables_share == 50 and out[0].sustainability_score == 0


def test_dim_country_built_in_lookups(spark):
    df = spark.createDataFrame([("USA", 2000, "United States"), ("ABW", 2000, "Aruba"), ("ABW", 1999, None)], "iso_code string, year int, country string")
    got = {r.iso_code: r for r in star.build_dim_country(df).collect()}
    assert (got["USA"].continent, got["USA"].income_group, got["USA"].country_id) == ("North America", "High", 2)
    assert (got["ABW"].continent, got["ABW"].income_group, got["ABW"].country_name) == ("Other", "Unknown", "Aruba")


def test_growth_is_nan_free(panel):
    out = column(panel([0, 0, 1]), win.percent_change("v"))
    assert not any(v is not None and math.isnan(v) for v in out)
