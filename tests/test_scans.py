"""The two-pass scan against windows over whole series."""

import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import scans, windows as win


def series(spark, seed, sizes):
    rng, rows = random.Random(seed), []
    for name, n in sizes.items():
        for t in range(n):
            rows.append((name, t * 2 + 1, rng.choice([None, None, 0.0, rng.uniform(-3, 5)]), rng.choice([None, rng.uniform(0, 9)])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "iso_code string, year int, v double, u double")


def both(df, parts):
    got = scans.with_history(df, {"change": "v"}, {"mean": ("u", 5, 2), "short": ("v", 2, 1)}, {"filled": "v"}, parts=parts)
    want = df.withColumns({"change": win.percent_change("v"), "mean": win.rolling_mean("u"), "short": win.rolling_mean("v", 2, 1), "filled": win.fill_both("v")})
    rows = lambda d: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in d.select(*want.columns).fillna(-1e9).collect())
    return rows(got), rows(want)


@pytest.mark.parametrize("seed, sizes, parts", [
    (1, {"A": 400, "B": 3, "C": 1, "D": 30}, 7),
    (2, {"A": 9}, 9),  # ranges of one row: the rows before lie in several of them
    (3, {chr(65 + i): i % 4 for i in range(26)}, 5),
    (4, {"A": 50}, 1),
])
def test_equals_windows_over_whole_series(spark, seed, sizes, parts):
    got, want = both(series(spark, seed, sizes), parts)
    assert got == want


def test_a_long_unknown_stretch_carries_over_many_ranges(spark):
    rows = [("A", t, 4.0 if t in (3, 190) else None, None) for t in range(200)]
    got, want = both(spark.createDataFrame(rows, "iso_code string, year int, v double, u double"), 12)
    assert got == want


def test_no_range_holds_the_long_series(spark):
    df = series(spark, 5, {"A": 5000, "B": 10})
    ranges = scans.in_ranges(df, "iso_code", "year", 8).groupBy("_range").count().collect()
    assert len(ranges) == 8 and max(r["count"] for r in ranges) < 1500


def test_empty(spark):
    df = spark.createDataFrame([], "iso_code string, year int, v double, u double")
    assert scans.with_history(df, {"change": "v"}, {"mean": ("u", 5, 2)}, {"filled": "v"}).collect() == []


def test_other_columns_stay_and_results_replace_columns_of_their_name(spark):
    df = series(spark, 6, {"A": 20}).withColumn("mean", F.lit("old"))
    out = scans.with_history(df, rolling_means={"mean": ("u", 3, 1)}, parts=3)
    assert sorted(out.columns) == sorted(df.columns) and dict(out.dtypes)["mean"] == "double"
