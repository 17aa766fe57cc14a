from panelkit.operators import quality as q


def rows(df):
    return [(r["check"], r["passed"], r["severity"], r["details"]) for r in df.collect()]


def test_schema_passes(spark):
    df = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "a int, b int")
    assert rows(q.run_suite(df, "t", [q.schema(["a", "b"])])) == [
        ("schema_check", True, "WARNING", "All 2 required columns present, 0 extra")]


def test_null_rate_fails_above_limit(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (None,), (None,)], "a int")
    assert rows(q.run_suite(df, "t", [q.null_rates(["a"], 0.5)])) == [
        ("null_rate[a]", False, "WARNING", "80.0% null (threshold: 50%)")]


def test_duplicates_count_all_members_and_missing_keys(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert rows(q.run_suite(df, "t", [q.duplicates(["k"])]))[0][:2] == ("duplicate_check", False)
    assert "2 duplicate rows" in rows(q.run_suite(df, "t", [q.duplicates(["k"])]))[0][3]


def test_checks_on_absent_or_empty_columns_are_skipped(spark):
    df = spark.createDataFrame([(None, 1.0)], "a string, b double")
    checks = [q.value_range("a", 0), q.value_range("zz", 0), q.freshness("a"), q.freshness("zz"), q.outliers_iqr("b"),
              q.outliers_iqr("zz"), q.numeric_columns(["zz"]), q.null_rates(["zz"])]
    df.cache()
    assert rows(q.run_suite(df, "t", [*checks, q.row_count(5)])) == [("row_count", False, "CRITICAL", "1 rows (minimum: 5)")]


def test_numeric_text(spark):
    df = spark.createDataFrame([("1",), (" 2.5",), ("x",), (None,)], "a string")
    assert rows(q.run_suite(df, "t", [q.numeric_columns(["a"])])) == [("type_check[a]", False, "WARNING", "1 non-numeric values found")]


def test_outliers(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(1e6,)], "v double")
    check = rows(q.run_suite(df, "t", [q.outliers_iqr("v")]))[0]
    assert check[1] is True and check[3].startswith("1 outliers (1.0%)")


def test_gate(spark):
    ok = spark.createDataFrame([(1,)], "a int")
    report = q.combine([q.run_suite(ok, "t", [q.row_count(1)]), q.source_report(spark, "u", False)])
    s = q.summarise(report).first()
    assert (s.total, s.passed, s.failed, s.critical, s.gate_open, s.score_pct) == (2, 1, 1, 1, False, 50.0)
    empty = q.summarise(report.limit(0)).first()
    assert empty.total == 0 and empty.score_pct is None and empty.gate_open


def test_expectations(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "year int, country string")
    s = q.expectation_suite(df, "t", ["year", "country"], ["country"], {"year": (0, 5)}).first()
    assert (s.expectations, s.failed, s.success) == (4, 1, False)
