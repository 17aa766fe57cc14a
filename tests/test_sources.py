import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit import config
from panelkit.plans import jobs
from panelkit.session import scratch_path, shared_dir
from panelkit.sources import readers, writers


def write(path, text):
    path.write_text(text)
    return str(path)


def test_stacked_series_last_table_wins(spark, tmp_path):
    head = ",".join(config.TEMPERATURE_LAYOUT)
    line = lambda y, v: ",".join([str(y)] + ["  0.1"] * 12 + [v] + ["*******"] * 5)
    text = "\n".join(["Title one", head, line(1989, "  9.0"), line(2002, "  0.406"), line(2003, "  0.1"),
                      "Title two", head, line(2002, "  0.569"), line(2004, "*******"), "2005,short"])
    got = {r.year: r.temperature_anomaly for r in readers.read_stacked_series(spark, write(tmp_path / "t.csv", text)).collect()}
    assert got == {2002: 0.569, 2003: 0.1, 2004: None, 2005: None}


def test_stacked_series_over_many_splits(spark, tmp_path):
    """The file is cut into many splits; order of lines still decides."""
    head = ",".join(config.TEMPERATURE_LAYOUT)
    blocks = []
    for k in range(40):
        blocks += [f"Title {k}", head] + [",".join([str(y)] + ["0"] * 12 + [str(k * 100 + y % 100)] + ["0"] * 5) for y in range(2000, 2020)]
    path = write(tmp_path / "t.csv", "\n".join(blocks))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = readers.read_stacked_series(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 4
        got = {r.year: r.temperature_anomaly for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert got == {y: 3900 + y % 100 for y in range(2000, 2020)}


def test_wide_reader_is_tolerant(spark, tmp_path):
    text = "iso_code,country,year,co2,junk\nUSA,United States,1991,5.5,x\n,World,1991,9,x\nWLD,World,1992,9,x\nUSA,United States,1989,1,x\nFRA,France,1990,bad,x\n"
    df = readers.read_wide_panel(spark, write(tmp_path / "w.csv", text))
    assert df.columns == ["country", "year", "iso_code", "co2"]
    assert {(r.iso_code, r.year, r.co2) for r in df.collect()} == {("USA", 1991, 5.5), ("FRA", 1990, None)}


def test_year_matrix(spark, tmp_path):
    text = "ISO3,Name,1989,1990,1991\nAFG,Afghanistan,0.1,,0.5\n"
    df = readers.read_year_matrices(spark, {"score": write(tmp_path / "m.csv", text)})
    assert {(r.iso_code, r.year, r.score) for r in df.collect()} == {("AFG", 1990, None), ("AFG", 1991, 0.5)}


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_json_records_have_nulls(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 0.5)], "k int, v double")
    assert [r.record for r in writers.as_json_records(df).collect()] == ['{"k":1,"v":null}', '{"k":2,"v":0.5}']


def test_snapshot_counts_present_tables(spark):
    base, target = scratch_path(spark, "t"), scratch_path(spark, "t")
    writers.write_stage(spark.range(3), base, "clusters")
    a = writers.snapshot(spark, base, target, version="a").first()
    writers.snapshot(spark, base, target, version="b")
    assert (a.version, a.files_versioned) == ("a", 1)
    assert spark.read.parquet(f"{target}/snapshot_log").count() == 2


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """The whole batch on generated files: 60 countries, 1990-2024, with gaps."""
    data = tmp_path_factory.mktemp("data")
    rng = np.random.default_rng(0)
    codes = list(config.CONTINENT_OF)[:60]
    years = range(1988, 2025)
    lines = ["country,year,iso_code,population,gdp,co2,co2_per_capita,coal_co2,gas_co2,oil_co2,energy_per_capita,other"]
    for i, code in enumerate(codes):
        level, coal = rng.uniform(0.5, 20), rng.uniform(0, 0.7)
        for y in years:
            co2 = level * 10 * (1 + 0.01 * (y - 1990)) * (1 + rng.normal(0, 0.05))
            gdp = "" if y > 2022 else f"{rng.uniform(1, 9) * 1e9:.0f}"
            lines.append(f"Country {i},{y},{code},1e7,{gdp},{co2:.4f},{co2 / 10:.4f},{co2 * coal:.4f},{co2 * 0.1:.4f},{co2 * 0.1:.4f},{rng.uniform(100, 900):.2f},x")
    lines[12] = lines[12].replace(lines[12].split(",")[5], "N/A").replace(lines[12].split(",")[6], "NaN")  # bad values are reported, never raised
    lines += [f"World,{y},,8e9,,999,4,1,1,1,1,x" for y in years]
    (data / jobs.WIDE_FILE).write_text("\n".join(lines))
    row = lambda y: ",".join([str(y)] + ["0.1"] * 12 + [f"{0.02 * (y - 1990):.3f}"] + ["0"] * 5)
    (data / jobs.SERIES_FILE).write_text("\n".join(["Title", ",".join(config.TEMPERATURE_LAYOUT), *map(row, range(1970, 2025))]))
    for f in config.WORLD_BANK_FILES.values():
        (data / f).write_text("\n".join(["FREQ,REF_AREA,TIME_PERIOD,OBS_VALUE"] + [
            f"A,{c},{y},{rng.uniform(1, 99):.2f}" for c in codes for y in range(1990, 2020) if rng.random() > 0.3]))
    for f in config.NDGAIN_FILES.values():
        p = data / jobs.MATRIX_DIR / f
        p.parent.mkdir(parents=True)
        p.write_text("\n".join(["ISO3,Name," + ",".join(map(str, range(1995, 2024)))] + [
            f"{c},Country {i}," + ",".join(f"{rng.uniform(0.2, 0.8):.3f}" for _ in range(1995, 2024)) for i, c in enumerate(codes)]
            + [f"X{k:02d},Extra," + ",".join(["0.5"] * 29) for k in range(60)]))
    base = scratch_path(spark, "built")
    published = jobs.run_all(spark, str(data), base, trees=5)
    return base, {r.table_name: r.n_rows for r in published.collect()}


def test_batch_tables(spark, built):
    base, counts = built
    assert all(n for n in counts.values()), counts
    fact = jobs.table(spark, base, "fact_climate_metrics")
    s = fact.agg(F.count("*"), F.min("year"), F.max("year"), F.count_distinct("iso_code", "year"), F.count_distinct("country_id")).first()
    assert s[0] == s[3] == 60 * 35 and (s[1], s[2], s[4]) == (1990, 2024, 60)
    for c in ("coal_share", "gas_share", "oil_share", "renewables_share", "sustainability_score", "co2_per_capita_5yr_avg"):
        assert fact.filter(F.col(c).isNotNull()).count() > 1000
    assert fact.filter("vulnerability_score is null").count() == 0
    assert jobs.table(spark, base, "dim_country").count() == 60
    assert jobs.table(spark, base, "dim_time").count() == 35


def test_batch_scores_and_texts(spark, built):
    base, _ = built
    risk = jobs.table(spark, base, "risk_scores")
    s = risk.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert 0 <= s[0] <= s[1] <= 100
    recs = jobs.table(spark, base, "recommendations")
    assert recs.count() == 60 and recs.filter("recommendations is null or recommendations = ''").count() == 0
    names = {r.cluster_name for r in jobs.table(spark, base, "clusters").select("cluster_name").distinct().collect()}
    assert names == set(config.CLUSTER_NAMES)
    shap = jobs.table(spark, base, "shap_values")
    assert len([c for c in shap.columns if c.startswith("shap_")]) == 7 and shap.count() == 60
    assert jobs.table(spark, base, "lime_explanations").count() == 15 * 7
    report = {r.section: r.n for r in jobs.table(spark, base, "narrative_report").groupBy("section").agg(F.count("*").alias("n")).collect()}
    assert report == {"global": 7, "highest": 10, "lowest": 5}


def test_batch_forecasts_and_export(spark, built):
    base, _ = built
    fc = jobs.table(spark, base, "forecasts")
    assert fc.count() == 600 and fc.filter("forecast_co2 < 0 or forecast_co2_lower > forecast_co2_upper").count() == 0
    flat = spark.read.option("header", True).csv(f"{base}/final_climate_data")
    assert flat.count() == 60 * 35 + 600
    assert flat.filter("year <= 2024 and risk_score is null").count() == 0
    assert flat.filter("year > 2024 and forecast_co2 is null").count() == 0


def test_batch_stops_on_a_critical_failure(spark, tmp_path):
    gate = jobs.run_all(spark, str(tmp_path), scratch_path(spark, "empty")).first()
    assert gate.gate_open is False and gate.critical == 8


def test_shared_dir_without_the_setting(tmp_path):
    """A local session falls back to its own folder; a cluster session is refused."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
from panelkit import session
spark = session.build_session("bare", "local[2]", **{{"spark.ui.enabled": "false"}})
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert session.shared_dir(spark) == session.shared_dir(spark)
assert session.store_counted(spark.range(5), "t")[1] == 5

class Far:
    class conf:
        get = staticmethod(lambda key, default: default)
    class sparkContext:
        master = "yarn"
try:
    session.shared_dir(Far)
except RuntimeError:
    print("refused")
"""
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "refused" in done.stdout, done.stderr[-2000:]
