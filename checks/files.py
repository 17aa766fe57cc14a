"""Sources and sinks: files derived from the test tables are written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.panel import INDICATORS, by_period, indicator, lines, stored_fact, table, wide, with_fact, with_sources
from checks.registry import query, r4, rounded
from panelkit import config
from panelkit.plans import star
from panelkit.session import scratch_path, store
from panelkit.sources import readers, versions, writers


def _csv(spark, df: DataFrame, name: str) -> str:
    return writers.write_csv(df, scratch_path(spark, name))


@query("source_wide_csv", with_sources("""
SELECT country, year, iso_code, population, gdp, co2, co2_per_capita, coal_co2, gas_co2, oil_co2, energy_per_capita FROM wide"""))
def source_wide_csv(spark, sf):
    """Extra columns are dropped, aggregate names, early years and rows without a code are left out."""
    rows = wide(spark, sf).withColumn("unused", F.lit("x"))
    world = rows.groupBy("year").agg(F.sum("co2").alias("co2")).withColumn("country", F.lit("World")).withColumn("iso_code", F.lit("WLD"))
    early = rows.filter("year = 1995").withColumn("year", F.col("year") - 100)
    nameless = rows.filter("year = 1996").withColumn("iso_code", F.lit(None).cast("string"))
    path = _csv(spark, rows.unionByName(world, allowMissingColumns=True).unionByName(early).unionByName(nameless), "wide")
    return readers.read_wide_panel(spark, path)


@query("source_stacked_series", with_sources("""
SELECT year, CASE WHEN year <> 1997 THEN round(temperature_anomaly, 3) END AS temperature_anomaly FROM temp"""))
def source_stacked_series(spark, sf):
    """Two tables in one file: the first has other values, the second has one masked value."""
    def block(df, start, title):
        cells = [F.col("year").cast("string")] + [F.lit("  0.5")] * 12 + [F.col("v")] + [F.lit("*******")] * 5
        body = df.select((F.lit(start + 10) + F.col("year")).alias("pos"), F.concat_ws(",", *cells).alias("value"))
        heads = spark.createDataFrame([(start, title), (start + 1, ",".join(config.TEMPERATURE_LAYOUT))], "pos int, value string")
        return heads.unionByName(body)
    t = by_period(spark, sf)
    shown = F.format_string("  %s", F.round("temperature_anomaly", 3).cast("string"))
    first = t.select("year", F.lit("  9.999").alias("v"))
    last = t.select("year", F.when(F.col("year") == 1997, "*******").otherwise(shown).alias("v"))
    path = scratch_path(spark, "series")
    both = block(first, 0, "Table one").unionByName(block(last, 100000, "Table two"))
    both.coalesce(1).sortWithinPartitions("pos").select("value").write.text(path)  # one file of a few lines
    return readers.read_stacked_series(spark, path)


@query("source_indicators", with_sources(f"""
SELECT coalesce(a.iso_code, b.iso_code, c.iso_code) AS iso_code, coalesce(a.year, b.year, c.year) AS year, {r4(*INDICATORS)}
FROM {{0}} a FULL JOIN {{1}} b ON a.iso_code = b.iso_code AND a.year = b.year
FULL JOIN {{2}} c ON coalesce(a.iso_code, b.iso_code) = c.iso_code AND coalesce(a.year, b.year) = c.year""".format(*[
    f"(SELECT iso_code, year, CAST(sum({v}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS {n} FROM li WHERE {c} GROUP BY iso_code, year)"
    for n, (c, v, _) in INDICATORS.items()]), "month"))
def source_indicators(spark, sf):
    files = {}
    for name in INDICATORS:
        long = indicator(spark, sf, name, "month").select(
            F.lit("x").alias("STRUCTURE"), F.col("iso_code").alias("REF_AREA"), F.col("year").alias("TIME_PERIOD"), F.col(name).alias("OBS_VALUE"))
        files[name] = _csv(spark, long, "indicator")
    return rounded(readers.read_indicators(spark, files))


@query("source_year_matrices", with_sources(f"""
SELECT iso_code, year, {r4('ndgain_score', 'vulnerability_score')} FROM (SELECT DISTINCT iso_code FROM li) CROSS JOIN (SELECT DISTINCT year FROM li)
LEFT JOIN nd USING (iso_code, year)"""))
def source_year_matrices(spark, sf):
    from checks.panel import scores
    files = {}
    every = lines(spark, sf).select("iso_code", "year").distinct()
    for name in ("ndgain_score", "vulnerability_score"):
        m = every.join(scores(spark, sf), ["iso_code", "year"], "left").groupBy(F.col("iso_code").alias("ISO3")).pivot("year").agg(F.first(name))
        files[name] = _csv(spark, m.withColumn("Name", F.col("ISO3")).withColumn("sign", F.lit(1)), "matrix")
    return rounded(readers.read_year_matrices(spark, files))


@query("source_table_or_empty", "SELECT 'present' AS kind, count(*) AS n FROM orders UNION ALL SELECT 'absent', 0")
def source_table_or_empty(spark, sf):
    present = readers.read_table_or_empty(spark, f"{sf}/orders.parquet", "o_orderkey long")
    absent = readers.read_table_or_empty(spark, f"{sf}/returns.parquet", "r_key long")
    count = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(present, "present").unionByName(count(absent, "absent"))


@query("sink_star_schema", with_fact(f"""
SELECT 'fact' AS tbl, year, count(*) AS n, round(sum(CAST(round(co2 * 9973) AS BIGINT))::DOUBLE, 0) AS total FROM fact GROUP BY year
UNION ALL SELECT 'time', decade, count(*), 0 FROM (SELECT DISTINCT year // 10 * 10 AS decade, year FROM fact) GROUP BY decade"""))
def sink_star_schema(spark, sf):
    f = stored_fact(spark, sf)
    paths = writers.write_star({
        "fact_climate_metrics": f, "dim_time": star.build_dim_time(f), "dim_energy_type": star.build_dim_energy_type(spark)},
        scratch_path(spark, "star"))
    back = spark.read.parquet(paths["fact_climate_metrics"])
    a = back.groupBy("year").agg(F.count("*").alias("n"), F.sum(F.round(F.col("co2") * 9973).cast("long")).cast("double").alias("total"))
    t = spark.read.parquet(paths["dim_time"]).groupBy(F.col("decade").alias("year")).agg(F.count("*").alias("n")).withColumn("total", F.lit(0.0))
    return a.select(F.lit("fact").alias("tbl"), "year", "n", "total").unionByName(t.select(F.lit("time").alias("tbl"), "year", "n", "total"))


@query("sink_stage_tables", """
SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus""")
def sink_stage_tables(spark, sf):
    """Written twice: the second write replaces the first."""
    base = scratch_path(spark, "stage")
    orders = table(spark, sf, "orders")
    writers.write_stage(orders.select("o_orderkey", "o_orderstatus"), base, "orders")
    path = writers.write_stage(orders.select("o_orderkey", "o_orderstatus"), base, "orders")
    return spark.read.parquet(path).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query("sink_snapshot", "SELECT 'v1' AS version, 2 AS files_versioned, (SELECT count(*) FROM customer) AS dim_rows")
def sink_snapshot(spark, sf):
    base, target = scratch_path(spark, "stage"), scratch_path(spark, "snapshots")
    writers.write_stage(table(spark, sf, "customer"), base, "dim_country")
    writers.write_stage(table(spark, sf, "nation"), base, "dim_time")
    record = writers.snapshot(spark, base, target, version="v1")
    rows = versions.read_version(spark, target, "dim_country", "v1").agg(F.count("*").alias("dim_rows")).first()[0]
    return record.select("version", "files_versioned", F.lit(rows).cast("long").alias("dim_rows"))


@query("sink_version_as_of", """
SELECT 'v1' AS version, o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total, count(*) AS referenced FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'v2', o_orderstatus, count(*), round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END), 2), CASE WHEN o_orderstatus = 'F' THEN 0 ELSE count(*) END FROM orders GROUP BY o_orderstatus""")
def sink_version_as_of(spark, sf):
    """Two versions of the orders, split by status, of which one status changes: their rows, and the rows that
    the second takes from the first one's files."""
    target = scratch_path(spark, "versions")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    raised = orders.withColumn("o_totalprice", F.col("o_totalprice") + (F.col("o_orderstatus") == "F").cast("int"))
    out = []
    for version, rows in (("v1", orders), ("v2", raised)):
        versions.write_version(spark, {"orders": rows}, target, version, {"orders": "o_orderstatus"})
    for version in ("v1", "v2"):
        own = versions.read_version(spark, target, "orders", version)
        told = versions.read_manifest(spark, target, version).select(F.col("partition").alias("status"), F.when(F.col("path").endswith("version=v1"), F.col("rows")).otherwise(F.lit(0)).alias("referenced"))
        sums = own.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
        out.append(sums.join(told, "status").select(F.lit(version).alias("version"), "status", "n", "total", "referenced"))
    return out[0].unionByName(out[1])


@query("key_registry", """
SELECT 'first' AS version, c_name AS name, row_number() OVER (ORDER BY c_name) AS id FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'second', c_name, row_number() OVER (ORDER BY c_custkey % 3 = 0, c_name) FROM customer""")
def key_registry(spark, sf):
    """Keys of two thirds of the customers, then of all: the first ones stay, new ones follow."""
    target = scratch_path(spark, "keys")
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"))
    first = store(versions.assign_keys(spark, rows.filter("c_custkey % 3 <> 0"), "name", target, "first"), "first")
    second = versions.assign_keys(spark, rows, "name", target, "second")
    return first.withColumn("version", F.lit("first")).unionByName(second.withColumn("version", F.lit("second"))).select("version", "name", "id")


@query("sink_flat_csv", """
SELECT c_custkey, c_name, c_acctbal FROM customer""")
def sink_flat_csv(spark, sf):
    path = _csv(spark, table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), "flat")
    return spark.read.option("header", True).schema("c_custkey long, c_name string, c_acctbal double").csv(path)


@query("sink_json_records", """
SELECT CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_acctbal': CASE WHEN c_acctbal >= 0 THEN c_acctbal END}) AS VARCHAR) AS record FROM customer""")
def sink_json_records(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", F.when(F.col("c_acctbal") < 0, float("nan")).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    return writers.as_json_records(rows)


@query("publish_tables", """
SELECT 'dim_country' AS table_name, count(*) AS n_rows FROM customer UNION ALL SELECT 'clusters', count(*) FROM part UNION ALL SELECT 'forecasts', NULL""")
def publish_tables(spark, sf):
    base = scratch_path(spark, "publish")
    writers.write_stage(table(spark, sf, "customer"), base, "dim_country")
    writers.write_stage(table(spark, sf, "part"), base, "clusters")
    return writers.publish(spark, base, ["dim_country", "clusters", "forecasts"])
