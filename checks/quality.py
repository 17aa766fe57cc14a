"""Quality checks over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.panel import lines, table
from checks.registry import query
from panelkit.operators import quality as q
from panelkit.session import scratch_path
from panelkit.sources.readers import path_exists


def _orders_text(spark, sf):
    """Orders with text columns, half of which are not numbers."""
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("final_price"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(F.col("o_custkey").cast("string")).alias("code"),
        F.year("o_orderdate").alias("year"),
    )


@query("quality_row_count", """
SELECT 'orders' AS dataset, 'row_count' AS "check", count(*) >= 1000 AS passed, CASE WHEN count(*) >= 1000 THEN 'INFO' ELSE 'CRITICAL' END AS severity,
  format('{:,} rows (minimum: 1,000)', count(*)) AS details FROM orders""")
def quality_row_count(spark, sf):
    return q.run_suite(table(spark, sf, "orders"), "orders", [q.row_count(1000)])


SCHEMA_SQL = """
WITH columns_ AS (SELECT column_name AS c FROM (DESCRIBE lineitem)),
required AS (SELECT * FROM (VALUES (1, 'l_orderkey'), (1, 'l_partkey'), (2, 'l_orderkey'), (2, 'l_color')) t(suite, c)),
optional AS (SELECT * FROM (VALUES (1, 'l_tax')) t(suite, c)),
judged AS (SELECT suite, count(*) AS k, string_agg(chr(39) || c || chr(39), ', ' ORDER BY c) FILTER (WHERE c NOT IN (SELECT c FROM columns_)) AS missing,
  (SELECT count(*) FROM columns_ x WHERE x.c NOT IN (SELECT c FROM required r WHERE r.suite = q.suite) AND x.c NOT IN (SELECT c FROM optional o WHERE o.suite = q.suite)) AS extra FROM required q GROUP BY suite)
SELECT 'lineitem' AS dataset, 'schema_check' AS "check", missing IS NULL AS passed, CASE WHEN missing IS NULL THEN 'WARNING' ELSE 'CRITICAL' END AS severity,
  CASE WHEN missing IS NULL THEN printf('All %d required columns present, %d extra', k, extra) ELSE 'Missing required columns: [' || missing || ']' END AS details FROM judged"""


@query("quality_schema", SCHEMA_SQL)
def quality_schema(spark, sf):
    return q.run_suite(table(spark, sf, "lineitem"), "lineitem", [
        q.schema(["l_orderkey", "l_partkey"], ["l_tax"]), q.schema(["l_orderkey", "l_color"])])


@query("quality_null_rates", """
SELECT 'orders' AS dataset, 'null_rate[' || c || ']' AS "check", r <= 0.3 AS passed, CASE WHEN r <= 0.8 THEN 'WARNING' ELSE 'CRITICAL' END AS severity,
  printf('%.1f%% null (threshold: 30%%)', r * 100) AS details
FROM (SELECT 'final_price' AS c, avg(CASE WHEN o_orderstatus = 'F' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) AS r FROM orders UNION ALL SELECT 'o_totalprice', avg(CASE WHEN o_totalprice IS NULL THEN 1.0::DOUBLE ELSE 0 END) FROM orders)""")
def quality_null_rates(spark, sf):
    return q.run_suite(_orders_text(spark, sf), "orders", [q.null_rates(["final_price", "o_totalprice", "absent"], 0.3)])


@query("quality_duplicates", """
SELECT 'lineitem' AS dataset, 'duplicate_check' AS "check", n = 0 AS passed, CASE WHEN n < 100 THEN 'WARNING' ELSE 'CRITICAL' END AS severity,
  printf('%d duplicate rows on [''l_orderkey'', ''l_linenumber'']', n) AS details
FROM (SELECT coalesce(sum(c), 0)::BIGINT AS n FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE c > 1)""")
def quality_duplicates(spark, sf):
    return q.run_suite(table(spark, sf, "lineitem"), "lineitem", [q.duplicates(["l_orderkey", "l_linenumber"])])


@query("quality_value_range", """
SELECT 'customer' AS dataset, 'range_check[c_acctbal]' AS "check", n = 0 AS passed, 'WARNING' AS severity, printf('%d values outside [0, None]', n) AS details
FROM (SELECT count(*) FILTER (WHERE c_acctbal < 0) AS n FROM customer)
UNION ALL SELECT 'customer', 'range_check[c_nationkey]', n = 0, 'WARNING', printf('%d values outside [1, 20]', n)
FROM (SELECT count(*) FILTER (WHERE c_nationkey < 1 OR c_nationkey > 20) AS n FROM customer)""")
def quality_value_range(spark, sf):
    return q.run_suite(table(spark, sf, "customer"), "customer", [q.value_range("c_acctbal", 0), q.value_range("c_nationkey", 1, 20)])


@query("quality_outliers_iqr", """
SELECT 'documents' AS dataset, 'outlier_iqr[n_chars]' AS "check", out / n < 0.05 AS passed, CASE WHEN out / n < 0.05 THEN 'INFO' ELSE 'WARNING' END AS severity,
  printf('%d outliers (%.1f%%) outside [%.2f, %.2f]', out, out / n * 100, lo, hi) AS details
FROM (SELECT count(*) FILTER (WHERE n_chars < lo OR n_chars > hi) AS out, CAST(count(n_chars) AS DOUBLE) AS n, any_value(lo) AS lo, any_value(hi) AS hi
 FROM documents, (SELECT q1 - 3 * (q3 - q1) AS lo, q3 + 3 * (q3 - q1) AS hi FROM
  (SELECT quantile_cont(n_chars::DOUBLE, 0.25) AS q1, quantile_cont(n_chars::DOUBLE, 0.75) AS q3 FROM documents))) WHERE n >= 10""")
def quality_outliers_iqr(spark, sf):
    return q.run_suite(table(spark, sf, "documents"), "documents", [q.outliers_iqr("n_chars")])


@query("quality_freshness", """
SELECT 'orders' AS dataset, 'freshness_check' AS "check", y >= 2020 AS passed, CASE WHEN y >= 2020 THEN 'INFO' ELSE 'WARNING' END AS severity,
  printf('Latest year: %d (expected >= 2020)', y) AS details FROM (SELECT max(year(o_orderdate)) AS y FROM orders)""")
def quality_freshness(spark, sf):
    return q.run_suite(_orders_text(spark, sf), "orders", [q.freshness("year", 2020)])


@query("quality_numeric_columns", """
SELECT 'orders' AS dataset, 'type_check[code]' AS "check", n = 0 AS passed, 'WARNING' AS severity, printf('%d non-numeric values found', n) AS details
FROM (SELECT count(*) FILTER (WHERE o_orderstatus = 'P' AND TRY_CAST(o_orderpriority AS DOUBLE) IS NULL) AS n FROM orders)
UNION ALL SELECT 'orders', 'type_check[o_totalprice]', true, 'INFO', 'Column is double' WHERE (SELECT count(*) FROM orders) > 0""")
def quality_numeric_columns(spark, sf):
    return q.run_suite(_orders_text(spark, sf), "orders", [q.numeric_columns(["code", "o_totalprice", "absent"])])


@query("quality_dirty_text", """
WITH o AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'N/A' WHEN o_orderkey % 7 = 0 THEN 'NaN' WHEN o_orderkey % 11 = 0 THEN '1d' ELSE floor(o_totalprice)::BIGINT::VARCHAR END AS t,
  CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN floor(o_totalprice) END AS v FROM orders),
 b AS (SELECT q1 - 3 * (q3 - q1) AS lo, q3 + 3 * (q3 - q1) AS hi FROM (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM o)),
 s AS (SELECT count(*) FILTER (WHERE v < lo OR v > hi) AS out, CAST(count(v) AS DOUBLE) AS n, any_value(lo) AS lo, any_value(hi) AS hi FROM o, b)
SELECT 'orders' AS dataset, 'outlier_iqr[price]' AS "check", out / n < 0.05 AS passed, CASE WHEN out / n < 0.05 THEN 'INFO' ELSE 'WARNING' END AS severity,
  printf('%d outliers (%.1f%%) outside [%.2f, %.2f]', out, out / n * 100, lo, hi) AS details FROM s WHERE n >= 10
UNION ALL SELECT 'orders', 'type_check[price]', n = 0, 'WARNING', printf('%d non-numeric values found', n) FROM (SELECT count(*) FILTER (WHERE v IS NULL) AS n FROM o)
UNION ALL SELECT 'orders', 'range_check[price]', n = 0, 'WARNING', printf('%d values outside [0, None]', n) FROM (SELECT count(*) FILTER (WHERE v < 0) AS n FROM o)""")
def quality_dirty_text(spark, sf):
    """A text column with missing markers and numbers that are none: reported, never raised."""
    price = (F.when(F.col("o_orderstatus") == "P", "N/A").when(F.col("o_orderkey") % 7 == 0, "NaN")
             .when(F.col("o_orderkey") % 11 == 0, "1d").otherwise(F.floor("o_totalprice").cast("string")))
    return q.run_suite(table(spark, sf, "orders").select(price.alias("price")), "orders", [q.outliers_iqr("price"), q.numeric_columns(["price"]), q.value_range("price", 0)])


def _orders_report(spark, sf):
    return q.run_suite(_orders_text(spark, sf), "orders", [
        q.row_count(1000), q.schema(["o_orderkey", "o_color"]), q.null_rates(["final_price"], 0.3),
        q.duplicates(["o_orderkey"]), q.freshness("year", 2020), q.value_range("o_totalprice", 0), q.numeric_columns(["code"]),
    ])


@query("quality_report_summary", """
WITH t AS (SELECT count(*) AS n, avg(CASE WHEN o_orderstatus = 'F' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) AS r, max(year(o_orderdate)) AS y,
  count(*) FILTER (WHERE o_totalprice < 0) AS neg, count(*) FILTER (WHERE o_orderstatus = 'P' AND TRY_CAST(o_orderpriority AS DOUBLE) IS NULL) AS bad,
  count(*) - count(DISTINCT o_orderkey) AS dup FROM orders),
 rows AS (SELECT n >= 1000 AS ok, n < 1000 AS crit FROM t UNION ALL SELECT false, true FROM t UNION ALL SELECT r <= 0.3, r > 0.8 FROM t
  UNION ALL SELECT dup = 0, dup >= 50 FROM t UNION ALL SELECT y >= 2020, false FROM t UNION ALL SELECT neg = 0, false FROM t UNION ALL SELECT bad = 0, false FROM t)
SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS passed, count(*) FILTER (WHERE NOT ok) AS failed, count(*) FILTER (WHERE NOT ok AND crit) AS critical,
  round(count(*) FILTER (WHERE ok) / CAST(count(*) AS DOUBLE) * 100, 0) AS score_pct, count(*) FILTER (WHERE NOT ok AND crit) = 0 AS gate_open FROM rows""")
def quality_report_summary(spark, sf):
    return q.summarise(_orders_report(spark, sf))


@query("quality_source_present", """
SELECT 'orders_' || s AS dataset, 'source_present' AS "check", n > 0 AS passed, CASE WHEN n > 0 THEN 'INFO' ELSE 'CRITICAL' END AS severity,
  CASE WHEN n > 0 THEN 'source found' ELSE 'source not found' END AS details
FROM (SELECT s, count(o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('P'), ('X')) t(s) LEFT JOIN orders ON o_orderstatus = s GROUP BY s)""")
def quality_source_present(spark, sf):
    """A source per order status, written where there are such orders: found or not."""
    base = scratch_path(spark, "sources")
    table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status")).write.partitionBy("status").parquet(base)
    return q.combine([q.source_report(spark, f"orders_{s}", path_exists(spark, f"{base}/status={s}")) for s in "FOPX"]).drop("timestamp")


SUITES_SQL = """
WITH li AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
  CAST(round(l_discount * 100) AS BIGINT) AS disc, CAST(l_quantity AS BIGINT) AS qty FROM lineitem),
owid AS (SELECT l_suppkey, year, CAST(sum(cents) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) AS pc, sum(cents) AS cents FROM li GROUP BY l_suppkey, year),
o AS (SELECT count(*) AS n, max(year) AS y, count(*) FILTER (WHERE year < 1750 OR year > 2030) AS off, count(*) FILTER (WHERE cents < 0) AS neg,
  quantile_cont(pc, 0.25) AS q1, quantile_cont(pc, 0.75) AS q3 FROM owid),
b AS (SELECT q1 - 3 * (q3 - q1) AS lo, q3 + 3 * (q3 - q1) AS hi FROM o),
iqr AS (SELECT count(*) FILTER (WHERE pc < lo OR pc > hi) AS out, CAST(count(*) AS DOUBLE) AS n, any_value(lo) AS lo, any_value(hi) AS hi FROM owid, b),
n AS (SELECT count(DISTINCT year) AS n, max(year) AS y, count(DISTINCT year) FILTER (WHERE year < 1880 OR year > 2030) AS off FROM li),
w AS (SELECT count(*) AS n FROM li), s AS (SELECT count(*) AS n FROM supplier),
counts AS (SELECT 'OWID' AS dataset, n, 1000 AS need FROM o UNION ALL SELECT 'NASA', n, 50 FROM n UNION ALL SELECT 'INDICATOR', n, 500 FROM w UNION ALL SELECT 'NDGAIN', n, 100 FROM s),
fresh AS (SELECT 'OWID' AS dataset, y FROM o UNION ALL SELECT 'NASA', y FROM n),
rates AS (SELECT 'OWID' AS dataset, unnest(['country', 'year', 'co2']) AS c, unnest([1 - count(l_suppkey)::DOUBLE / count(*), 1 - count(year)::DOUBLE / count(*), 1 - count(cents)::DOUBLE / count(*)]) AS r FROM owid
  UNION ALL SELECT 'INDICATOR', unnest(['REF_AREA', 'TIME_PERIOD', 'OBS_VALUE']), unnest([1 - count(l_suppkey)::DOUBLE / count(*), 1 - count(year)::DOUBLE / count(*), 1 - count(disc)::DOUBLE / count(*)]) FROM li),
twice AS (SELECT coalesce(sum(k), 0)::BIGINT AS d FROM (SELECT count(*) AS k FROM owid GROUP BY l_suppkey, year) WHERE k > 1)
SELECT dataset, 'row_count' AS "check", n >= need AS passed, CASE WHEN n >= need THEN 'INFO' ELSE 'CRITICAL' END AS severity, format('{:,} rows (minimum: {:,})', n, need) AS details FROM counts
UNION ALL SELECT dataset, 'schema_check', true, 'WARNING', printf('All %d required columns present, 0 extra', k) FROM (VALUES ('OWID', 5), ('NASA', 2), ('INDICATOR', 3), ('NDGAIN', 2)) t(dataset, k)
UNION ALL SELECT dataset, 'null_rate[' || c || ']', r <= 0.3, CASE WHEN r <= 0.8 THEN 'WARNING' ELSE 'CRITICAL' END, printf('%.1f%% null (threshold: 30%%)', r * 100) FROM rates
UNION ALL SELECT 'OWID', 'duplicate_check', d = 0, CASE WHEN d < 100 THEN 'WARNING' ELSE 'CRITICAL' END, printf('%d duplicate rows on [''country'', ''year'']', d) FROM twice
UNION ALL SELECT dataset, 'freshness_check', y >= 2020, CASE WHEN y >= 2020 THEN 'INFO' ELSE 'WARNING' END, printf('Latest year: %d (expected >= 2020)', y) FROM fresh
UNION ALL SELECT 'OWID', 'range_check[year]', off = 0, 'WARNING', printf('%d values outside [1750, 2030]', off) FROM o
UNION ALL SELECT 'OWID', 'range_check[co2]', neg = 0, 'WARNING', printf('%d values outside [0, None]', neg) FROM o
UNION ALL SELECT 'NASA', 'range_check[Year]', off = 0, 'WARNING', printf('%d values outside [1880, 2030]', off) FROM n
UNION ALL SELECT 'OWID', 'outlier_iqr[co2_per_capita]', out / n < 0.05, CASE WHEN out / n < 0.05 THEN 'INFO' ELSE 'WARNING' END,
  printf('%d outliers (%.1f%%) outside [%.2f, %.2f]', out, out / n * 100, lo, hi) FROM iqr WHERE n >= 10
UNION ALL SELECT dataset, 'type_check[' || c || ']', true, 'INFO', 'Column is ' || k
 FROM (VALUES ('OWID', 'co2', 'double'), ('OWID', 'population', 'bigint'), ('INDICATOR', 'TIME_PERIOD', 'int'), ('INDICATOR', 'OBS_VALUE', 'bigint')) t(dataset, c, k)"""


@query("quality_source_suites", SUITES_SQL)
def quality_source_suites(spark, sf):
    """The suites of the four sources on tables of their shape."""
    owid = lines(spark, sf).groupBy(F.col("iso_code").alias("country"), "year").agg(
        (F.sum("cents") / 100.0).alias("co2"), F.sum("qty").alias("population"), (F.sum("cents") / F.sum("qty")).alias("co2_per_capita")
    ).withColumn("iso_code", F.col("country"))
    nasa = lines(spark, sf).groupBy(F.col("year").alias("Year")).agg(F.avg("disc").alias("J-D"))
    wb = lines(spark, sf).select(F.col("iso_code").alias("REF_AREA"), F.col("year").alias("TIME_PERIOD"), F.col("disc").alias("OBS_VALUE"))
    nd = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ISO3"), F.col("s_name").alias("Name"))
    parts = [("OWID", owid), ("NASA", nasa), ("INDICATOR", wb), ("NDGAIN", nd)]
    return q.combine([q.run_suite(df, name, q.SUITES[name]) for name, df in parts]).drop("timestamp")


@query("quality_expectations", """
SELECT 'orders' AS dataset, CAST(5 AS BIGINT) AS expectations, (CASE WHEN bad > 0 THEN 1 ELSE 0 END + CASE WHEN outside > 0 THEN 1 ELSE 0 END)::BIGINT AS failed,
  bad = 0 AND outside = 0 AS success
FROM (SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS bad, count(*) FILTER (WHERE year(o_orderdate) < 1996 OR year(o_orderdate) > 2030) AS outside FROM orders)""")
def quality_expectations(spark, sf):
    return q.expectation_suite(_orders_text(spark, sf), "orders", ["o_orderkey", "o_custkey", "year"], ["o_orderkey"], {"year": (1996, 2030)})
