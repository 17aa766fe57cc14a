"""Features, star schema, selections, joins, aggregations, windows and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.panel import (
    INDICATORS, SCORES, by_period, fact, growth_sql, indicator, indicators, lines, lookup, scores,
    suppliers, table, wide, with_fact, with_sources,
)
from checks.registry import query, r4, rounded
from panelkit import config
from panelkit.functions import expressions as x
from panelkit.operators import quantiles, relational as rel, scans, text_search, windows as win
from panelkit.plans import star
from panelkit.session import store

FACT_DOUBLES = [
    "population", "gdp", "co2", "coal_co2", "gas_co2", "oil_co2", "co2_per_capita", "energy_per_capita",
    "temperature_anomaly", *INDICATORS, *SCORES, "energy_intensity", "coal_share", "gas_share", "oil_share",
    "renewables_share", "sustainability_score", "co2_growth_rate", "co2_per_capita_5yr_avg",
]


@query("star_fact", with_fact(f"SELECT iso_code, year, country, country_id, {r4(*FACT_DOUBLES)} FROM fact JOIN dim_country USING (iso_code)"))
def star_fact(spark, sf):
    return rounded(star.with_country_id(fact(spark, sf), lines(spark, sf)).select("iso_code", "year", "country", "country_id", *FACT_DOUBLES))


@query("star_fact_monthly", with_fact(f"SELECT iso_code, year, country, {r4(*FACT_DOUBLES)} FROM fact", "month"))
def star_fact_monthly(spark, sf):
    return rounded(fact(spark, sf, "month").select("iso_code", "year", "country", *FACT_DOUBLES))


@query("star_dim_country", with_fact("SELECT * FROM dim_country"))
def star_dim_country(spark, sf):
    return star.build_dim_country(wide(spark, sf), lookup(spark, sf))


@query("star_dim_time", """
SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year, make_date(year(l_shipdate), 1, 1) AS date,
  CAST(year(l_shipdate) // 10 * 10 AS INTEGER) AS decade,
  CAST(year(l_shipdate) // 10 * 10 AS VARCHAR) || '–' || CAST(year(l_shipdate) // 10 * 10 + 9 AS VARCHAR) AS period
FROM lineitem""")
def star_dim_time(spark, sf):
    return star.build_dim_time(lines(spark, sf))


@query("star_dim_energy_type", """
SELECT energy_type, category, round(CAST(sum(CASE energy_type WHEN 'coal' THEN c WHEN 'gas' THEN g WHEN 'oil' THEN o END) AS DOUBLE) / 100, 2) AS total
FROM (VALUES ('coal','fossil'),('gas','fossil'),('oil','fossil'),('renewables','clean'),('nuclear','clean')) t(energy_type, category),
 (SELECT sum(cents) FILTER (WHERE flag='R') AS c, sum(cents) FILTER (WHERE flag='A') AS g, sum(cents) FILTER (WHERE flag='N') AS o
  FROM (SELECT CAST(round(l_extendedprice*100) AS BIGINT) AS cents, l_returnflag AS flag FROM lineitem))
GROUP BY energy_type, category""")
def star_dim_energy_type(spark, sf):
    kind = x.lookup(F.col("flag"), {"R": "coal", "A": "gas", "N": "oil"}, "other")
    totals = lines(spark, sf).groupBy(kind.alias("energy_type")).agg(F.sum("cents").alias("cents"))
    return star.build_dim_energy_type(spark).join(totals, "energy_type", "left").select(
        "energy_type", "category", F.round(F.col("cents").cast("double") / 100, 2).alias("total"))


@query("window_percent_change", with_sources(f"SELECT iso_code, year, round({growth_sql()}, 4) AS co2_growth_rate FROM wide", "month"))
def window_percent_change(spark, sf):
    return rounded(wide(spark, sf, "month").select("iso_code", "year", win.percent_change("co2").alias("co2_growth_rate")))


@query("window_rolling_mean", with_sources("""
SELECT iso_code, year, CASE WHEN count(co2_per_capita) OVER w >= 2 THEN round(avg(co2_per_capita) OVER w, 4) END AS rolling
FROM wide WINDOW w AS (PARTITION BY iso_code ORDER BY year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""", "month"))
def window_rolling_mean(spark, sf):
    return rounded(wide(spark, sf, "month").select("iso_code", "year", win.rolling_mean("co2_per_capita").alias("rolling")))


@query("window_fill_both", with_sources("""
SELECT iso_code, year, round(coalesce(
  last_value(v IGNORE NULLS) OVER (PARTITION BY iso_code ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER (PARTITION BY iso_code ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 4) AS filled
FROM (SELECT wide.iso_code, wide.year, vulnerability_score AS v FROM wide LEFT JOIN nd USING (iso_code, year))""", "month"))
def window_fill_both(spark, sf):
    joined = wide(spark, sf, "month").join(scores(spark, sf, "month"), ["iso_code", "year"], "left")
    return rounded(joined.select("iso_code", "year", win.fill_both("vulnerability_score").alias("filled")))


LONG = """lines AS (SELECT CASE WHEN l_suppkey % 5 = 0 THEN 'S' || l_suppkey ELSE 'most' END AS iso_code, ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey % 1000 AS year,
  CASE WHEN l_discount >= 0.03 THEN l_extendedprice END AS price, CASE WHEN l_tax >= 0.02 THEN l_quantity::DOUBLE END AS quantity FROM lineitem)"""


def long_series(spark, sf):
    """Order lines as series, one of which holds four fifths of all rows."""
    entity = F.when(F.col("l_suppkey") % 5 == 0, F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).otherwise("most")
    return table(spark, sf, "lineitem").select(
        entity.alias("iso_code"), (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100_000 + F.col("l_partkey")) * 1000 + F.col("l_suppkey") % 1000).alias("year"),
        F.when(F.col("l_discount") >= 0.03, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_tax") >= 0.02, F.col("l_quantity").cast("double")).alias("quantity"))


@query("scan_percent_change", f"""WITH {LONG}, seen AS (SELECT iso_code, year, last_value(price IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS now,
  last_value(price IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM lines WINDOW w AS (PARTITION BY iso_code ORDER BY year))
SELECT iso_code, year, round(CASE WHEN before <> 0 THEN (now / before - 1) * 100 END, 4) AS change FROM seen""")
def scan_percent_change(spark, sf):
    return rounded(scans.with_history(long_series(spark, sf), percent_changes={"change": "price"}).select("iso_code", "year", "change"))


@query("scan_rolling_mean", f"""WITH {LONG} SELECT iso_code, year, CASE WHEN count(quantity) OVER w >= 3 THEN round(avg(quantity) OVER w, 4) END AS rolling
FROM lines WINDOW w AS (PARTITION BY iso_code ORDER BY year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def scan_rolling_mean(spark, sf):
    return rounded(scans.with_history(long_series(spark, sf), rolling_means={"rolling": ("quantity", 5, 3)}).select("iso_code", "year", "rolling"))


@query("scan_fill_both", f"""WITH {LONG} SELECT iso_code, year, round(coalesce(last_value(price IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(price IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), 4) AS filled FROM lines WINDOW w AS (PARTITION BY iso_code ORDER BY year)""")
def scan_fill_both(spark, sf):
    return rounded(scans.with_history(long_series(spark, sf), fills={"filled": "price"}).select("iso_code", "year", "filled"))


@query("window_lag_totals", with_sources("""
SELECT year, round(total_co2, 0) AS total_co2, round((total_co2 - before) / nullif(before, 0) * 100, 2) AS yoy_growth_pct
FROM (SELECT year, total_co2, lag(total_co2) OVER (ORDER BY year) AS before
      FROM (SELECT year, CAST(sum(CAST(round(co2 * 9973) AS BIGINT)) AS DOUBLE) / 9973 AS total_co2 FROM wide GROUP BY year))""", "month"))
def window_lag_totals(spark, sf):
    totals = wide(spark, sf, "month").groupBy("year").agg(
        (F.sum(F.round(F.col("co2") * 9973).cast("long")).cast("double") / 9973.0).alias("total_co2"))
    return win.lag_change(totals, "total_co2").withColumn("total_co2", F.round("total_co2", 0))


@query("window_lagged_sequences", with_sources(f"""
SELECT * FROM (SELECT iso_code, year, co2, {", ".join(f"lag(co2, {i}) OVER (PARTITION BY iso_code ORDER BY year) AS lag_{i}" for i in range(1, 6))}
FROM wide WHERE co2 IS NOT NULL) WHERE lag_5 IS NOT NULL""", "month"))
def window_lagged_sequences(spark, sf):
    known = wide(spark, sf, "month").select("iso_code", "year", "co2").dropna()
    return win.lagged_sequences(known, "co2")


@query("window_standardise_series", with_sources("""
SELECT iso_code, year, round((co2 - m) / s, 4) AS z FROM (
 SELECT iso_code, year, co2, avg(co2) OVER (PARTITION BY iso_code) AS m, stddev_pop(co2) OVER (PARTITION BY iso_code) AS s
 FROM wide WHERE co2 IS NOT NULL) WHERE s > 0""", "month"))
def window_standardise_series(spark, sf):
    known = wide(spark, sf, "month").select("iso_code", "year", "co2").dropna()
    return rounded(win.standardise_by_entity(known, "co2").select("iso_code", "year", "z"))


@query("key_dense_rank", """
SELECT c_name AS entity, row_number() OVER (ORDER BY c_name) AS entity_id FROM (SELECT DISTINCT c_name FROM customer)""")
def key_dense_rank(spark, sf):
    return rel.dense_key(table(spark, sf, "customer").withColumnRenamed("c_name", "entity"), "entity", "entity_id")


@query("keep_one_per_key", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) = 1""")
def keep_one_per_key(spark, sf):
    li = table(spark, sf, "lineitem")
    return rel.keep_one(li, ["l_orderkey", "l_linenumber"],
                        [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_extendedprice")]
                        ).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")


@query("filter_named_set", """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY')""")
def filter_named_set(spark, sf):
    return rel.without_names(table(spark, sf, "customer"), "c_mktsegment", ["HOUSEHOLD", "MACHINERY"]).select(
        "c_custkey", "c_name", "c_mktsegment")


@query("filter_listed_table", """
SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""")
def filter_listed_table(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("c_custkey"))
    return rel.without_listed(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), urgent, "c_custkey")


@query("select_floor_and_known", with_sources("""
SELECT iso_code, year, round(co2, 4) AS total FROM wide WHERE year >= 1998 AND co2 IS NOT NULL AND gas_co2 IS NOT NULL""", "year"))
def select_floor_and_known(spark, sf):
    return rounded(wide(spark, sf).filter(F.col("year") >= 1998).dropna(subset=["co2", "gas_co2"]).select(
        "iso_code", "year", F.col("co2").alias("total")))


@query("select_latest_slice", with_sources("SELECT iso_code, country, year, round(co2, 4) AS co2 FROM wide WHERE year = (SELECT max(year) FROM wide)"))
def select_latest_slice(spark, sf):
    return rounded(rel.latest_slice(wide(spark, sf)).select("iso_code", "country", "year", "co2"))


@query("select_latest_per_entity", with_sources("""
SELECT iso_code, year, round(co2, 4) AS co2, round(gdp, 4) AS gdp FROM wide WHERE co2 IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY iso_code ORDER BY year DESC) = 1""", "month"))
def select_latest_per_entity(spark, sf):
    return rounded(rel.latest_per_entity(wide(spark, sf, "month"), "co2").select("iso_code", "year", "co2", "gdp"))


@query("select_last_periods", with_sources("""
SELECT iso_code, year, round(co2, 4) AS co2 FROM wide QUALIFY row_number() OVER (PARTITION BY iso_code ORDER BY year DESC) <= 20""", "month"))
def select_last_periods(spark, sf):
    return rounded(rel.last_periods(wide(spark, sf, "month").select("iso_code", "year", "co2"), 20))


@query("select_by_code", with_sources("SELECT iso_code, year, round(co2, 4) AS co2 FROM wide WHERE iso_code = 'S000000007'"))
def select_by_code(spark, sf):
    return rounded(wide(spark, sf).filter(F.col("iso_code") == x.normalise_code(" s000000007")).select("iso_code", "year", "co2"))


DIRTY = ["NaN", "NA", "N/A", "1d", "2f", "", " 7 ", "1e3", "-.5", "+4.", "0x10", "1,000", "inf"]
DIRTY_SQL = "[" + ", ".join(f"'{d}'" for d in DIRTY) + "]"


@query("coerce_text_numbers", f"""
SELECT o_orderkey, TRY_CAST(CASE WHEN regexp_full_match(t, '[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[iI]nf(inity)?)') THEN t END AS DOUBLE) AS number
FROM (SELECT o_orderkey, trim(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority WHEN o_orderstatus = 'F' THEN '  ' || o_totalprice::VARCHAR
  ELSE {DIRTY_SQL}[1 + o_orderkey % {len(DIRTY)}] END) AS t FROM orders)""")
def coerce_text_numbers(spark, sf):
    dirty = F.get(F.array(*map(F.lit, DIRTY)), (F.col("o_orderkey") % len(DIRTY)).cast("int"))
    text = (F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
            .when(F.col("o_orderstatus") == "F", F.concat(F.lit("  "), F.col("o_totalprice").cast("string"))).otherwise(dirty))
    return table(spark, sf, "orders").select("o_orderkey", x.try_number(text).alias("number"))


@query("replace_non_finite", with_fact("""
SELECT iso_code, year, round(coalesce(CASE WHEN isinf(co2_growth_rate) THEN NULL ELSE co2_growth_rate END, 0), 4) AS growth_or_zero,
       round(coalesce(gdp, 50), 4) AS gdp_or_fifty FROM fact""", "month"))
def replace_non_finite(spark, sf):
    return rounded(fact(spark, sf, "month").select(
        "iso_code", "year", x.finite_or(F.col("co2_growth_rate"), 0.0).alias("growth_or_zero"),
        x.finite_or(F.col("gdp"), 50.0).alias("gdp_or_fifty")))


@query("search_entities", "SELECT s_suppkey, s_name FROM supplier WHERE lower(s_name) LIKE '%#00000000%' ORDER BY s_suppkey LIMIT 15")
def search_entities(spark, sf):
    return rel.search(table(spark, sf, "supplier").select("s_suppkey", "s_name"), " SUPPLIER#00000000", ["s_name"], order=["s_suppkey"])


@query("search_by_pieces", " UNION ALL ".join(f"""SELECT * FROM (SELECT '{text}' AS searched, p_partkey, p_name, p_type FROM part
WHERE contains(lower(p_name), '{text}') OR contains(lower(p_type), '{text}') ORDER BY p_partkey LIMIT 15)""" for text in ("brushed cop", "ed", "t 1", "not there", "x")))
def search_by_pieces(spark, sf):
    """Several searches in one index: long and short texts, across a blank, and one that nothing holds."""
    rows = store(table(spark, sf, "part").select("p_partkey", "p_name", "p_type"), "parts")
    index = text_search.build_index(rows, ["p_name", "p_type"], "p_partkey")
    found = [text_search.search_index(index, rows, text, ["p_name", "p_type"], id="p_partkey", order=["p_partkey"]).withColumn("searched", F.lit(text))
             for text in ("brushed cop", "ed", "t 1", "not there", "x")]
    return reduce(DataFrame.unionByName, found)


@query("join_sources", with_sources(f"""
SELECT wide.iso_code, wide.year, {r4("co2", "temperature_anomaly", *INDICATORS, *SCORES)}
FROM wide LEFT JOIN temp USING (year) LEFT JOIN wb USING (iso_code, year) LEFT JOIN nd USING (iso_code, year)""", "month"))
def join_sources(spark, sf):
    j = star.join_sources(wide(spark, sf, "month"), by_period(spark, sf, "month"), indicators(spark, sf, "month"), scores(spark, sf, "month"))
    return rounded(j.select("iso_code", "year", "co2", "temperature_anomaly", *INDICATORS, *SCORES))


def _one_indicator_sql(name):
    cond, value, _ = INDICATORS[name]
    return f"(SELECT iso_code, year, CAST(sum({value}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS {name} FROM li WHERE {cond} GROUP BY iso_code, year)"


_A, _B, _C = INDICATORS


@query("join_full_outer", with_sources(f"""
SELECT coalesce(a.iso_code, b.iso_code, c.iso_code) AS iso_code, coalesce(a.year, b.year, c.year) AS year, {r4(*INDICATORS)}
FROM {_one_indicator_sql(_A)} a FULL JOIN {_one_indicator_sql(_B)} b ON a.iso_code = b.iso_code AND a.year = b.year
FULL JOIN {_one_indicator_sql(_C)} c ON coalesce(a.iso_code, b.iso_code) = c.iso_code AND coalesce(a.year, b.year) = c.year""", "month"))
def join_full_outer(spark, sf):
    frames = [indicator(spark, sf, out, "month") for out in INDICATORS]
    return rounded(rel.full_outer(frames))


@query("join_lookup_default", """
SELECT s_suppkey, CASE r_name WHEN 'ASIA' THEN 'East' WHEN 'EUROPE' THEN 'North' WHEN 'AFRICA' THEN 'South' ELSE 'Other' END AS side
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def join_lookup_default(spark, sf):
    s = (table(spark, sf, "supplier")
         .join(F.broadcast(table(spark, sf, "nation")), F.expr("s_nationkey = n_nationkey"))
         .join(F.broadcast(table(spark, sf, "region")), F.expr("n_regionkey = r_regionkey")))
    return s.select("s_suppkey", x.lookup(F.col("r_name"), {"ASIA": "East", "EUROPE": "North", "AFRICA": "South"}, "Other").alias("side"))


@query("join_enrich", with_sources("""
SELECT wide.iso_code, wide.year, wide.country, round(vulnerability_score, 4) AS gdp FROM wide LEFT JOIN nd USING (iso_code, year)"""))
def join_enrich(spark, sf):
    other = scores(spark, sf).select("iso_code", "year", F.col("vulnerability_score").alias("gdp"))
    return rounded(rel.enrich(wide(spark, sf), other, ["iso_code", "year"], ["gdp"]).select("iso_code", "year", "country", "gdp"))


@query("agg_first_name", """
SELECT o_custkey AS entity, min_by(o_orderpriority, o_orderkey) AS first_name FROM orders GROUP BY o_custkey""")
def agg_first_name(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("entity")).agg(
        F.min_by("o_orderpriority", "o_orderkey").alias("first_name"))


@query("agg_period_totals", with_sources("""
SELECT wide.year, coalesce(round(CAST(sum(CAST(round(co2 * 9973) AS BIGINT)) AS DOUBLE) / 9973, 4), 0) AS total_co2,
       round(avg(temperature_anomaly), 4) AS avg_temp, count(DISTINCT iso_code) AS entities FROM wide JOIN temp USING (year) GROUP BY wide.year""", "month"))
def agg_period_totals(spark, sf):
    j = rel.attach(wide(spark, sf, "month"), by_period(spark, sf, "month"), ["year"], "inner")
    return rounded(j.groupBy("year").agg(
        F.coalesce(F.sum(F.round(F.col("co2") * 9973).cast("long")).cast("double") / 9973.0, F.lit(0.0)).alias("total_co2"),
        F.avg("temperature_anomaly").alias("avg_temp"), F.count_distinct("iso_code").alias("entities")))


@query("agg_by_dimension", """
SELECT n_name, c_mktsegment, count(*) AS members, round(avg(c_acctbal) / 9.97::DOUBLE, 4) AS avg_balance, count(DISTINCT c_custkey) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment""")
def agg_by_dimension(spark, sf):
    j = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.expr("c_nationkey = n_nationkey"))
    return j.groupBy("n_name", "c_mktsegment").agg(
        F.count("*").alias("members"), F.round(F.avg("c_acctbal") / 9.97, 4).alias("avg_balance"),
        F.count_distinct("c_custkey").alias("customers"))


@query("agg_last_known", with_sources("""
SELECT iso_code, max(year) AS last_historical_year, round(max_by(co2, year) FILTER (WHERE co2 IS NOT NULL), 4) AS last_co2,
       round(max_by(gdp, year) FILTER (WHERE gdp IS NOT NULL), 4) AS last_gdp FROM wide GROUP BY iso_code""", "month"))
def agg_last_known(spark, sf):
    from panelkit.operators.forecast import last_known
    return rounded(last_known(wide(spark, sf, "month"), {"co2": "last_co2", "gdp": "last_gdp"}))


@query("agg_median_by_group", """
SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.5), 4) AS median_price, round(quantile_cont(l_quantity, 0.5), 4) AS median_qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_median_by_group(spark, sf):
    q = quantiles.quantile_columns(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], {"median": 0.5}, ["l_returnflag", "l_linestatus"])
    return rounded(q.select("l_returnflag", "l_linestatus", F.col("median_l_extendedprice").alias("median_price"),
                            F.col("median_l_quantity").alias("median_qty")))


@query("agg_quartiles", """
SELECT 'l_extendedprice' AS metric, p AS prob, round(CASE p WHEN 0.25 THEN quantile_cont(l_extendedprice, 0.25) ELSE quantile_cont(l_extendedprice, 0.75) END, 4) AS value
FROM lineitem, (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) t(p) GROUP BY p
UNION ALL SELECT 'l_tax', p, round(CASE p WHEN 0.25 THEN quantile_cont(l_tax, 0.25) ELSE quantile_cont(l_tax, 0.75) END, 4)
FROM lineitem, (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) t(p) GROUP BY p""")
def agg_quartiles(spark, sf):
    return rounded(quantiles.exact_quantiles(table(spark, sf, "lineitem"), ["l_extendedprice", "l_tax"], [0.25, 0.75]))


@query("agg_group_sizes", "SELECT o_orderstatus, o_orderpriority, count(*) AS members FROM orders GROUP BY ALL")
def agg_group_sizes(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("members"))


@query("agg_conditional_counts", """
SELECT l_shipmonth, count(*) FILTER (WHERE l_discount > 0.07) AS high, count(*) FILTER (WHERE l_discount <= 0.07 AND l_discount > 0.04) AS medium,
       round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END), 4) AS returned_rate
FROM (SELECT *, date_trunc('month', l_shipdate)::DATE AS l_shipmonth FROM lineitem) GROUP BY l_shipmonth""")
def agg_conditional_counts(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_shipmonth", F.trunc(F.col("l_shipdate").cast("date"), "month"))
    return rounded(li.groupBy("l_shipmonth").agg(
        F.count_if(F.col("l_discount") > 0.07).alias("high"),
        F.count_if((F.col("l_discount") <= 0.07) & (F.col("l_discount") > 0.04)).alias("medium"),
        F.avg((F.col("l_returnflag") == "R").cast("double")).alias("returned_rate")))


@query("agg_mean_absolute", with_fact("""
SELECT feature, round(avg(abs(v)), 4) AS importance FROM (
 SELECT 'coal_share' AS feature, coal_share AS v FROM fact UNION ALL SELECT 'gas_share', gas_share FROM fact UNION ALL SELECT 'sustainability_score', sustainability_score FROM fact)
GROUP BY feature"""))
def agg_mean_absolute(spark, sf):
    from panelkit.operators.explain import mean_absolute
    return rounded(mean_absolute(fact(spark, sf), ["coal_share", "gas_share", "sustainability_score"]))


@query("reshape_unpivot_years", with_sources("SELECT iso_code, year, round(co2, 4) AS co2 FROM wide WHERE co2 IS NOT NULL"))
def reshape_unpivot_years(spark, sf):
    w = wide(spark, sf)
    matrix = w.groupBy("iso_code", F.col("country").alias("Name")).pivot("year").agg(F.first("co2"))  # the years there are
    long = rel.wide_to_long(matrix, ["iso_code", "Name"], "co2").dropna(subset=["co2"])
    return rounded(long.select("iso_code", "year", "co2"))


@query("reshape_pivot_features", with_fact("""
SELECT iso_code, round(max(coal_share) FILTER (WHERE year = (SELECT max(year) FROM fact)), 4) AS shap_coal_share, round(max(gas_share) FILTER (WHERE year = (SELECT max(year) FROM fact)), 4) AS shap_gas_share
FROM fact GROUP BY iso_code HAVING count(*) FILTER (WHERE year = (SELECT max(year) FROM fact)) > 0"""))
def reshape_pivot_features(spark, sf):
    from panelkit.operators.explain import pivot_attributions
    f = rel.latest_slice(fact(spark, sf)).select("iso_code", "coal_share", "gas_share")
    long = f.unpivot("iso_code", ["coal_share", "gas_share"], "feature", "attribution")
    return rounded(pivot_attributions(long, ["coal_share", "gas_share"], ["iso_code"]))


@query("union_by_name", """
SELECT c_custkey AS k, c_acctbal AS balance, c_mktsegment AS segment, NULL::INTEGER AS size FROM customer
UNION ALL SELECT p_partkey, NULL, NULL, p_size FROM part""")
def union_by_name(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("size"))
    return a.unionByName(b, allowMissingColumns=True)


@query("top_k_by_metric", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k_by_metric(spark, sf):
    return rel.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10, ["o_orderkey"])


@query("ranking_head_and_tail", """
(SELECT 'head' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
UNION ALL (SELECT 'tail', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice ASC, o_orderkey DESC LIMIT 5)""")
def ranking_head_and_tail(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    head = rel.top_k(o, "o_totalprice", 10, ["o_orderkey"]).select(F.lit("head").alias("side"), "*")
    return head.unionByName(rel.bottom_k(o, "o_totalprice", 5, ["o_orderkey"]).select(F.lit("tail").alias("side"), "*"))


@query("scores_min_max", with_fact("""
SELECT iso_code, year, round(CASE WHEN vulnerability_score IS NULL THEN NULL WHEN hi = lo THEN 50 ELSE (vulnerability_score - lo) / (hi - lo) * 100 END, 4) AS scaled,
       round(100 - (CASE WHEN readiness_score IS NULL THEN NULL WHEN rhi = rlo THEN 50 ELSE (readiness_score - rlo) / (rhi - rlo) * 100 END), 4) AS inverted
FROM fact, (SELECT min(vulnerability_score) AS lo, max(vulnerability_score) AS hi, min(readiness_score) AS rlo, max(readiness_score) AS rhi FROM fact)"""))
def scores_min_max(spark, sf):
    f = fact(spark, sf)
    b = f.agg(F.struct(*[g(c).alias(f"{n}_{c}") for c in ("vulnerability_score", "readiness_score") for n, g in (("lo", F.min), ("hi", F.max))])).scalar()
    scaled = lambda c, inv: x.min_max_score(F.col(c), b[f"lo_{c}"], b[f"hi_{c}"], inv)
    return rounded(f.select("iso_code", "year", scaled("vulnerability_score", False).alias("scaled"), scaled("readiness_score", True).alias("inverted")))


@query("categories_and_words", with_fact("""
SELECT iso_code, year, CASE WHEN coal_share IS NULL THEN 'Unknown' WHEN coal_share > 70 THEN 'High' WHEN coal_share > 40 THEN 'Medium' ELSE 'Low' END AS category,
  CASE WHEN coal_share IS NULL THEN 'unknown' WHEN coal_share > 70 THEN 'high' WHEN coal_share > 40 THEN 'moderate' ELSE 'low' END AS word,
  CASE WHEN co2_growth_rate IS NULL THEN 'stable' WHEN co2_growth_rate > 5 THEN 'rapidly increasing' WHEN co2_growth_rate > 1 THEN 'increasing'
       WHEN co2_growth_rate > -1 THEN 'stable' WHEN co2_growth_rate > -5 THEN 'decreasing' ELSE 'rapidly declining' END AS trend
FROM fact""", "month"))
def categories_and_words(spark, sf):
    return fact(spark, sf, "month").select(
        "iso_code", "year", x.risk_category(F.col("coal_share")).alias("category"),
        x.risk_word(F.col("coal_share")).alias("word"), x.trend_word(F.col("co2_growth_rate")).alias("trend"))
