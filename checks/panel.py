"""Binding of the panel schema to the test tables, for Spark and as SQL text.

Entity = supplier, period = year (or month number) of the shipment date. Amounts are summed as
whole cents, so both engines get the same panel to the last bit; the units are divided by primes,
so that rounding never meets an exact half, which the engines treat differently. Missing values arise where a
supplier has no matching lines in a period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.plans import star
from panelkit.session import store

PERIOD_SQL = {
    "year": "CAST(year(l_shipdate) AS INTEGER)",
    "month": "CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INTEGER)",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _period(grain: str) -> Column:
    y = F.year("l_shipdate")
    return y if grain == "year" else y * 12 + F.month("l_shipdate") - 1


def _cents(c: str) -> Column:
    """Whole cents of a non-negative amount; plain arithmetic, as ``round`` on doubles goes through decimals."""
    return (F.col(c) * 100 + 0.5).cast("long")


def _code(c: str) -> Column:
    return F.concat(F.lit("S"), F.lpad(F.col(c).cast("string"), 9, "0"))


def lines(spark, sf, grain="year") -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_suppkey",
        _code("l_suppkey").alias("iso_code"),
        _period(grain).alias("year"),
        _cents("l_extendedprice").alias("cents"),
        _cents("l_discount").alias("disc"),
        _cents("l_tax").alias("tax"),
        F.col("l_quantity").cast("long").alias("qty"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
    )


def suppliers(spark, sf) -> DataFrame:
    s = table(spark, sf, "supplier")
    return s.select(
        _code("s_suppkey").alias("iso_code"),
        F.col("s_name").alias("country"), "s_nationkey", "s_acctbal",
    )


def base(spark, sf, grain="year") -> DataFrame:
    """Every sum the sources below need, per supplier and period, in one pass over the lines.

    A source that is used alone keeps only its own sums: Catalyst drops the others.
    """
    c = F.col
    done = c("status") == "F"
    sums = [
        F.count("*").alias("n"), F.sum("qty").alias("qty"), F.sum("disc").alias("disc"),
        F.sum(F.when(c("status") == "O", c("cents") * (100 - c("disc")))).alias("open_net"),
        F.sum(F.when(done, c("cents"))).alias("done"),
        F.sum(F.when(done & (c("flag") == "R"), c("cents"))).alias("done_r"),
        F.sum(F.when(done & (c("flag") == "A"), c("cents"))).alias("done_a"),
        F.sum(F.when(done & (c("flag") == "N"), c("cents") * c("disc"))).alias("done_n"),
        F.sum(c("cents") * c("tax")).alias("taxed"),
    ]
    for out, (cond, value, _) in {**INDICATORS, **SCORES}.items():
        sums += [F.count_if(F.expr(cond)).alias(f"n_{out}"), F.sum(F.when(F.expr(cond), F.expr(value))).alias(f"s_{out}")]
    rows = lines(spark, sf, grain).groupBy("l_suppkey", "year").agg(*sums)
    return rows.select(_code("l_suppkey").alias("iso_code"), *[n for n in rows.columns if n != "l_suppkey"])


def wide_of(rows: DataFrame, names: DataFrame) -> DataFrame:
    amount = lambda c, unit: (F.col(c).cast("double") / unit)
    return (
        rows.select(
            "iso_code", "year", F.col("qty").cast("double").alias("population"), amount("open_net", 999983.0).alias("gdp"),
            amount("done", 9973.0).alias("co2"), amount("done_r", 9973.0).alias("coal_co2"),
            amount("done_a", 9973.0).alias("gas_co2"), amount("done_n", 999983.0).alias("oil_co2"),
            amount("taxed", 999983.0).alias("energy"))
        .withColumn("co2_per_capita", F.col("co2") / F.col("population"))
        .withColumn("energy_per_capita", F.col("energy") / F.col("population"))
        .drop("energy")
        .join(names.select("iso_code", "country"), "iso_code", "left")
    )


def by_period_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("year").agg(
        (F.sum("disc").cast("double") / F.sum("n").cast("double") / 4.99).alias("temperature_anomaly"))


def means_of(rows: DataFrame, specs: dict) -> DataFrame:
    mean = lambda out, divisor: F.when(
        F.col(f"n_{out}") > 0, F.col(f"s_{out}").cast("double") / F.col(f"n_{out}").cast("double") / divisor)
    return rows.select("iso_code", "year", *[mean(out, d).alias(out) for out, (_, _, d) in specs.items()]).filter(
        F.coalesce(*specs).isNotNull())


def wide(spark, sf, grain="year") -> DataFrame:
    return wide_of(base(spark, sf, grain), suppliers(spark, sf))


def by_period(spark, sf, grain="year") -> DataFrame:
    return by_period_of(base(spark, sf, grain))


def indicators(spark, sf, grain="year") -> DataFrame:
    return means_of(base(spark, sf, grain), INDICATORS)


def scores(spark, sf, grain="year") -> DataFrame:
    return means_of(base(spark, sf, grain), SCORES)


def indicator(spark, sf, out: str, grain="year") -> DataFrame:
    """One indicator as its own source, from the lines it covers."""
    cond, value, _ = INDICATORS[out]
    return lines(spark, sf, grain).filter(cond).groupBy("iso_code", "year").agg(
        (F.sum(F.expr(value)).cast("double") / F.count("*").cast("double")).alias(out)
    )


# out column -> (condition, value, divisor); the texts are valid in both engines
INDICATORS = {
    "electricity_access_pct": ("qty >= 46", "qty * 2", 1.0),
    "electric_power_kwh_pc": ("disc >= 10", "cents", 1.0),
    "energy_use_kg_oil_pc": ("tax >= 8", "qty", 1.0),
}
SCORES = {
    "ndgain_score": ("qty = 25", "disc", 0.997),
    "vulnerability_score": ("qty > 47", "disc", 9.97),
    "readiness_score": ("qty < 4", "tax", 9.97),
}


def lookup(spark, sf) -> DataFrame:
    """Continent = region of the supplier (one region left out), income group by balance."""
    nation = F.broadcast(table(spark, sf, "nation"))
    region = F.broadcast(table(spark, sf, "region").filter("r_name <> 'MIDDLE EAST'"))
    return (
        suppliers(spark, sf)
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "iso_code", F.col("r_name").alias("continent"),
            F.when(F.col("s_acctbal") > 6000, "High").when(F.col("s_acctbal") > 0, "Low").alias("income_group"),
        )
    )


def fact(spark, sf, grain="year") -> DataFrame:
    """The four sources come from one stored pass over the lines, so these are scanned once."""
    rows = store(base(spark, sf, grain), "base")
    return star.build_fact(
        wide_of(rows, suppliers(spark, sf)), by_period_of(rows), means_of(rows, INDICATORS), means_of(rows, SCORES), unique=True)


def stored_fact(spark, sf, grain="year") -> DataFrame:
    """The fact as a stored table, as a job after the build would read it."""
    return store(fact(spark, sf, grain), "fact")


def _mean_sql(cond, value, scale=1.0):
    return (f"CASE WHEN count(*) FILTER (WHERE {cond}) > 0 THEN CAST(sum({value}) FILTER (WHERE {cond}) AS DOUBLE)"
            f" / CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) / {scale}::DOUBLE END")


def _means_cte(specs):
    items = ", ".join(
        f"{_mean_sql(*spec)} AS {out}" for out, spec in specs.items()
    )
    any_known = ", ".join(specs)
    return f"SELECT * FROM (SELECT iso_code, year, {items} FROM li GROUP BY iso_code, year) WHERE coalesce({any_known}) IS NOT NULL"


def source_ctes(grain="year") -> str:
    """``li``, ``wide``, ``temp``, ``wb``, ``nd``, ``lookup`` as a WITH list (without WITH)."""
    return f"""
li AS (
  SELECT 'S' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS iso_code, {PERIOD_SQL[grain]} AS year,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(round(l_discount * 100) AS BIGINT) AS disc,
         CAST(round(l_tax * 100) AS BIGINT) AS tax, CAST(l_quantity AS BIGINT) AS qty,
         l_returnflag AS flag, l_linestatus AS status
  FROM lineitem),
sup AS (
  SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS iso_code, s_name AS country, s_nationkey, s_acctbal
  FROM supplier),
agg AS (
  SELECT iso_code, year, CAST(sum(qty) AS DOUBLE) AS population,
         CAST(sum(CASE WHEN status = 'O' THEN cents * (100 - disc) END) AS DOUBLE) / 999983::DOUBLE AS gdp,
         CAST(sum(CASE WHEN status = 'F' THEN cents END) AS DOUBLE) / 9973::DOUBLE AS co2,
         CAST(sum(CASE WHEN status = 'F' AND flag = 'R' THEN cents END) AS DOUBLE) / 9973::DOUBLE AS coal_co2,
         CAST(sum(CASE WHEN status = 'F' AND flag = 'A' THEN cents END) AS DOUBLE) / 9973::DOUBLE AS gas_co2,
         CAST(sum(CASE WHEN status = 'F' AND flag = 'N' THEN cents * disc END) AS DOUBLE) / 999983::DOUBLE AS oil_co2,
         CAST(sum(cents * tax) AS DOUBLE) / 999983::DOUBLE AS energy
  FROM li GROUP BY iso_code, year),
wide AS (
  SELECT agg.iso_code, year, population, gdp, co2, coal_co2, gas_co2, oil_co2, co2 / population AS co2_per_capita,
         energy / population AS energy_per_capita, country
  FROM agg LEFT JOIN sup ON agg.iso_code = sup.iso_code),
temp AS (
  SELECT year, CAST(sum(disc) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 4.99::DOUBLE AS temperature_anomaly
  FROM li GROUP BY year),
wb AS ({_means_cte(INDICATORS)}),
nd AS ({_means_cte(SCORES)}),
lookup AS (
  SELECT iso_code, r_name AS continent,
         CASE WHEN s_acctbal > 6000 THEN 'High' WHEN s_acctbal > 0 THEN 'Low' END AS income_group
  FROM sup JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'MIDDLE EAST')"""


def growth_sql(col="co2") -> str:
    now = f"last_value({col} IGNORE NULLS) OVER (PARTITION BY iso_code ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = f"last_value({col} IGNORE NULLS) OVER (PARTITION BY iso_code ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (f"CASE WHEN {before} <> 0 THEN ({now} / {before} - 1) * 100"
            f" WHEN {before} = 0 AND {now} > 0 THEN CAST('inf' AS DOUBLE)"
            f" WHEN {before} = 0 AND {now} < 0 THEN CAST('-inf' AS DOUBLE) END")


def _fill_sql(col) -> str:
    return (f"coalesce(last_value({col} IGNORE NULLS) OVER (PARTITION BY iso_code ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),"
            f" first_value({col} IGNORE NULLS) OVER (PARTITION BY iso_code ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {col}")


FILL = [*INDICATORS, *SCORES]


def fact_ctes(grain="year") -> str:
    """The sources plus ``fact``."""
    shares = ", ".join(f"CASE WHEN co2 > 0 THEN {f}_co2 / co2 * 100 END AS {f}_share" for f in ("coal", "gas", "oil"))
    return source_ctes(grain) + f""",
joined AS (
  SELECT wide.*, temperature_anomaly, {", ".join(FILL)}
  FROM wide LEFT JOIN temp USING (year) LEFT JOIN wb USING (iso_code, year) LEFT JOIN nd USING (iso_code, year)),
shares AS (
  SELECT *, CASE WHEN gdp / nullif(population, 0) > 0 THEN energy_per_capita / (gdp / nullif(population, 0)) END AS energy_intensity,
         {shares} FROM joined),
residual AS (
  SELECT *, CASE WHEN coalesce(coal_share, gas_share, oil_share) IS NOT NULL THEN
           least(greatest(100 - (coalesce(coal_share, 0) + coalesce(gas_share, 0) + coalesce(oil_share, 0)), 0), 100) END AS renewables_share
  FROM shares),
fact AS (
  SELECT * EXCLUDE ({", ".join(FILL)}), renewables_share - coal_share AS sustainability_score,
         {growth_sql()} AS co2_growth_rate,
         CASE WHEN count(co2_per_capita) OVER r5 >= 2 THEN avg(co2_per_capita) OVER r5 END AS co2_per_capita_5yr_avg,
         {", ".join(_fill_sql(c) for c in FILL)}
  FROM residual
  WINDOW r5 AS (PARTITION BY iso_code ORDER BY year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
dim_country AS (
  SELECT CAST(row_number() OVER (ORDER BY iso_code) AS INTEGER) AS country_id, country_name,
         coalesce(continent, 'Other') AS continent, coalesce(income_group, 'Unknown') AS income_group, iso_code
  FROM (SELECT iso_code, min_by(country, year) AS country_name FROM fact GROUP BY iso_code) LEFT JOIN lookup USING (iso_code))"""


def with_fact(body: str, grain="year", more: str = "") -> str:
    return f"WITH {fact_ctes(grain)}{(', ' + more) if more else ''} {body}"


def with_sources(body: str, grain="year", more: str = "") -> str:
    return f"WITH {source_ctes(grain)}{(', ' + more) if more else ''} {body}"
