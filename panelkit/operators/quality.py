"""Declarative quality checks.

A suite is a list of checks. Everything that is a plain aggregate (row count, missing rates,
ranges, freshness, numeric conversion) of all checks of a suite runs in one pass over the data;
only duplicates (a grouping) and outliers (quantiles) add passes of their own. The outcome is a
report DataFrame: dataset, check, passed, severity, details.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from panelkit.functions.expressions import try_number
from panelkit.operators.quantiles import quantile_columns

REPORT_SCHEMA = "dataset string, `check` string, passed boolean, severity string, details string"
INFO, WARNING, CRITICAL = "INFO", "WARNING", "CRITICAL"


@dataclass(frozen=True)
class Outcome:
    """One check: aggregates it needs, and the report fields over those aggregates."""
    name: str
    passed: Column
    severity: Column
    details: Column
    aggregates: dict[str, Column] = field(default_factory=dict)
    applies: Column | None = None
    own_row: DataFrame | None = None  # one-row input of a check that needs a pass of its own


def _number_text(value) -> str:
    return "None" if value is None else str(value)


def _python_list(items: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


def row_count(min_rows=100):
    def check(df: DataFrame, i: int):
        n = F.col(f"n_{i}")
        ok = n >= min_rows
        yield Outcome(
            "row_count", ok, F.when(ok, INFO).otherwise(CRITICAL),
            F.format_string(f"%,d rows (minimum: {min_rows:,})", n), {f"n_{i}": F.count("*")},
        )
    return check


def schema(required: Sequence[str], optional: Sequence[str] = ()):
    """Column names only: no job is run."""
    def check(df: DataFrame, i: int):
        missing = [c for c in required if c not in df.columns]
        if missing:
            text = f"Missing required columns: {_python_list(missing)}"
        else:
            extra = set(df.columns) - set(required) - set(optional)
            text = f"All {len(required)} required columns present, {len(extra)} extra"
        yield Outcome("schema_check", F.lit(not missing), F.lit(CRITICAL if missing else WARNING), F.lit(text))
    return check


def null_rates(columns: Sequence[str], max_rate=0.5):
    def check(df: DataFrame, i: int):
        for c in columns:
            if c not in df.columns:
                continue
            key = f"null_{i}_{c}"
            rate = F.coalesce(F.col(f"`{key}`"), F.lit(0.0))
            yield Outcome(
                f"null_rate[{c}]", rate <= max_rate, F.when(rate <= 0.8, WARNING).otherwise(CRITICAL),
                F.format_string(f"%.1f%% null (threshold: {max_rate * 100:.0f}%%)", rate * 100),
                {key: F.avg(F.col(f"`{c}`").isNull().cast("double"))},
            )
    return check


def value_range(column: str, low=None, high=None):
    def check(df: DataFrame, i: int):
        if column not in df.columns:
            return
        v = try_number(F.col(f"`{column}`"))
        bad = F.lit(False)
        if low is not None:
            bad = bad | (v < low)
        if high is not None:
            bad = bad | (v > high)
        n, known = F.col(f"bad_{i}"), F.col(f"known_{i}")
        yield Outcome(
            f"range_check[{column}]", n == 0, F.lit(WARNING),
            F.format_string(f"%d values outside [{_number_text(low)}, {_number_text(high)}]", n),
            {f"bad_{i}": F.count_if(bad), f"known_{i}": F.count(v)}, known > 0,
        )
    return check


def freshness(column="year", expected=2020):
    def check(df: DataFrame, i: int):
        if column not in df.columns:
            return
        last = F.col(f"last_{i}")
        ok = last >= expected
        yield Outcome(
            "freshness_check", ok, F.when(ok, INFO).otherwise(WARNING),
            F.format_string(f"Latest year: %d (expected >= {expected})", last),
            {f"last_{i}": F.max(try_number(F.col(f"`{column}`"))).cast("int")}, last.isNotNull(),
        )
    return check


def numeric_columns(columns: Sequence[str]):
    def check(df: DataFrame, i: int):
        for c in columns:
            if c not in df.columns:
                continue
            kind = df.schema[c].dataType
            if isinstance(kind, T.NumericType):
                yield Outcome(f"type_check[{c}]", F.lit(True), F.lit(INFO), F.lit(f"Column is {kind.simpleString()}"))
                continue
            key = f"text_{i}_{c}"
            col = F.col(f"`{c}`")
            n = F.col(f"`{key}`")
            yield Outcome(
                f"type_check[{c}]", n == 0, F.lit(WARNING), F.format_string("%d non-numeric values found", n),
                {key: F.count_if(col.isNotNull() & try_number(col).isNull())},
            )
    return check


def duplicates(keys: Sequence[str]):
    """All members of duplicate groups count; missing keys are equal to each other.

    Grouping combines equal keys before the shuffle, so one key holding many rows is one row per
    task by then.
    """
    def check(df: DataFrame, i: int):
        n = F.col("members")
        members = df.groupBy(*keys).count().filter("count > 1").agg(
            F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("members"))
        yield Outcome(
            "duplicate_check", n == 0, F.when(n < 100, WARNING).otherwise(CRITICAL),
            F.format_string(f"%d duplicate rows on {_python_list(keys)}", n), own_row=members,
        )
    return check


def outliers_iqr(column: str, multiplier=3.0):
    def check(df: DataFrame, i: int):
        if column not in df.columns:
            return
        v = F.col("v")
        known = df.select(try_number(F.col(f"`{column}`")).alias("v")).filter("v is not null")
        q = quantile_columns(known, ["v"], {"q1": 0.25, "q3": 0.75}).first()
        if q is None or q["q1_v"] is None:
            return
        reach = multiplier * (q["q3_v"] - q["q1_v"])
        low, high = q["q1_v"] - reach, q["q3_v"] + reach
        stats = known.agg(F.count("v").alias("n"), F.count_if((v < low) | (v > high)).alias("out"))
        rate = F.when(F.col("n") > 0, F.col("out") / F.col("n"))
        ok = rate < 0.05
        yield Outcome(
            f"outlier_iqr[{column}]", ok, F.when(ok, INFO).otherwise(WARNING),
            F.format_string("%d outliers (%.1f%%) outside [%.2f, %.2f]", F.col("out"), rate * 100, F.lit(low), F.lit(high)),
            applies=F.col("n") >= 10, own_row=stats,
        )
    return check


def _report_rows(one: DataFrame, dataset: str, outcomes: Sequence[Outcome]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(o.name).alias("check"),
            o.passed.alias("passed"),
            o.severity.alias("severity"),
            o.details.alias("details"),
            (F.lit(True) if o.applies is None else F.coalesce(o.applies, F.lit(False))).alias("applies"),
        )
        for o in outcomes
    ]
    return (
        one.select(F.explode(F.array(*rows)).alias("r")).select("r.*").filter("applies")
        .select("dataset", "check", "passed", "severity", "details")
    )


def run_suite(df: DataFrame, dataset: str, checks: Sequence) -> DataFrame:
    """Run the checks of one dataset; one report row per check that applies."""
    outcomes = [o for i, check in enumerate(checks) for o in check(df, i)]
    shared = [o for o in outcomes if o.own_row is None]
    aggregates = {k: c for o in shared for k, c in o.aggregates.items()}
    reports = [_report_rows(o.own_row, dataset, [o]) for o in outcomes if o.own_row is not None]
    if shared:
        one = df.agg(*[c.alias(k) for k, c in aggregates.items()]) if aggregates else df.sparkSession.range(1)
        reports.insert(0, _report_rows(one, dataset, shared))
    return reduce(DataFrame.unionByName, reports)


def source_report(spark: SparkSession, dataset: str, present: bool) -> DataFrame:
    """Report row for a source that is absent (critical) or present."""
    return spark.createDataFrame(
        [(dataset, "source_present", present, INFO if present else CRITICAL,
          "source found" if present else "source not found")], REPORT_SCHEMA,
    )


def combine(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports).withColumn("timestamp", F.current_timestamp())


def summarise(report: DataFrame) -> DataFrame:
    """Totals, score and the gate: closed when a critical check failed."""
    failed = ~F.col("passed")
    return report.agg(
        F.count("*").alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count_if(failed & (F.col("severity") == CRITICAL)).alias("critical"),
    ).withColumns({
        "score_pct": F.when(F.col("total") > 0, F.round(F.col("passed") / F.col("total") * 100, 0)),
        "gate_open": F.col("critical") == 0,
    })


# Suites of the four sources, and the small expectation suites.
SUITES = {
    "OWID": [
        row_count(1000),
        schema(["country", "year", "iso_code", "co2", "population"],
               ["gdp", "co2_per_capita", "coal_co2", "gas_co2", "oil_co2", "methane", "nitrous_oxide", "total_ghg"]),
        null_rates(["country", "year", "co2"], 0.3),
        duplicates(["country", "year"]),
        freshness("year", 2020),
        value_range("year", 1750, 2030),
        value_range("co2", 0),
        outliers_iqr("co2_per_capita"),
        numeric_columns(["co2", "population", "gdp"]),
    ],
    "NASA": [row_count(50), schema(["Year", "J-D"]), freshness("Year", 2020), value_range("Year", 1880, 2030)],
    "INDICATOR": [
        row_count(500),
        schema(["REF_AREA", "TIME_PERIOD", "OBS_VALUE"]),
        null_rates(["REF_AREA", "TIME_PERIOD", "OBS_VALUE"], 0.3),
        numeric_columns(["TIME_PERIOD", "OBS_VALUE"]),
    ],
    "NDGAIN": [row_count(100), schema(["ISO3", "Name"])],
}


def expectation_suite(df: DataFrame, dataset: str, exist: Sequence[str], not_null: Sequence[str] = (),
                      between: dict[str, tuple] | None = None) -> DataFrame:
    """Columns exist, hold no NULL, and lie in a range; passes only if all hold."""
    checks = [schema([c]) for c in exist] + [null_rates([c], 0.0) for c in not_null]
    checks += [value_range(c, lo, hi) for c, (lo, hi) in (between or {}).items()]
    return run_suite(df, dataset, checks).groupBy("dataset").agg(
        F.count("*").alias("expectations"), F.count_if(~F.col("passed")).alias("failed"),
        F.bool_and("passed").alias("success"),
    )
