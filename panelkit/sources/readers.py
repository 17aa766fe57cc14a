"""Readers for the four source layouts and for stored stage tables.

Names come from the files' headers and every column is read as text (no inference pass); numbers are
made by ``try_number``, so masked values become NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelkit import config
from panelkit.config import ENTITY, PERIOD
from panelkit.functions.expressions import try_number
from panelkit.operators.relational import full_outer, keep_existing, keep_one, wide_to_long, without_names


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with every column as text: names come from the header, types from the caller."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_wide_panel(
    spark: SparkSession, path: str, columns: Sequence[str] = tuple(config.WIDE_COLUMNS),
    exclude: Sequence[str] = tuple(config.AGGREGATE_NAMES), start: int = config.START_PERIOD,
) -> DataFrame:
    """Wide entity-period file: listed columns that exist, real entities only, from ``start`` on."""
    raw = keep_existing(read_text_csv(spark, path), columns)
    typed = raw.select([
        F.col(c) if c in config.STRING_COLUMNS
        else F.col(c).try_cast("int").alias(c) if c == PERIOD
        else try_number(F.col(c)).alias(c)
        for c in raw.columns
    ])
    return without_names(typed, "country", exclude).filter(F.col(PERIOD) >= start).dropna(subset=[ENTITY])


def read_stacked_series(
    spark: SparkSession, path: str, value: str = "J-D", layout: Sequence[str] = tuple(config.TEMPERATURE_LAYOUT),
    out: str = "temperature_anomaly", start: int = config.START_PERIOD,
) -> DataFrame:
    """Series from a file of stacked tables with titles and repeated headers; the last table wins.

    Lines are read in parallel splits. A line's place in its file is (offset of the split, order
    within the split), so the last occurrence of a year needs no single-task pass over the file.
    """
    lines = spark.read.text(path).select(
        F.split("value", ",").alias("cells"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    cell = lambda name: F.try_element_at("cells", F.lit(layout.index(name) + 1))
    rows = lines.select(
        F.trim(cell(layout[0])).try_cast("int").alias(PERIOD),
        try_number(cell(value)).alias(out),
        "file", "block", "line",
    ).dropna(subset=[PERIOD])
    last = keep_one(rows, [PERIOD], [F.desc("file"), F.desc("block"), F.desc("line")])
    return last.filter(F.col(PERIOD) >= start).select(PERIOD, out)


def read_stacked_rows(spark: SparkSession, path: str) -> DataFrame:
    """The raw rows of a stacked file, for checks: columns named by the file's own first header line
    (one with "Year"); titles and headers left out, nothing parsed or dropped. Without a header no columns
    but ``line``."""
    lines = spark.read.text(path)
    header = lines.filter(F.trim(F.split("value", ",")[0]) == "Year").select("value").first()
    if header is None:
        return lines.select(F.col("value").alias("line"))
    names = [n.strip() for n in header[0].split(",")]
    cells = F.split("value", ",")
    rows = lines.filter(F.trim(cells[0]).rlike("^[0-9]"))
    return rows.select(*[F.trim(F.get(cells, F.lit(i))).alias(n) for i, n in enumerate(names)])


def read_indicator(spark: SparkSession, path: str, out: str, start: int = config.START_PERIOD) -> DataFrame:
    raw = read_text_csv(spark, path)
    return raw.select(
        F.col("REF_AREA").alias(ENTITY),
        F.col("TIME_PERIOD").try_cast("int").alias(PERIOD),
        try_number(F.col("OBS_VALUE")).alias(out),
    ).dropna(subset=[PERIOD]).filter(F.col(PERIOD) >= start)


def _one_per_key(df: DataFrame) -> DataFrame:
    value = [c for c in df.columns if c not in (ENTITY, PERIOD)]
    return keep_one(df, [ENTITY, PERIOD], [F.asc_nulls_last(c) for c in value])


def read_indicators(spark: SparkSession, files: dict[str, str], start: int = config.START_PERIOD) -> DataFrame:
    """N long indicator files, one value column each, joined on (entity, period)."""
    return full_outer([_one_per_key(read_indicator(spark, path, out, start)) for out, path in files.items()])


def read_year_matrix(spark: SparkSession, path: str, out: str) -> DataFrame:
    long = wide_to_long(read_text_csv(spark, path), ["ISO3", "Name"], out)
    return long.select(F.col("ISO3").alias(ENTITY), PERIOD, out)


def read_year_matrices(spark: SparkSession, files: dict[str, str], start: int = config.START_PERIOD) -> DataFrame:
    """N wide-by-year files, unpivoted and joined on (entity, period)."""
    joined = full_outer([_one_per_key(read_year_matrix(spark, path, out)) for out, path in files.items()])
    return joined.filter(F.col(PERIOD) >= start)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_table_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A stored table, or an empty one of the given schema when it is absent."""
    if path_exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)
