"""Per-entity window expressions.

Every window here is partitioned by the entity and ordered by the period. The panel is unique
on (entity, period) before any of them runs (``relational.keep_one``), so one window group never
holds more rows than there are periods, however many source rows an entity has.
Expressions that share the same window spec are planned as one exchange, one sort and one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.config import ENTITY, PERIOD
from panelkit.functions.expressions import INF


def history(entity=ENTITY, period=PERIOD):
    return Window.partitionBy(entity).orderBy(period)


def percent_change(value: str, entity=ENTITY, period=PERIOD) -> Column:
    """Change against the previous known value, in percent.

    A gap repeats the last known value, so it reads as 0 % and the next value is compared with
    the one before the gap. A zero base gives +-inf, and 0 -> 0 gives NULL.
    """
    w = history(entity, period)
    now = F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return (F.when(before != 0, (now / before - 1) * 100)
            .when((before == 0) & (now > 0), INF)
            .when((before == 0) & (now < 0), -INF))


def rolling_mean(value: str, rows=5, min_values=2, entity=ENTITY, period=PERIOD) -> Column:
    """Mean over the last ``rows`` rows, given at least ``min_values`` known values."""
    w = history(entity, period).rowsBetween(-(rows - 1), 0)
    return F.when(F.count(value).over(w) >= min_values, F.avg(value).over(w))


def fill_both(value: str, entity=ENTITY, period=PERIOD) -> Column:
    """Forward fill, then backward fill what is still missing at the start.

    After the forward fill only rows before the first known value are missing, so the backward
    fill is that value: one frame over the whole series, not one per row.
    """
    w = history(entity, period)
    return F.coalesce(
        F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        F.first(value, True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )


def lag_change(df: DataFrame, value: str, period=PERIOD, out="yoy_growth_pct", digits=2) -> DataFrame:
    """Percent change against the previous row of a one-row-per-period table.

    For aggregated tables only: the window has no partition, so the input must be one row per
    period.
    """
    before = F.lag(value).over(Window.orderBy(period))
    return df.withColumn(out, F.round(F.when(before != 0, (F.col(value) - before) / before * 100), digits))


def lagged_sequences(df: DataFrame, value: str, steps=5, entity=ENTITY, period=PERIOD) -> DataFrame:
    """Rows with the ``steps`` previous values as ``lag_1`` ... ``lag_n``; incomplete rows drop out."""
    w = history(entity, period)
    lags = {f"lag_{i}": F.lag(value, i).over(w) for i in range(1, steps + 1)}
    return df.withColumns(lags).dropna(subset=[value, *lags])


def standardise_by_entity(df: DataFrame, value: str, entity=ENTITY, out="z") -> DataFrame:
    """(value - mean) / population std of the entity's own series; a flat series drops out."""
    w = Window.partitionBy(entity)
    return (
        df.withColumns({
            "series_mean": F.avg(value).over(w),
            "series_std": F.stddev_pop(value).over(w),
        })
        .filter(F.col("series_std") > 0)
        .withColumn(out, (F.col(value) - F.col("series_mean")) / F.col("series_std"))
    )
