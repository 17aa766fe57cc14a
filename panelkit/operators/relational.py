"""Selections, joins, reshaping and keys on panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.config import ENTITY, PERIOD
from panelkit.functions.expressions import try_number
from panelkit.session import store

def attach(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a table of one row per key to a big table whose keys may be very uneven.

    The key table is stored, so the planner knows its size in bytes: it broadcasts a small one (no
    shuffle, however uneven the keys) and sorts and merges otherwise, where adaptive execution
    splits the partitions that a hot key fills. Equal rows of the big side are split like any others.
    """
    return big.join(store(small, "attach"), list(keys), how)


def keep_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Projection that keeps the listed columns that exist, in the listed order."""
    return df.select([F.col(f"`{c}`") for c in columns if c in df.columns])


def without_names(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Drop rows whose name is in a fixed set; a missing name stays."""
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(list(names)))


def without_listed(df: DataFrame, listed: DataFrame, on: str) -> DataFrame:
    """The same when the set is a table."""
    return df.join(listed.select(on), on, "left_anti")


def latest_value(df: DataFrame, period=PERIOD) -> Column:
    """``max(period)`` as a scalar subquery."""
    return df.agg(F.max(period)).scalar()


def latest_slice(df: DataFrame, period=PERIOD, of: DataFrame | None = None) -> DataFrame:
    """Rows of the last period found in ``of`` (default: the table itself)."""
    return df.filter(F.col(period) == latest_value(df if of is None else of, period))


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under a total order.

    ``row_number = 1`` is planned with a group limit on both sides of the shuffle, so a key with
    many copies sends one row per task, not all of them.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def latest_per_entity(df: DataFrame, known: str, entity=ENTITY, period=PERIOD) -> DataFrame:
    """Per entity, the last row where ``known`` has a value."""
    return keep_one(df.filter(F.col(known).isNotNull()), [entity], [F.desc(period)])


def last_periods(df: DataFrame, n: int, entity=ENTITY, period=PERIOD) -> DataFrame:
    w = Window.partitionBy(entity).orderBy(F.desc(period))
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str] = (ENTITY,)) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), *ties).limit(k)


def bottom_k(df: DataFrame, by: str, k: int, ties: Sequence[str] = (ENTITY,)) -> DataFrame:
    """The end of a descending ranking: missing values rank last, so they come first here."""
    return df.orderBy(F.asc_nulls_first(by), *[F.desc(t) for t in ties]).limit(k)


def ranked(df: DataFrame, by: str, ties: Sequence[str] = (ENTITY,)) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), *ties)


def search(df: DataFrame, text: str, columns: Sequence[str], k=15, order: Sequence[str] = (ENTITY,)) -> DataFrame:
    """Case-insensitive substring match on any of the columns, first ``k`` in order."""
    needle = text.lower().strip()
    if not needle:
        return df.limit(0)
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(c).contains(needle), F.lit(False))
    return df.filter(hit).orderBy(*order).limit(k)


def enrich(facts: DataFrame, other: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join that replaces same-named columns instead of duplicating them."""
    clashing = [c for c in columns if c in facts.columns and c not in on]
    return facts.drop(*clashing).join(other.select(*on, *columns), list(on), "left")


def full_outer(frames: Sequence[DataFrame], keys: Sequence[str] = (ENTITY, PERIOD)) -> DataFrame:
    """N-way full outer join of tables unique on the keys, in one shuffle.

    The frames are stacked with each other's columns as NULL and grouped once; with unique keys
    that equals a chain of N-1 full outer joins.
    """
    keys = list(keys)
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def wide_to_long(df: DataFrame, ids: Sequence[str], value: str, period=PERIOD) -> DataFrame:
    """Unpivot columns named by a year; every other column drops out."""
    periods = [c for c in df.columns if c not in ids and c.strip().isdigit()]
    if not periods:
        schema = df.select(*ids, F.lit(0).alias(period), F.lit(0.0).alias(value))
        return schema.limit(0)
    typed = df.select(*ids, *[try_number(F.col(f"`{c}`")).alias(c) for c in periods])
    return (
        typed.unpivot(list(ids), [F.col(f"`{c}`") for c in periods], period, value)
        .withColumn(period, F.col(period).try_cast("int"))
        .dropna(subset=[period])
    )


def dense_key(df: DataFrame, key: str, out: str) -> DataFrame:
    """Number the distinct keys 1..n in key order (long), without passing them through one task.

    Spark deals the keys into ranges, as many as there are shuffle partitions. The written table
    fixes the ranges; each is numbered on its own and moved by the number of keys in those before.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    ranged = store(keys.repartitionByRange(parts, key).withColumn("_range", F.spark_partition_id()), "keys")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy(key)
    return (
        ranged.withColumn("_pos", F.row_number().over(within))
        .join(F.broadcast(offsets), "_range")
        .select(key, (F.col("_offset") + F.col("_pos")).cast("long").alias(out))
    )
