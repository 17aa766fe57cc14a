"""Exact, linearly interpolated quantiles that never gather a group in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from panelkit.functions.expressions import try_number
from panelkit.operators.relational import attach
from panelkit.session import store

RANGES = 64  # that a bracket is cut into in one pass
ACCURACY = 100 * RANGES  # of the sketches
STATE = "metric string, prob double, fraction double, upper boolean, rank long, low double, high double, n long"


def _number(df: DataFrame, column: str) -> Column:
    """Numbers as they are; text that is no number is missing."""
    numeric = isinstance(df.schema[column].dataType, T.NumericType)
    return F.col(f"`{column}`").cast("double") if numeric else try_number(F.col(f"`{column}`"))


def _inside(long: DataFrame, wanted: DataFrame, group: list[str], fields: Sequence[str]) -> DataFrame:
    """The values that lie in a bracket of their group, once for each such bracket, with its fields."""
    brackets = wanted.groupBy(*group).agg(F.collect_list(F.struct(*fields)).alias("brackets"))  # two for each quantile at most
    rows = attach(long, brackets, group, "inner")
    own = F.filter("brackets", lambda b: (b["low"] <= F.col("value")) & (F.col("value") <= b["high"]))
    return rows.select(*group, "value", F.explode(own).alias("b")).select(*group, "value", "b.*")


def _narrowed(long: DataFrame, state: DataFrame, group: list[str]) -> DataFrame:
    """The state after one more pass: each wanted rank's bracket is one of the ranges of its old one.

    A mergeable sketch cuts every bracket into ranges of about as many values; the ranges are counted,
    with partial sums before the shuffle; the counts tell which range holds the rank. The sketch only
    has to be about right, as all that is used of it is checked by counting. An edge is a range by itself,
    so a value that most rows share is set apart, and each pass leaves less of a bracket.
    """
    key = [*group, "low", "high"]
    brackets = state.select(*key).distinct()
    inside = _inside(long, brackets, group, ["low", "high"])
    cuts = [i / RANGES for i in range(1, RANGES)]
    edges = store(inside.groupBy(*key).agg(F.array_distinct(F.percentile_approx("value", cuts, ACCURACY)).alias("edges")), "edges")
    ranged = _inside(long, edges, group, ["low", "high", "edges"])
    beside = F.aggregate("edges", F.lit(0), lambda n, e: n + (e < F.col("value")).cast("int") + (e <= F.col("value")).cast("int"))
    ranged = ranged.select(*key, "value", beside.alias("range"))
    counted = store(ranged.groupBy(*key, "range").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most")), "ranges")
    upto = Window.partitionBy(*key).orderBy("range")  # 2 * RANGES rows at most
    placed = counted.withColumn("end", F.sum("n").over(upto)).withColumn("start", F.col("end") - F.col("n"))
    found = state.drop("n").join(placed, key).filter((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("end")))
    return found.select(*group, "prob", "fraction", "upper", (F.col("rank") - F.col("start")).alias("rank"), F.col("least").alias("low"), F.col("most").alias("high"), "n")


def _sorted_values(column: pa.Array) -> np.ndarray:
    v = column.drop_null().to_numpy(zero_copy_only=False)
    return np.sort(v[~np.isnan(v)] + 0.0)  # zero has no sign


def _ranges_of_table(numbers: DataFrame, columns: Sequence[str], edges: Sequence[np.ndarray]) -> dict[str, list]:
    """Per column the rows (n, least, most) of the ranges that its sorted edges make, an edge being one itself.

    A task adds up what its batches hold, so it gives a row per range that it meets.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = [2 * len(e) + 1 for e in edges]
        n, least, most = ([np.full(k, v) for k in size] for v in (0, np.inf, -np.inf))
        for batch in batches:
            for i, e in enumerate(edges):
                v = _sorted_values(batch.column(i))
                ends = np.ravel([np.searchsorted(v, e, "left"), np.searchsorted(v, e, "right")], "F")
                start, end = np.append(0, ends), np.append(ends, len(v))
                met = np.flatnonzero(start < end)
                n[i][met] += (end - start)[met]
                least[i][met] = np.minimum(least[i][met], v[start[met]])
                most[i][met] = np.maximum(most[i][met], v[end[met] - 1])
        for i in range(len(edges)):
            met = np.flatnonzero(n[i])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(met), i), pa.int32()), pa.array(met, pa.int32()), pa.array(n[i][met], pa.int64()), pa.array(least[i][met]), pa.array(most[i][met])],
                                             ["i", "range", "n", "least", "most"])

    told = numbers.mapInArrow(run, "i int, range int, n long, least double, most double").groupBy("i", "range").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    out: dict[str, list] = {c: [] for c in columns}
    for r in sorted(told.collect(), key=lambda r: (r["i"], r["range"])):  # a few hundred rows a column
        out[columns[r["i"]]].append((r["n"], r["least"], r["most"]))
    return out


def _values_of_table(numbers: DataFrame, columns: Sequence[str], brackets: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """(metric, low, high, value): the values inside the brackets of their column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, c in enumerate(columns):
                if brackets.get(c):
                    v, (low, high) = _sorted_values(batch.column(i)), np.transpose(brackets[c])
                    start = np.searchsorted(v, low, "left")
                    n = np.searchsorted(v, high, "right") - start
                    total = int(n.sum())
                    at = np.repeat(start - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(total)
                    yield pa.RecordBatch.from_arrays([pa.array([c] * total, pa.string()), pa.array(np.repeat(low, n)), pa.array(np.repeat(high, n)), pa.array(v[at])], ["metric", "low", "high", "value"])

    return numbers.mapInArrow(run, "metric string, low double, high double, value double")


def _state_of_table(numbers: DataFrame, columns: Sequence[str], probs: Sequence[float], sort_rows: int, lower: bool) -> list[tuple]:
    """The wanted ranks of a table without groups after the first pass, as rows of ``STATE``.

    The sketch is asked for values a little below and above each rank, so few values are left between them.
    """
    near = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-2 / ACCURACY, 2 / ACCURACY)})
    parts = []
    for i, c in enumerate(numbers.columns):
        v = F.when(~F.isnan(c), F.col(c))
        parts += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"low{i}"), F.max(v).alias(f"high{i}"), F.percentile_approx(v, near, ACCURACY).alias(f"near{i}")]
    told = numbers.agg(*parts).first()
    edges = [np.unique(told[f"near{i}"]) if told[f"n{i}"] > sort_rows and told[f"low{i}"] < told[f"high{i}"] else np.empty(0) for i in range(len(columns))]
    ranges = _ranges_of_table(numbers, columns, edges) if any(map(len, edges)) else {}
    out = []
    for i, c in enumerate(columns):
        n = told[f"n{i}"]
        cut = ranges[c] if len(edges[i]) else [(n, told[f"low{i}"], told[f"high{i}"])]
        ends = np.cumsum([r[0] for r in cut])
        for p in probs if n else ():
            position = float(p) * (n - 1)
            for upper in ((False,) if lower else (False, True)):
                rank = ceil(position) if upper else floor(position)
                at = int(np.searchsorted(ends, rank, "right"))
                out.append((c, float(p), 0.0 if lower else position - floor(position), upper, rank - int(ends[at]) + cut[at][0], cut[at][1], cut[at][2], cut[at][0]))
    return out


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    sort_rows: int = 200_000,
    lower: bool = False,
) -> DataFrame:
    """Rows ``(*by, metric, prob, value)``: quantiles of the non-missing values.

    Spark's own ``percentile`` keeps every distinct value of a group in one buffer. Here a wanted rank
    is followed into ever smaller ranges of values: counts per range tell which one holds it, and only
    a range of at most ``sort_rows`` values is put in order. A group that holds most rows so costs a
    pass more for each factor of ``RANGES``, and no task gets more than ``sort_rows`` of its values.
    Without groups the values stay in their columns; tasks count batches and give what lies around the ranks only.
    ``lower``: the value at the rank rounded down, without interpolation.
    """
    by, columns = list(by), list(dict.fromkeys(columns))
    group = [*by, "metric"]
    long = (
        df.select(*by, *[_number(df, c).alias(c) for c in columns])
        .unpivot(by, list(columns), "metric", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    numbers = df.select(*[_number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    if not by:
        told = _state_of_table(numbers, columns, probs, sort_rows, lower)
        state = store(df.sparkSession.createDataFrame(told, STATE).coalesce(1), "ranks")
    else:
        totals = long.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        ranks = []
        for p in probs:
            position = F.lit(float(p)) * (F.col("n") - 1)
            fraction = F.lit(0.0) if lower else position - F.floor(position)
            for upper in ((False,) if lower else (False, True)):
                rank = F.ceil(position) if upper else F.floor(position)
                ranks.append(F.struct(F.lit(float(p)).alias("prob"), fraction.alias("fraction"), F.lit(upper).alias("upper"), rank.alias("rank")))
        state = store(totals.select(*group, "low", "high", "n", F.explode(F.array(*ranks)).alias("r")).select(*group, "r.*", "low", "high", "n"), "ranks")
    open_ = (F.col("low") < F.col("high")) & (F.col("n") > sort_rows)
    while not state.filter(open_).isEmpty():
        state = store(state.filter(~open_).unionByName(_narrowed(long, state.filter(open_), group)), "ranks")

    # What is left lies in brackets of one value or of few enough values to be put in order.
    key = [*group, "low", "high"]
    wide = state.filter("low < high")
    brackets = wide.select(*key).distinct()
    if not by:
        of: dict[str, list[tuple[float, float]]] = {}
        for r in brackets.collect():  # one for each quantile at most
            of.setdefault(r["metric"], []).append((r["low"], r["high"]))
        inside = _values_of_table(numbers, columns, of)
    else:
        inside = _inside(long, brackets, group, ["low", "high"])
    counted = inside.groupBy(*key, "value").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*key).orderBy("value")
    placed = counted.withColumn("end", F.sum("n").over(upto))
    # Beside the ends of the values, from the last one back, a rank finds the value that reaches over it.
    ends = placed.select(*key, F.col("end").cast("double").alias("at"), "value", F.lit(None).cast("double").alias("prob"), F.lit(None).cast("double").alias("fraction"), F.lit(None).cast("boolean").alias("upper"))
    ranks = wide.select(*key, (F.col("rank") + 0.5).alias("at"), F.lit(None).cast("double").alias("value"), "prob", "fraction", "upper")
    back = Window.partitionBy(*key).orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    found = ends.unionByName(ranks).withColumn("value", F.last("value", True).over(back)).filter("prob IS NOT NULL")
    sorted_ = found.select(*group, "prob", "fraction", "upper", "value")
    single = state.filter("low = high").select(*group, "prob", "fraction", "upper", F.col("low").alias("value"))
    found = sorted_.unionByName(single).groupBy(*group, "prob", "fraction").agg(
        F.max(F.when(~F.col("upper"), F.col("value"))).alias("lo"), F.max(F.when(F.col("upper"), F.col("value"))).alias("hi"))
    value = F.col("lo") if lower else F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("fraction")
    return found.select(*group, "prob", value.alias("value"))


def quantile_columns(df: DataFrame, columns: Sequence[str], probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """The same as one row per group with a column ``<name>_<column>`` each."""
    long = exact_quantiles(df, columns, list(probs.values()), by)
    picks = [
        F.max(F.when((F.col("metric") == c) & (F.col("prob") == float(p)), F.col("value"))).alias(f"{name}_{c}")
        for c in columns for name, p in probs.items()
    ]
    return long.groupBy(*by).agg(*picks)
