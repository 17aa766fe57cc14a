"""Isolation forest: trees grown on small samples drawn by hash, all rows scored in the JVM.

Growing a tree needs at most ``sample`` rows whatever the size of the table, so the work that
grows with the data is one pass for the column statistics, one that draws the samples and one
that scores. Every draw (rows of a tree, feature and cut of a node) is a hash of the seed and of what is
drawn for, so the same table gives the same forest on any number of machines.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from panelkit import config
from panelkit.config import ENTITY, PERIOD
from panelkit.functions.draws import fraction, fraction_of
from panelkit.functions.expressions import finite
from panelkit.operators.quantiles import exact_quantiles, quantile_columns
from panelkit.operators.trees import TABLE, Node, sum_over_trees, trees_of
from panelkit.session import spread, store

EULER = 0.5772156649015329


def average_depth(n):
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + EULER) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def prepare(df: DataFrame, features: Sequence[str], known: str) -> DataFrame:
    """Rows with ``known`` set; missing or infinite features become the column median; then
    standardised with the population deviation. Result columns ``z_<feature>``."""
    rows = df.filter(F.col(known).isNotNull()).withColumns({f"z_{f}": finite(F.col(f)) for f in features})
    rows = spread(store(rows, "forest"))
    z = [f"z_{f}" for f in features]
    medians = quantile_columns(rows, z, {"m": 0.5}).first()
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(medians[f"m_{c}"]), F.lit(0.0)) for c in z})
    s = rows.agg(*[g(c).alias(f"{n}_{c}") for c in z for n, g in (("mean", F.avg), ("std", F.stddev_pop))]).first()
    return rows.withColumns({c: (F.col(c) - (s[f"mean_{c}"] or 0.0)) / (s[f"std_{c}"] or 1.0) for c in z})


def _grow(x: np.ndarray, limit: int, name: str) -> list[Node]:
    """Nodes whose value is the path length; a node's draws go by the tree's name and its place in a full tree."""
    nodes: list = []

    def build(rows, depth, place):
        at = len(nodes)
        nodes.append(None)
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (rows, rows)
        span = np.flatnonzero(high > low) if len(rows) > 1 else []
        if depth >= limit or len(span) == 0:
            nodes[at] = Node(-1, 0.0, -1, -1, depth + float(average_depth(len(rows))), len(rows))
            return at
        f = int(span[int(fraction(f"{name}:{place}:feature") * len(span))])
        cut = float(low[f] + fraction(f"{name}:{place}:cut") * (high[f] - low[f]))
        if cut >= high[f]:  # by rounding
            cut = float(low[f])
        below = rows[:, f] <= cut
        nodes[at] = Node(f, cut, build(rows[below], depth + 1, 2 * place), build(rows[~below], depth + 1, 2 * place + 1), 0.0, len(rows))
        return at

    build(x, 0, 1)
    return nodes


def draw_samples(rows: DataFrame, ids: Sequence[str], n: int, trees: int, sample: int, seed: int) -> DataFrame:
    """About a quarter more than ``sample`` rows per tree, with ``tree`` and ``draw``, the number that orders them.

    A row joins a tree with the same small probability everywhere, so no ranking over the table is needed. A
    first draw thins a large table to the rows any tree can use. Then a row draws a few trees, as many as it
    would join on average; in a table of few rows it is asked for every tree instead.
    """
    keep = min(1.0, trees * sample * 1.25 / n)
    per_tree = min(1.0, sample * 1.25 / (n * keep))
    key = [F.col(c) for c in ids]
    pool = rows.filter(fraction_of(F.lit(seed), F.lit("pool"), *key) < keep)
    if per_tree >= 0.5:
        asked = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        return asked.withColumn("draw", fraction_of(F.lit(seed), F.col("tree"), *key)).filter(F.col("draw") < per_tree)
    joins = -trees * log(1 - per_tree)  # drawing one tree twice is made up for
    slots = ceil(joins)
    slot = F.col("slot")
    drawn = pool.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).filter(fraction_of(F.lit(seed), F.lit("join"), slot, *key) < joins / slots)
    drawn = drawn.withColumn("tree", F.floor(fraction_of(F.lit(seed), F.lit("tree"), slot, *key) * trees).cast("int")).drop("slot")
    return drawn.withColumn("draw", fraction_of(F.lit(seed), F.col("tree"), *key))


def grow_forest(rows: DataFrame, columns: Sequence[str], ids: Sequence[str], trees: int, sample: int, seed: int) -> tuple[list[list[Node]], int]:
    """(trees, rows per tree); the forest's size depends on its parameters only."""
    n = rows.count()
    if n == 0:
        return [], 0
    size = min(sample, n)
    limit = max(1, ceil(log2(max(size, 2))))
    columns, ids = list(columns), list(ids)
    names = [f.split()[0] for f in TABLE.split(", ")]

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.drop_duplicates(ids).sort_values(["draw", *ids], kind="stable")[columns].to_numpy(dtype=float)[:size]
        nodes = _grow(x, limit, f"{seed}:{tree}")
        return pd.DataFrame([(tree, i, *node) for i, node in enumerate(nodes)], columns=names)

    tasks = min(trees, rows.sparkSession.sparkContext.defaultParallelism)  # little data, much work
    drawn = draw_samples(rows.select(*ids, *columns), ids, n, trees, sample, seed).repartition(tasks, "tree")
    return trees_of(drawn.groupBy("tree").applyInPandas(grow, TABLE)), size


def isolation_forest(
    df: DataFrame, features: Sequence[str] = tuple(config.ANOMALY_FEATURES), contamination: float = 0.05,
    trees: int = 200, sample: int = 256, seed: int = 42, known: str = "co2_per_capita", min_features: int = 3,
    ids: Sequence[str] = (ENTITY, PERIOD),
) -> DataFrame:
    """The rows with ``anomaly_score`` (lower = more anomalous) and ``is_anomaly``.

    The score is offset by its exact ``contamination`` quantile, so the flagged rows are those
    below zero.
    """
    features = [f for f in features if f in df.columns]
    if len(features) < min_features:
        return df.limit(0).withColumns({"anomaly_score": F.lit(0.0), "is_anomaly": F.lit(0)})
    rows = prepare(df, features, known)
    z = [f"z_{f}" for f in features]
    forest, size = grow_forest(rows, z, ids, trees, sample, seed)
    if not forest:
        return df.limit(0).withColumns({"anomaly_score": F.lit(0.0), "is_anomaly": F.lit(0)})
    norm = float(average_depth(size)) or 1.0
    depth = sum_over_trees(forest, [F.col(c) for c in z]) / len(forest)
    # Rounded, so that rows of equal paths have equal scores in whatever order the trees were added.
    scored = store(rows.withColumn("raw_score", F.round(-F.pow(F.lit(2.0), -depth / norm), 12)).drop(*z), "scored")
    offset = exact_quantiles(scored, ["raw_score"], [contamination]).first()["value"]
    out = scored.withColumn("anomaly_score", F.col("raw_score") - F.lit(offset)).drop("raw_score")
    return out.withColumn("is_anomaly", (F.col("anomaly_score") < 0).cast("int"))
