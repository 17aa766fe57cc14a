"""Histogram boosting against a plain version of the same rule, and what its parts have to keep."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import boosting
from panelkit.operators.boosting import BINS
from panelkit.operators.trees import Node, sum_over_trees, tree_table, trees_of


def rows_of(seed, n):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), np.full(n, 2.0), rng.exponential(size=n)])
    y = 3 * (x[:, 0] > 0.3) + x[:, 1] ** 2 + np.where(x[:, 3] > 1, x[:, 0], 0) + rng.normal(scale=0.1, size=n)
    return x, y


def stored(spark, x, y):
    from panelkit.session import store
    names = [f"f{i}" for i in range(x.shape[1])]
    data = [(*map(float, r), float(t)) for r, t in zip(x, y)]
    return store(spark.createDataFrame(data, ", ".join(f"{n} double" for n in names) + ", y double"), "rows"), names


def plain(x, y, trees, depth, rate, bins=BINS, l2=1.0):
    """Predictions of trees grown by trying every cut of every feature at every node."""
    cuts = []
    for f in range(x.shape[1]):
        v = np.sort(x[:, f])
        cuts.append(sorted({v[int(np.floor(k / bins * (len(v) - 1)))] for k in range(1, bins)} - {v[-1]}))
    out = np.full(len(y), y.mean())

    def grow(rows, depth):
        g = (out - y)[rows]
        best = (1e-6, None, None)
        if depth:
            for f, cs in enumerate(cuts):
                for c in cs:
                    left = x[rows, f] <= c
                    if left.any() and not left.all():
                        parts = [(g[m].sum(), m.sum()) for m in (left, ~left)]
                        gain = np.float32(sum(a * a / (b + l2) for a, b in parts) - g.sum() ** 2 / (len(g) + l2))
                        if gain > best[0]:
                            best = (gain, f, c)
        if best[1] is None:
            step[rows] = -rate * g.sum() / (len(g) + l2)
            return
        left = x[rows, best[1]] <= best[2]
        grow(rows[left], depth - 1)
        grow(rows[~left], depth - 1)

    for _ in range(trees):
        step = np.zeros(len(y))
        grow(np.arange(len(y)), depth)
        out = out + step
    return out


@pytest.mark.parametrize("seed, n, share", [(1, 400, 1 << 18), (2, 900, 200)])
def test_equals_the_plain_version(spark, monkeypatch, seed, n, share):
    """In one task, and when several share the rows."""
    monkeypatch.setattr(boosting, "ROWS_A_TASK", share)
    x, y = rows_of(seed, n)
    rows, names = stored(spark, x, y)
    model = boosting.fit(rows, names, "y", trees=5, depth=3, rate=0.3)
    got = {tuple(r[:4]): r.p for r in model.predict(rows, "p").select(*names, "p").collect()}
    want = plain(x, y, 5, 3, 0.3)
    assert np.allclose([got[tuple(r)] for r in x], want, atol=1e-9)
    assert boosting.r_squared(model.predict(rows), F.col("prediction"), F.col("y")) == pytest.approx(1 - ((y - want) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_leaf_values_are_sums_over_the_bins(spark):
    """Of the first tree, by SQL over rows and the table of nodes."""
    x, y = rows_of(3, 600)
    rows, names = stored(spark, x, y)
    model = boosting.fit(rows, names, "y", trees=1, depth=4, rate=0.1)
    con = duckdb.connect()
    con.register("nodes", model.table(spark).toPandas())
    con.register("rows_", rows.withColumn("id", F.monotonically_increasing_id()).toPandas())
    got = con.execute(f"""
WITH RECURSIVE walk AS (
  SELECT id, y, 0 AS node, [{', '.join(names)}] AS x FROM rows_
  UNION ALL SELECT id, y, CASE WHEN x[feature + 1] <= cut THEN "left" ELSE "right" END, x FROM walk JOIN nodes USING (node) WHERE feature >= 0),
leaves AS (SELECT node, -0.1 * sum((SELECT avg(y) FROM rows_) - y) / (count(*) + 1.0) AS value, count(*) AS n FROM walk JOIN nodes USING (node) WHERE feature < 0 GROUP BY node)
SELECT nodes.value, leaves.value, nodes.rows, n FROM nodes LEFT JOIN leaves USING (node) WHERE feature < 0""").fetchall()
    assert len(got) > 4 and all(a == pytest.approx(b) and m == n for a, b, m, n in got)


def test_walk_equals_recursion_and_tables_come_back(spark):
    trees = [[Node(0, 1.5, 1, 2, 0.0, 9), Node(-1, 0.0, -1, -1, 1.0, 4), Node(1, -2.0, 3, 4, 0.0, 5), Node(-1, 0.0, -1, -1, 2.0, 2), Node(-1, 0.0, -1, -1, 4.0, 3)],
             [Node(-1, 0.0, -1, -1, 8.0, 9)]]
    df = spark.createDataFrame([(1.5, 0.0), (1.6, -2.0), (1.6, -1.9)], "a double, b double")
    got = [r.s for r in df.select(sum_over_trees(trees, [F.col("a"), F.col("b")]).alias("s")).collect()]
    assert got == [9.0, 10.0, 12.0]
    assert trees_of(tree_table(spark, trees)) == trees


def test_no_python_while_scoring(spark):
    x, y = rows_of(4, 200)
    rows, names = stored(spark, x, y)
    plan = boosting.fit(rows, names, "y", trees=2, depth=2).predict(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan


def test_empty_and_constant(spark):
    rows, names = stored(spark, np.zeros((0, 2)), np.zeros(0))
    assert boosting.fit(rows, names, "y", trees=2).trees == []
    rows, names = stored(spark, np.ones((50, 2)), np.full(50, 4.0))
    model = boosting.fit(rows, names, "y", trees=2)
    assert [r.prediction for r in model.predict(rows).limit(2).collect()] == [4.0, 4.0] and all(len(t) == 1 for t in model.trees)


def test_a_feature_that_is_missing_counts_as_zero(spark):
    x, y = rows_of(5, 300)
    rows, names = stored(spark, x, y)
    model = boosting.fit(rows, names, "y", trees=3, depth=3)
    odd = spark.createDataFrame([(None, float("inf"), 1.0, float("nan"), 0.0), (0.0, 0.0, 1.0, 0.0, 0.0)], rows.schema)
    a, b = [r.prediction for r in model.predict(odd).collect()]
    assert a == b


def test_half_a_million_rows_need_few_jobs(spark, monkeypatch):
    """They grow their trees in one task; dealt out to shares they grow the same."""
    rows = spark.range(300_000).select(*[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 7.0).alias(f"f{i}") for i in range(3)])
    rows = rows.withColumn("y", F.col("f0") * 3 + F.when(F.col("f1") > 70, F.col("f2")).otherwise(0.0))
    from panelkit.session import store
    rows, context = store(rows, "rows"), spark.sparkContext
    context.setJobGroup("grow", "trees in one task")
    try:
        alone = boosting.fit(rows, ["f0", "f1", "f2"], "y", trees=15, depth=3)
        assert len(context.statusTracker().getJobIdsForGroup("grow")) < 40
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    monkeypatch.setattr(boosting, "ROWS_A_TASK", 100_000)
    shared = boosting.fit(rows, ["f0", "f1", "f2"], "y", trees=2, depth=3)
    for a, b in zip(alone.trees, shared.trees):
        assert [n[:4] + n[5:] for n in a] == [n[:4] + n[5:] for n in b]
        assert np.allclose([n.value for n in a], [n.value for n in b], rtol=1e-9)


def test_a_model_scores_as_the_walk_does_and_compiled(spark):
    """Cuts themselves, missing and infinite values included; no function of the plan is interpreted step by step."""
    x, y = rows_of(6, 500)
    rows, names = stored(spark, x, y)
    model = boosting.fit(rows, names, "y", trees=12, depth=4)
    cut = next(n.cut for n in model.trees[0] if n.feature == 0)
    odd = spark.createDataFrame([(cut, 1.0, 2.0, 0.5, 0.0), (None, float("inf"), float("nan"), -0.0, 0.0)], rows.schema)
    both = rows.unionByName(odd)
    told = model.predict(both, "told")
    assert told.columns == [*names, "y", "told"]
    clean = [F.when(F.col(n).isNull() | F.isnan(n) | (F.abs(n) == F.lit(float("inf"))), 0.0).otherwise(F.col(n)) for n in names]
    assert told.select(F.max(F.abs(F.col("told") - model.base - sum_over_trees(model.trees, clean)))).first()[0] < 1e-9
    assert "lambda" not in told._jdf.queryExecution().analyzed().toString()
    again = model.predict(told, "told")  # in place of a column
    assert again.columns == told.columns and again.filter(F.col("told").isNull()).isEmpty()
