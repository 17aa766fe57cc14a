"""Trees of grown models as rows, as arrays, and walked in the JVM: by a column expression or by MLlib."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.functions.constants import constant


class Node(NamedTuple):
    """A node; its children are places in the same tree's list. ``feature`` -1 marks a leaf.

    A row goes left if its feature is at most ``cut``. ``value`` is what a leaf stands for, ``rows``
    the training rows that came by.
    """

    feature: int
    cut: float
    left: int
    right: int
    value: float
    rows: int


TABLE = "tree int, node int, feature int, cut double, left int, right int, value double, rows long"
ARRAYS = "array<struct<feature: array<int>, cut: array<double>, left: array<int>, value: array<double>>>"


def tree_table(spark: SparkSession, trees: Sequence[Sequence[Node]]) -> DataFrame:
    """One row per node. The size is set by the number and depth of the trees, not by the data."""
    return spark.createDataFrame([(t, i, *node) for t, nodes in enumerate(trees) for i, node in enumerate(nodes)], TABLE)


def trees_of(table: DataFrame) -> list[list[Node]]:
    trees: dict[int, list[Node]] = {}
    for r in table.orderBy("tree", "node").collect():
        trees.setdefault(r["tree"], []).append(Node(r["feature"], r["cut"], r["left"], r["right"], r["value"], r["rows"]))
    return list(trees.values())


def _depth(nodes: Sequence[Node], at: int = 0) -> int:
    node = nodes[at]
    return 0 if node.feature < 0 else 1 + max(_depth(nodes, node.left), _depth(nodes, node.right))


def _packed_order(nodes: Sequence[Node]) -> list[int]:
    """Level by level, so that a right child stands behind its left one."""
    order = [0]
    for at in order:
        if nodes[at].feature >= 0:
            order += [nodes[at].left, nodes[at].right]
    return order


def _packed(nodes: Sequence[Node]) -> dict[str, list]:
    """The tree level by level; a leaf leads to itself."""
    order = _packed_order(nodes)
    place = {at: i for i, at in enumerate(order)}
    inner = [nodes[at].feature >= 0 for at in order]
    return {
        "feature": [max(nodes[at].feature, 0) for at in order],
        "cut": [nodes[at].cut if own else 1.7e308 for at, own in zip(order, inner)],
        "left": [place[nodes[at].left] if own else place[at] for at, own in zip(order, inner)],
        "value": [nodes[at].value for at in order],
    }


def tree_walk(trees: Sequence[Sequence[Node]]) -> Callable[[Column], Column]:
    """A function of an array of feature values: the sum, over all trees, of the value of the leaf it falls into.

    The trees are one constant of the expression; nothing is joined and no Python worker is needed.
    Features must not be missing.
    """
    if not trees:
        return lambda x: F.lit(0.0)
    stored = constant([_packed(nodes) for nodes in trees], ARRAYS)
    steps = F.sequence(F.lit(1), F.lit(max(1, max(map(_depth, trees)))))

    def leaf(tree: Column, x: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            return F.get(tree["left"], at) + (F.get(x, F.get(tree["feature"], at)) > F.get(tree["cut"], at)).cast("int")

        return F.get(tree["value"], F.aggregate(steps, F.lit(0), step))

    return lambda x: F.aggregate(stored, F.lit(0.0), lambda total, tree: total + leaf(tree, x))


def sum_over_trees(trees: Sequence[Sequence[Node]], features: Sequence[Column]) -> Column:
    """The same of feature columns, which are bound once, so that a step reads them and does not compute them again."""
    walk = tree_walk(trees)
    return F.transform(F.array(F.array(*[f.cast("double") for f in features])), walk)[0]


def ensemble(spark: SparkSession, trees: Sequence[Sequence[Node]], features: int) -> GBTRegressionModel:
    """The same trees as a model of MLlib, whose compiled walk takes a few nanoseconds a step; the column above takes a hundred."""
    jvm, new_array = spark._jvm, spark._sc._gateway.new_array
    tree, kind = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    grown = new_array(kind, len(trees))
    for t, nodes in enumerate(trees):
        made = {}
        for at in reversed(_packed_order(nodes)):
            n = nodes[at]
            made[at] = (tree.LeafNode(n.value, 0.0, None) if n.feature < 0 else
                        tree.InternalNode(n.value, 0.0, 0.0, made.pop(n.left), made.pop(n.right), tree.ContinuousSplit(n.feature, n.cut), None))
        grown[t] = kind(f"tree{t}", made[0], features)
    weights = new_array(jvm.double, len(trees))
    for t in range(len(trees)):
        weights[t] = 1.0
    return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel("boosted", grown, weights))


def with_sum_over_trees(df: DataFrame, trees: Sequence[Sequence[Node]], features: Sequence[Column], out: str) -> DataFrame:
    """``df`` with the sum, over all trees, of the value of the leaf its known and finite features fall into."""
    if not trees:
        return df.withColumn(out, F.lit(0.0))
    model = ensemble(df.sparkSession, trees, len(features)).setFeaturesCol("features of the trees").setPredictionCol("sum over the trees")
    vector = array_to_vector(F.array(*[f.cast("double") for f in features]))
    told = model.transform(df.withColumn(model.getFeaturesCol(), vector))
    return told.withColumn(out, F.col(f"`{model.getPredictionCol()}`")).drop(model.getFeaturesCol(), model.getPredictionCol())
