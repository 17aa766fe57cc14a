"""Explanations of the tree model: per-row attributions, global importance, local rules."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from panelkit.config import ENTITY
from panelkit.functions.draws import fraction_of
from panelkit.functions.expressions import finite_or
from panelkit.functions.normal import normal_quantile, normal_share
from panelkit.operators.boosting import BoostedTrees
from panelkit.operators.quantiles import quantile_columns
from panelkit.operators.relational import top_k
from panelkit.session import spread, store


# One leaf of one tree: the features on its path, the interval (low, high] each has to lie in, and
# what the leaf adds to each of them for every combination of met and unmet intervals.
Leaf = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _leaf_table(value: float, cover: np.ndarray) -> np.ndarray:
    """Shapley contributions of one leaf, for all 2^m patterns of met intervals.

    A feature in the coalition passes only if its interval is met; one outside passes with the
    share of training rows that went that way.
    """
    m = len(cover)
    met = (np.arange(2 ** m)[:, None] >> np.arange(m)) & 1
    weight = np.array([factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)])
    out = np.zeros((2 ** m, m))
    for i in range(m):
        by_size = np.zeros((2 ** m, m))
        by_size[:, 0] = 1.0
        for j in range(m):
            if j != i:
                grown = by_size * cover[j]
                grown[:, 1:] += by_size[:, :-1] * met[:, [j]]
                by_size = grown
        out[:, i] = value * (met[:, i] - cover[i]) * (by_size @ weight)
    return out


def leaves_of(model: BoostedTrees) -> tuple[list[Leaf], float]:
    """All leaves, and the model's mean prediction over its training rows."""
    leaves, base = [], model.base
    for nodes in model.trees:
        stack = [(nodes[0], {})]
        while stack:
            node, path = stack.pop()
            if node.feature < 0:
                names = sorted(path)
                cover = np.array([path[f][2] for f in names])
                base += node.value * float(np.prod(cover))
                if names:
                    leaves.append((np.array(names), np.array([path[f][0] for f in names]),
                                   np.array([path[f][1] for f in names]), _leaf_table(node.value, cover)))
                continue
            f, left, right = node.feature, nodes[node.left], nodes[node.right]
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            stack.append((left, {**path, f: (low, min(high, node.cut), share * left.rows / node.rows)}))
            stack.append((right, {**path, f: (max(low, node.cut), high, share * right.rows / node.rows)}))
    return leaves, base


def _attribute(x: np.ndarray, leaves: list[Leaf]) -> np.ndarray:
    out = np.zeros_like(x)
    for features, low, high, table in leaves:
        v = x[:, features]
        pattern = ((v > low) & (v <= high)) @ (1 << np.arange(len(features)))
        out[:, features] += table[pattern]
    return out


def shapley_values(df: DataFrame, model: BoostedTrees, features: Sequence[str], ids: Sequence[str] = (ENTITY, "country")) -> DataFrame:
    """Exact tree attributions ``shap_<feature>`` per row, plus ``base_value``.

    For each row, the attributions and the base value add up to the model's prediction. Rows are
    scored in place, batch by batch; nothing is joined or multiplied out.
    """
    features, ids = list(features), list(ids)
    leaves, base = leaves_of(model)
    shared = df.sparkSession.sparkContext.broadcast(leaves)
    rows = df.select(*ids, *[finite_or(F.col(f), 0.0).alias(f) for f in features])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in ids)
    added = ", ".join(f"shap_{f} double" for f in features)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            phi = _attribute(pdf[features].to_numpy(dtype=float), shared.value)
            out = pdf[ids].copy()
            for i, f in enumerate(features):
                out[f"shap_{f}"] = phi[:, i]
            out["base_value"] = base
            yield out

    return rows.mapInPandas(score, f"{kept}, {added}, base_value double")


def mean_absolute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, importance): mean absolute value of each column."""
    long = df.select(*columns).unpivot([], list(columns), "feature", "v")
    return long.groupBy("feature").agg(F.avg(F.abs("v")).alias("importance"))


def feature_importance(shap: DataFrame, features: Sequence[str]) -> DataFrame:
    named = shap.select([F.col(f"shap_{f}").alias(f) for f in features])
    return mean_absolute(named, features).orderBy(F.desc("importance"), "feature")


def pivot_attributions(long: DataFrame, features: Sequence[str], ids: Sequence[str] = (ENTITY,)) -> DataFrame:
    """(ids, feature, attribution) rows to one column per feature."""
    wide = long.groupBy(*ids).pivot("feature", list(features)).agg(F.first("attribution", ignorenulls=True))
    return wide.select(*ids, *[F.col(f).alias(f"shap_{f}") for f in features])


# Local rules ---------------------------------------------------------------

def _bin_of(v, q1, q2, q3):
    return F.when(v <= q1, 0).when(v <= q2, 1).when(v <= q3, 2).otherwise(3)


def _rule(name: str, b, q1, q2, q3):
    return (
        F.when(b == 0, F.format_string(f"{name} <= %.2f", q1))
        .when(b == 1, F.format_string(f"%.2f < {name} <= %.2f", q1, q2))
        .when(b == 2, F.format_string(f"%.2f < {name} <= %.2f", q2, q3))
        .otherwise(F.format_string(f"{name} > %.2f", q3))
    )


def bin_profile(df: DataFrame, features: Sequence[str], cuts: DataFrame) -> dict[str, list[dict]]:
    """Share, mean, std, min and max of each quartile bin: 4 rows per feature on the driver."""
    q = cuts.first()
    parts = []
    for f in features:
        lo, mid, hi = (q[f"{n}_{f}"] for n in ("q1", "q2", "q3"))
        parts.append(F.struct(F.lit(f).alias("feature"), _bin_of(F.col(f), F.lit(lo), F.lit(mid), F.lit(hi)).alias("bin"), F.col(f).alias("v")))
    stats = (
        df.select(F.explode(F.array(*parts)).alias("r")).select("r.*").groupBy("feature", "bin")
        .agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"),
             F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    out: dict[str, list[dict]] = {f: [] for f in features}
    for r in stats.orderBy("feature", "bin").collect():
        out[r["feature"]].append(r.asDict())
    return out


def _perturbed(targets: DataFrame, features: Sequence[str], ids: Sequence[str], profile: dict[str, list[dict]], edges: dict[str, list[float]], samples: int, seed: int) -> DataFrame:
    """For every target row ``samples`` drawn rows: the ids, the features, and ``same_<feature>``.

    A feature's bin is drawn by the bins' shares, its value from the normal distribution of the bin's mean
    and deviation cut to the bin's range: the inverse distribution function at a uniform number
    between the shares at both ends. Draws are hashes, so nothing is drawn again. The first sample is the row itself.
    """
    rows = targets.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    columns = {}
    for f in features:
        bins, own = profile[f], F.col(f"`{f}`")
        draw = lambda what, f=f: fraction_of(F.lit(seed), F.col(ids[0]), F.col("sample"), F.lit(f), F.lit(what))
        total, upto, pick = sum(b["n"] for b in bins), 0, None
        values = []
        for b in bins:
            std = b["std"] or 0.0
            low, high = (normal_share((b[e] - b["mean"]) / std) if std else 0.5 for e in ("lo", "hi"))
            values.append((b["bin"], float(b["mean"]), float(std), low, high - low))
        for b in bins[:-1]:
            upto += b["n"]
            pick = (F if pick is None else pick).when(F.col(f"u_{f}") < upto / total, F.lit(b["bin"]))
        pick = F.lit(bins[-1]["bin"]) if pick is None else pick.otherwise(F.lit(bins[-1]["bin"]))
        columns[f] = (own, draw, pick, values, _bin_of(own, *edges[f]))
    rows = rows.withColumns({f"u_{f}": c[1]("bin") for f, c in columns.items()})
    rows = rows.withColumns({f"b_{f}": F.when(F.col("sample") == 0, c[4]).otherwise(c[2]) for f, c in columns.items()})

    def part(f: str, i: int) -> Column:
        out = None
        for v in columns[f][3]:
            out = (F if out is None else out).when(F.col(f"b_{f}") == v[0], F.lit(v[i]))
        return out

    rows = rows.withColumns({f"p_{f}": part(f, 3) + c[1]("value") * part(f, 4) for f, c in columns.items()})
    drawn = {f: F.when(F.col("sample") == 0, c[0]).otherwise(part(f, 1) + part(f, 2) * normal_quantile(F.col(f"p_{f}"))) for f, c in columns.items()}
    same = [(F.col(f"b_{f}") == c[4]).cast("double").alias(f"same_{f}") for f, c in columns.items()]
    return rows.select(*ids, *[c.alias(f) for f, c in drawn.items()], *same)


def local_rules(
    df: DataFrame, model: BoostedTrees, features: Sequence[str], explain: DataFrame, samples: int = 5000, seed: int = 42,
    ids: Sequence[str] = (ENTITY, "country"), ridge: float = 1.0,
) -> DataFrame:
    """Local surrogate of the model around each row of ``explain``: (ids, feature_rule, lime_weight).

    Features are cut at the quartiles of ``df``. Every explained row gets ``samples`` perturbed
    rows drawn from the bins' shares; the model scores them; a ridge regression on "same bin as
    the row", weighted by closeness, gives one weight per feature. Sums for the regressions are
    grouped in Spark, so a task only solves one small system per explained row.
    """
    features, ids = list(features), list(ids)
    clean = store(df.select([finite_or(F.col(f), 0.0).alias(f) for f in features]), "lime")
    cuts = store(quantile_columns(clean, features, {"q1": 0.25, "q2": 0.5, "q3": 0.75}), "cuts")
    profile = bin_profile(clean, features, cuts)
    q = cuts.first()
    edges = {f: [q[f"q1_{f}"], q[f"q2_{f}"], q[f"q3_{f}"]] for f in features}
    targets = spread(store(explain.select(*ids, *[finite_or(F.col(f), 0.0).alias(f) for f in features]), "targets"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in targets.schema.fields if f.name in ids)

    scored = model.predict(_perturbed(targets, features, ids, profile, edges, samples, seed))
    width = 0.75 * float(np.sqrt(len(features)))
    same = [F.col(f"same_{f}") for f in features]
    distance2 = sum((1 - s) for s in same)
    w = F.sqrt(F.exp(-distance2 / (width * width)))
    y = F.col("prediction")
    one = [F.lit(1.0), *same]
    sums = [F.sum(w * a * b).alias(f"a_{i}_{j}") for i, a in enumerate(one) for j, b in enumerate(one) if i <= j]
    sums += [F.sum(w * a * y).alias(f"b_{i}") for i, a in enumerate(one)]
    grouped = scored.groupBy(*ids).agg(*sums)
    size = len(one)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        penalty = np.diag([0.0] + [ridge] * (size - 1))
        for pdf in batches:
            rows = []
            for row in pdf.to_dict("records"):
                a = np.array([[row[f"a_{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)])
                beta = np.linalg.lstsq(a + penalty, np.array([row[f"b_{i}"] for i in range(size)]), rcond=None)[0]
                rows += [{**{c: row[c] for c in ids}, "feature": f, "lime_weight": float(b)} for f, b in zip(features, beta[1:])]
            yield pd.DataFrame(rows, columns=[*ids, "feature", "lime_weight"])

    weights = grouped.mapInPandas(solve, f"{kept}, feature string, lime_weight double")
    rules = []
    for f in features:
        lo, mid, hi = map(F.lit, edges[f])
        rules.append(F.struct(F.lit(f).alias("feature"), _rule(f, _bin_of(F.col(f), lo, mid, hi), lo, mid, hi).alias("feature_rule")))
    texts = targets.select(*ids, F.explode(F.array(*rules)).alias("r")).select(*ids, "r.*")
    return weights.join(texts, [*ids, "feature"]).select(*ids, "feature_rule", "lime_weight")


def local_rules_for_top(df: DataFrame, model: BoostedTrees, features: Sequence[str], by: str = "vulnerability_score", n: int = 15,
                        samples: int = 5000, ids: Sequence[str] = (ENTITY, "country")) -> DataFrame:
    return local_rules(df, model, features, top_k(df, by, n, [ids[0]]), samples, ids=ids)
