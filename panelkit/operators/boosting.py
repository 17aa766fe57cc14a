"""Histogram boosting for a squared loss.

Features are cut at stored quantiles of the training rows, so a feature is a byte and a split is found in
a histogram of gradients and rows per (node, feature, bin). Up to some million rows the packed bytes are
brought to one task, where all trees grow in one job: a level of a tree takes less time there than
Spark needs to start a job for it. More rows make shares of about a million, packed as arrays and stored, one share a task. At
each level every task adds up its own share, the sums are added in Spark, and the driver, which sees
histograms only, takes the splits. A leaf's value is the second-order step -G / (H + l2), times the learning
rate. After a tree the shares are stored anew with their predictions, so a lost executor costs the running level only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.functions.expressions import finite_or
from panelkit.operators.quantiles import exact_quantiles
from panelkit.operators.trees import TABLE, Node, tree_table, with_sum_over_trees
from panelkit.session import delete_path, scratch_path

BINS = 64
L2 = 1.0
LEAST_GAIN = 1e-6
ROWS_A_TASK = 1 << 23   # that one task grows trees for alone
ROWS_A_SHARE = 1 << 20  # where there are more
PART, CHUNK = 1 << 17, 1 << 16  # rows dealt out and rows counted at a time, near enough to a core
SLICES = 64  # parts of a histogram that are added side by side


@dataclass
class BoostedTrees:
    """A fitted model: its features, the prediction without trees, and the trees (a few thousand nodes)."""

    features: list[str]
    base: float
    trees: list[list[Node]]

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the prediction as a column; missing and infinite features count as 0."""
        clean = [finite_or(F.col(f"`{f}`"), 0.0) for f in self.features]
        return with_sum_over_trees(df, self.trees, clean, out).withColumn(out, self.base + F.col(f"`{out}`"))

    def table(self, spark: SparkSession) -> DataFrame:
        return tree_table(spark, self.trees)


def feature_cuts(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Per feature the distinct values at the ranks k / bins, without the largest value: beyond it is nothing."""
    probs = [k / bins for k in range(1, bins)]
    cuts = exact_quantiles(rows, features, probs, lower=True).groupBy("metric").agg(F.array_sort(F.collect_set("value")).alias("cuts"))
    top = rows.agg(*[F.max(f"`{f}`").alias(str(i)) for i, f in enumerate(features)]).first()
    found = {r["metric"]: r["cuts"] for r in cuts.collect()}
    return [[c for c in found.get(f, []) if c < top[str(i)]] for i, f in enumerate(features)]


def binned(values: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """(features, rows): bin b holds what lies above cut b - 1 and up to cut b."""
    out = np.empty(values.shape[::-1], np.uint8)
    for i, c in enumerate(cuts):
        out[i] = np.searchsorted(np.asarray(c), values[:, i], side="left")
    return out


def coded(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Two features as one code, so that one count serves both; one by one where that makes too many cells."""
    if bins > 64:
        return list(x)
    return [x[f] * np.uint16(bins) + x[f + 1] if f + 1 < len(x) else x[f] for f in range(0, len(x), 2)]


def histogram(codes: Sequence[np.ndarray], own: np.ndarray | None, gradient: np.ndarray, bins: int) -> np.ndarray:
    """(2, features, bins): sums of gradients and of rows, over the rows ``own`` (None: all)."""
    two = [code.dtype == np.uint16 for code in codes]
    sums = [np.zeros((2, bins * bins if t else bins)) for t in two]
    n = len(gradient) if own is None else len(own)
    for start in range(0, n, CHUNK):
        at = slice(start, start + CHUNK)
        pick = (lambda a: a[at]) if own is None else (lambda a: a.take(own[at], mode="clip"))  # "clip" spares a check of each place
        weight = pick(gradient)
        for code, total in zip(codes, sums):
            cell = pick(code).astype(np.intp)
            total[0] += np.bincount(cell, weight, total.shape[1])
            total[1] += np.bincount(cell, minlength=total.shape[1])
    parts = [t.reshape(2, bins, bins).sum(axis=a) for t, pair in zip(sums, two) if pair for a in (2, 1)] + [t for t, pair in zip(sums, two) if not pair]
    return np.stack(parts, axis=1)


def best_splits(total: np.ndarray, cuts: Sequence[Sequence[float]], l2: float, min_rows: float) -> list[tuple[float, int, int, float, float] | None]:
    """Per slot (gain, feature, bin of the cut, gradients and rows to its left). Gains that are equal in single precision
    go to the first feature and cut."""
    g, h = np.cumsum(total, axis=3)
    node_g, node_h = g[:, :1, -1:], h[:, :1, -1:]
    score = lambda a, b: a * a / (b + l2)
    gain = score(g, h) + score(node_g - g, node_h - h) - score(node_g, node_h)
    allowed = (h >= min_rows) & (node_h - h >= min_rows)
    for f, c in enumerate(cuts):
        allowed[:, f, len(c):] = False
    gain = np.where(allowed, gain, -np.inf).astype(np.float32).reshape(len(gain), -1)
    best = gain.argmax(axis=1)
    bins = total.shape[3]
    return [(float(gain[s, b]), int(b) // bins, int(b) % bins, float(g[s].flat[b]), float(h[s].flat[b])) if gain[s, b] > LEAST_GAIN else None for s, b in enumerate(best)]


# Takes the nodes so far and a slot for each node (-1: none); gives the histogram of the slots.
Count = Callable[[list[list], np.ndarray, int], np.ndarray]


def grow(count: Count, cuts: Sequence[Sequence[float]], depth: int, rate: float, l2: float, min_rows: float) -> list[Node]:
    """One tree, level by level. Of two children the one with fewer rows is counted; what is left of the parent is
    the other's. The last level's sums are those beside its parents' cuts."""
    nodes, level = [[-1, 0.0, -1, -1, 0.0, 0]], [0]
    total = count(nodes, np.zeros(1, np.int64), 1)
    sums = [tuple(map(float, total[:, 0, 0].sum(axis=1)))]
    while True:
        for node, (g, h) in zip(level, sums):
            nodes[node][4:] = -rate * g / (h + l2), int(h)
        splits = best_splits(total, cuts, l2, min_rows) if depth else [None] * len(level)
        if not any(splits):
            return [Node(*n) for n in nodes]
        following, kept, fewer, below = [], [], [], []
        for s, (node, split) in enumerate(zip(level, splits)):
            if split:
                _, f, b, g, h = split
                left = len(nodes)
                nodes[node][:4] = f, float(cuts[f][b]), left, left + 1
                nodes += [[-1, 0.0, -1, -1, 0.0, 0] for _ in range(2)]
                following += [left, left + 1]
                below += [(g, h), (sums[s][0] - g, sums[s][1] - h)]
                kept.append(s)
                fewer.append(int(2 * h > sums[s][1]))
        depth -= 1
        if depth:
            slot_of, n = np.full(len(nodes), -1), np.arange(len(kept))
            slot_of[[left + i for left, i in zip(following[::2], fewer)]] = n
            counted = count(nodes, slot_of, len(kept))
            parents, total = total[:, kept], np.empty((2, 2 * len(kept), *total.shape[2:]))
            total[:, 2 * n + fewer], total[:, 2 * n + 1 - fewer] = counted, parents - counted
        level, sums = following, below


def descend(members: dict[int, np.ndarray | None], x: np.ndarray, nodes: Sequence[Sequence], cuts: Sequence[Sequence[float]]) -> None:
    """Deals the rows at nodes that have been split out to their children, down to the leaves."""
    waiting = list(members)
    while waiting:
        node = waiting.pop()
        f, cut, left, right = nodes[node][:4]
        if f >= 0:
            own = members.pop(node)
            to_left = (x[f] if own is None else x[f].take(own, mode="clip")) <= np.searchsorted(cuts[f], cut)
            members[left], members[right] = (np.flatnonzero(m) if own is None else own.compress(m) for m in (to_left, ~to_left))
            waiting += [left, right]


class Share:
    """A task's rows: bins, labels and the prediction so far."""

    def __init__(self, x: np.ndarray, label: np.ndarray, margin: np.ndarray):
        self.x, self.label, self.margin = x, label, margin

    def to_row(self) -> dict:
        return {"x": self.x.tobytes(), "label": self.label.tobytes(), "margin": self.margin.tobytes()}

    @staticmethod
    def of_rows(batch: pa.RecordBatch, k: int) -> list[Share]:
        read = lambda b, kind: np.frombuffer(b, kind)
        return [Share(read(r["x"], np.uint8).reshape(k, -1), read(r["label"], float), read(r["margin"], float)) for r in batch.to_pylist()]

    @staticmethod
    def joined(shares: Sequence[Share]) -> Share:
        return Share(np.concatenate([s.x for s in shares], axis=1), np.concatenate([s.label for s in shares]), np.concatenate([s.margin for s in shares]))

    def move(self, members: dict[int, np.ndarray | None], nodes: Sequence[Node]) -> None:
        """On by the leaves' values."""
        margin = self.margin.copy()
        for node, own in members.items():
            margin[slice(None) if own is None else own] += nodes[node].value
        self.margin = margin

    def grow_trees(self, trees: int, cuts: Sequence[Sequence[float]], depth: int, rate: float, l2: float, min_rows: float) -> list[list[Node]]:
        """Trees for these rows alone."""
        bins, out = _bins(cuts), []
        parts = [Share(self.x[:, i:i + PART], self.label[i:i + PART], self.margin[i:i + PART]) for i in range(0, max(len(self.label), 1), PART)]
        codes = [coded(p.x, bins) for p in parts]
        for _ in range(trees):
            members: list[dict[int, np.ndarray | None]] = [{0: None} for _ in parts]
            gradients = [p.margin - p.label for p in parts]

            def count(nodes, slot_of, slots):
                for p, m in zip(parts, members):
                    descend(m, p.x, nodes, cuts)
                return sum(_of_slots(c, m, g, slot_of, bins) for c, m, g in zip(codes, members, gradients))

            nodes = grow(count, cuts, depth, rate, l2, min_rows)
            for p, m in zip(parts, members):
                descend(m, p.x, nodes, cuts)
                p.move(m, nodes)
            out.append(nodes)
        return out


def _of_slots(codes: Sequence[np.ndarray], members: dict[int, np.ndarray | None], gradient: np.ndarray, slot_of: np.ndarray, bins: int) -> np.ndarray:
    """(2, slots, features, bins): the histograms of the nodes that have a slot."""
    wanted = np.flatnonzero(slot_of >= 0)
    return np.stack([histogram(codes, members[n], gradient, bins) for n in wanted[np.argsort(slot_of[wanted])]], axis=1)


def _bins(cuts: Sequence[Sequence[float]]) -> int:
    return max(map(len, cuts), default=0) + 1


SHARES = "x binary, label binary, margin binary"
_SHARES = pa.schema([("x", pa.binary()), ("label", pa.binary()), ("margin", pa.binary())])


def _pack(rows: DataFrame, k: int, cuts: list[list[float]], base: float) -> DataFrame:
    """One packed row per partition."""
    def run(batches):
        x, label = [np.empty((k, 0), np.uint8)], [np.empty(0)]
        for b in batches:
            table = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            x.append(binned(table[:, :-1], cuts))
            label.append(table[:, -1])
        label = np.concatenate(label)
        yield pa.RecordBatch.from_pylist([Share(np.concatenate(x, axis=1), label, np.full(len(label), base)).to_row()], schema=_SHARES)

    return rows.mapInArrow(run, SHARES)


def _stored(shares: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(shares.sparkSession, "shares")
    shares.write.parquet(path)
    return shares.sparkSession.read.schema(SHARES).parquet(path), path


def _count_in_spark(shares: DataFrame, k: int, cuts: list[list[float]]) -> Count:
    """Histograms over all shares. Tasks give theirs in slices, which are added side by side; the driver gets one histogram."""
    bins = _bins(cuts)

    def count(nodes, slot_of, slots):
        def run(batches):
            for batch in batches:
                for share in Share.of_rows(batch, k):
                    members: dict[int, np.ndarray | None] = {0: None}
                    descend(members, share.x, nodes, cuts)
                    own = _of_slots(coded(share.x, bins), members, share.margin - share.label, slot_of, bins).ravel()
                    yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in np.array_split(own, SLICES)], pa.binary())], ["slice", "part"])

        def add(rows: pa.Table) -> pa.Table:
            total = np.sum([np.frombuffer(p) for p in rows["part"].to_pylist()], axis=0)
            return pa.table({"slice": rows["slice"][:1], "part": pa.array([total.tobytes()], pa.binary())})

        added = shares.mapInArrow(run, "slice int, part binary").groupBy("slice").applyInArrow(add, "slice int, part binary").collect()
        parts = [np.frombuffer(r["part"]) for r in sorted(added, key=lambda r: r["slice"])]
        return np.concatenate(parts).reshape(2, slots, k, bins)

    return count


def _grow_in_spark(shares: DataFrame, path: str, k: int, cuts: list[list[float]], trees: int, depth: int, rate: float, l2: float, min_rows: float) -> list[list[Node]]:
    spark, out = shares.sparkSession, []
    for _ in range(trees):
        nodes = grow(_count_in_spark(shares, k, cuts), cuts, depth, rate, l2, min_rows)
        out.append(nodes)
        if len(out) == trees:
            break

        def step(batches, nodes=nodes):
            for batch in batches:
                moved = []
                for share in Share.of_rows(batch, k):
                    members: dict[int, np.ndarray | None] = {0: None}
                    descend(members, share.x, nodes, cuts)
                    share.move(members, nodes)
                    moved.append(share.to_row())
                yield pa.RecordBatch.from_pylist(moved, schema=_SHARES)

        before = path
        shares, path = _stored(shares.mapInArrow(step, SHARES))
        delete_path(spark, before)
    return out


def _grow_in_task(shares: DataFrame, k: int, cuts: list[list[float]], trees: int, depth: int, rate: float, l2: float, min_rows: float) -> list[list[Node]]:
    names = [f.split()[0] for f in TABLE.split(", ")]
    schema = pa.schema(list(zip(names, [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.int64()])))

    def run(batches):
        grown = Share.joined([s for batch in batches for s in Share.of_rows(batch, k)]).grow_trees(trees, cuts, depth, rate, l2, min_rows)
        yield pa.RecordBatch.from_pylist([dict(zip(names, (t, i, *n))) for t, nodes in enumerate(grown) for i, n in enumerate(nodes)], schema=schema)

    out: list[list[Node]] = [[] for _ in range(trees)]
    for r in sorted(shares.mapInArrow(run, TABLE).collect(), key=lambda r: (r["tree"], r["node"])):
        out[r["tree"]].append(Node(*r[2:]))
    return out


def fit(rows: DataFrame, features: Sequence[str], label: str, trees: int = 200, depth: int = 5, rate: float = 0.1, bins: int = BINS, l2: float = L2,
        min_rows: float = 1.0) -> BoostedTrees:
    """Boosted trees over a stored table of known features and label. The result does not depend on the number of tasks."""
    features = list(features)
    if not 2 <= bins <= 256:
        raise ValueError("bins must be from 2 to 256")
    told = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("mean")).first()
    if not told["n"]:
        return BoostedTrees(features, 0.0, [])
    base, k = float(told["mean"]), len(features)
    cuts = feature_cuts(rows, features, bins)
    plain = rows.select(*[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(f"`{label}`").cast("double").alias("y"))
    if told["n"] <= ROWS_A_TASK:
        return BoostedTrees(features, base, _grow_in_task(_pack(plain, k, cuts, base).repartition(1), k, cuts, trees, depth, rate, l2, min_rows))
    tasks = ceil(told["n"] / min(ROWS_A_TASK, ROWS_A_SHARE))
    packed = _pack(plain.repartition(tasks), k, cuts, base)
    shares, path = _stored(packed)
    return BoostedTrees(features, base, _grow_in_spark(shares, path, k, cuts, trees, depth, rate, l2, min_rows))


def r_squared(df: DataFrame, prediction: Column, label: Column) -> float:
    """1 - residual sum / total sum, in one pass."""
    s = df.agg(F.sum((label - prediction) * (label - prediction)).alias("rss"), F.var_pop(label).alias("var"), F.count(label).alias("n")).first()
    total = (s["var"] or 0.0) * (s["n"] or 0)
    return 1.0 - s["rss"] / total if total else 0.0
