"""Quality classification by importance resampling.

Two generative models of hashed n-grams are fitted: of documents labelled good (the target) and of
all documents (the raw text). A document's log weight adds the log ratio of the two over its n-grams.
Documents are drawn without replacement with their weights as probabilities, which is the same as
taking the k largest of log weight plus Gumbel noise. n-grams are single tokens, pairs, and triples
of token shapes; a pair of equal tokens is one n-gram whatever the token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.llm import exchange
from panelkit.llm.registry import query, table
from panelkit.llm.words import LOWER, P1, P2, PIECE, _hash, _spans, mix, text_bytes
from panelkit.session import store

BUCKETS = 1 << 16
LABELLED = 20_000  # labelled rows that the models and the limit are fitted on, drawn by hash
SMOOTHING = 10.0  # occurrences by which a bucket's ratio is drawn to 1
COLLECTED = 10_000  # keys that the driver sorts at the end of a selection

_byte = np.arange(256)
LETTERS = ((_byte >= 0x41) & (_byte <= 0x5A)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
DIGITS = (_byte >= 0x30) & (_byte <= 0x39)
WORD = LETTERS | DIGITS
MARKS = (_byte > 0x20) & (_byte < 0x7F) & ~WORD
CAPITALS = (_byte >= 0x41) & (_byte <= 0x5A)
SMALL = (_byte >= 0x61) & (_byte <= 0x7A)


def ngrams(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of every n-gram, for some documents at a time."""
    raw, at = text_bytes(column)
    cuts = np.unique(np.append(np.searchsorted(at, np.arange(PIECE, len(raw), PIECE)), len(at) - 1))
    low = 0
    for high in cuts[cuts > 0]:
        yield _piece_ngrams(raw[at[low]:at[high]], at[low:high + 1] - at[low], low)
        low = high


def _piece_ngrams(raw: np.ndarray, at: np.ndarray, doc_from: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [_spans(raw, at, kind) for kind in (WORD, MARKS)]
    start, end = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    mark = MARKS[raw[start]] if len(start) else np.zeros(0, bool)
    first = np.searchsorted(start, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(np.append(first[:-1], len(start))))
    low = LOWER[raw]
    token = _hash(low, start, end)
    count = lambda kind: (lambda c: c[end] - c[start])(np.concatenate([[0], np.cumsum(kind[raw])]))
    capitals, small, digits = count(CAPITALS), count(SMALL), count(DIGITS)
    # Words: with digits, no letter of ASCII, capitals only, a capital first, capitals inside, small only.
    shape = np.select([digits > 0, capitals + small == 0, (small == 0) & (capitals > 1), (capitals == 1) & CAPITALS[raw[start]] if len(start) else mark, capitals > 0], [1, 2, 3, 4, 5], 6).astype(np.uint64)
    shape = np.where(mark, mix(token | np.uint64(8)), shape)  # marks stand for themselves
    two = doc[1:] == doc[:-1]
    pair = np.where(token[1:] == token[:-1], P2, token[1:] * P1 + token[:-1])[two]
    three = (doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, bool)
    triple = (((shape[:-2] * P1 + shape[1:-1]) * P1 + shape[2:])[three]) if len(doc) > 2 else np.zeros(0, np.uint64)
    kinds = [(token, doc, 1), (pair, doc[1:][two], 2), (triple, doc[2:][three] if len(doc) > 2 else doc[:0], 3)]
    bucket = np.concatenate([(mix(v + np.uint64(k)) % np.uint64(BUCKETS)).astype(np.int64) for v, _, k in kinds])
    return np.concatenate([d for _, d, _ in kinds]) + doc_from, bucket


@dataclass
class Ratio:
    """log p(n-gram | target) - log p(n-gram | raw) per bucket."""

    log: np.ndarray

    def weights(self, column) -> np.ndarray:
        return weights_of(self.log, column)


def weights_of(log: np.ndarray, column) -> np.ndarray:
    """The sum of ``log`` over the n-grams of each text."""
    out = np.zeros(len(column))
    for doc, bucket in ngrams(column):
        if len(doc):
            out += np.bincount(doc, log[bucket], len(out))
    return out


def labelled_sample(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", most: int = LABELLED) -> DataFrame:
    """id, good of at most ``most`` labelled documents, drawn by a hash. One id with several labels has the least."""
    own = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("good")).dropna()
    own = own.groupBy("id").agg(F.min("good").alias("good"))
    return own.orderBy(F.xxhash64("id"), "id").limit(most)


def fit(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Ratio, Ratio, Ratio]:
    """The raw model counts all documents; the target model those of the sample that are good.

    Of the three ratios the first uses the whole sample, the others leave out its even and odd ids.
    """
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    fold = F.when(F.col("good") == 1, fold_of(F.col("id"))).otherwise(F.lit(2)).alias("fold")
    own = own.join(F.broadcast(sample), "id", "left").select("text", fold)  # the sample's size is bounded

    def count(batches):
        counts, seen = np.zeros((3, BUCKETS)), False
        for batch in batches:
            folds = batch["fold"].to_numpy()
            for doc, bucket in ngrams(batch["text"]):
                counts += np.bincount(folds[doc] * BUCKETS + bucket, minlength=3 * BUCKETS).reshape(3, -1)
                seen = True
        if seen:
            yield exchange.in_slices(counts.ravel())

    counts = exchange.add_slices(own.mapInArrow(count, "slice int, part binary"), np.dtype(np.float64), 3 * BUCKETS)
    even, odd, other = counts.reshape(3, -1)
    raw = even + odd + other
    return ratio_of(raw, even + odd), ratio_of(raw, odd), ratio_of(raw, even)


def fold_of(id_col: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(id_col), F.lit(2)).cast("int")


def ratio_of(raw: np.ndarray, target: np.ndarray) -> Ratio:
    if not target.sum():
        return Ratio(np.zeros(BUCKETS))  # without a target every document weighs the same
    share = raw / raw.sum()
    # Where few occurrences are expected their number says little, so rare n-grams weigh little.
    tilt = (target + SMOOTHING) / (target.sum() * share + SMOOTHING)
    return Ratio(np.log(tilt) - np.log((share * tilt).sum()))


def weighed(docs: DataFrame, ratio: Ratio, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the log weight as column ``name``; only the text goes to Python."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio.log)  # an array: executors have no copy of this package

    @F.arrow_udf("double")
    def weight(text: pa.Array) -> pa.Array:
        return pa.array(weights_of(sent.value, text), pa.float64())

    return docs.withColumn(name, weight(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))


def gumbel(id_col: str, text_col: str, seed: int) -> F.Column:
    """Noise fixed by the row's id and text, so that a task that runs again draws the same."""
    u = (F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit(seed)), F.lit(2**52)) + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(-F.log(u))


def best_limit(scores: np.ndarray, good: np.ndarray) -> float:
    """Where the shares of errors among good and bad add up to the least; the middle of the gap there."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    scores, good = scores[order], good[order]
    # Limit before place i: everything below is rejected.
    lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()
    passed = 1 - np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    errors = lost + passed
    errors[1:-1][scores[1:] == scores[:-1]] = np.inf
    i = int(np.argmin(errors))
    if i == 0:
        return -np.inf
    return float((scores[i - 1] + scores[i]) / 2) if i < len(scores) else float("inf")


def kth_largest(keys: DataFrame, name: str, k: int) -> float:
    """Exact, by counting in ever finer bins; the driver sees bins and at last at most COLLECTED keys."""
    keys = keys.select(F.col(name).alias("x"))
    low, high = keys.agg(F.min("x"), F.max("x")).first()
    while True:
        inside = keys.filter(F.col("x").between(low, high))
        if low == high:
            return low
        bins = inside.groupBy(F.least(F.floor((F.col("x") - low) / (high - low) * 1024), F.lit(1023)).alias("bin")).agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy(F.desc("bin")).collect()
        for b in bins:
            if k <= b["n"]:
                break
            k -= b["n"]
        low, high = b["low"], b["high"]
        if b["n"] <= COLLECTED:
            return sorted((r[0] for r in keys.filter(F.col("x").between(low, high)).collect()), reverse=True)[k - 1]


@dataclass
class Resampling:
    ratio: Ratio
    k: int
    least_key: float  # of the rows drawn


def fit_resampling(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, most: int = LABELLED) -> tuple[Resampling, DataFrame]:
    """The fitted draw, and the stored table id, log_weight, key of all rows.

    k is the number of rows whose log weight exceeds the limit that separates good from bad labelled
    rows best, so it grows with the table.
    """
    sample = store(labelled_sample(labels, most=most), "labelled")
    ratio, *halves = fit(docs, sample, id_col, text_col)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # The limit is set on weights that a document's own n-grams had no part in.
    known = own.join(F.broadcast(sample), "id")
    for k, half in enumerate(halves):
        known = weighed(known, half, f"weight_{k}")
    known = known.groupBy("id").agg(F.min(F.when(fold_of(F.col("id")) == 0, F.col("weight_0")).otherwise(F.col("weight_1"))).alias("log_weight"), F.min("good").alias("good")).select("log_weight", "good").toPandas()  # no more than the sample
    own = weighed(own, ratio, "log_weight").withColumn("key", F.col("log_weight") + gumbel("id", "text", seed))
    rows = store(own.select("id", "log_weight", "key"), "weights")
    limit = best_limit(known["log_weight"].to_numpy(), known["good"].to_numpy() == 1) if len(known) else -np.inf
    k = rows.filter(F.col("log_weight") > float(limit)).count()
    least = kth_largest(rows, "key", k) if k else float("inf")
    return Resampling(ratio, k, least), rows


def quality_resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, most: int = LABELLED) -> DataFrame:
    """One row per row of ``docs``: doc_id, log_weight, key, selected.

    Null and empty texts weigh 0, as do all when no label is 1; without a label of each kind all rows are
    drawn. Equal rows have equal keys and are drawn or not together. Labels of unknown documents and null
    labels don't count. Other columns are not read.
    """
    drawn, rows = fit_resampling(docs, labels, id_col, text_col, seed, most)
    return rows.select(F.col("id").alias("doc_id"), "log_weight", "key", (F.col("key") >= drawn.least_key).alias("selected"))


def keep_selected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns."""
    drawn, _ = fit_resampling(docs, labels, id_col, text_col, seed)
    columns, name = docs.columns, "key of " + "-".join(docs.columns)
    long_id = "id of " + "-".join(docs.columns)
    out = weighed(docs, drawn.ratio, name, text_col).withColumn(long_id, F.col(f"`{id_col}`").cast("long"))
    out = out.filter(F.col(f"`{name}`") + gumbel(long_id, text_col, seed) >= drawn.least_key)
    return out.select(*[F.col(f"`{c}`") for c in columns])


@query("op9_quality_resampling")
def op9_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
