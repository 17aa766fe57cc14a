import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_cases import plain
from panelkit.llm import importance as module
from panelkit.llm.importance import best_limit, keep_selected, kth_largest, ngrams, quality_resample

SMALL = "/root/testdata/sf0.01"


def spoken(text):
    """Unigrams, pairs and shape triples by regular expressions."""
    out = []
    tokens = re.findall(rb"[A-Za-z0-9\x80-\xff]+|[!-/:-@\[-`{-~]+", (text or "").encode())
    low = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), t) for t in tokens]

    def shape(t):
        big, small = len(re.findall(rb"[A-Z]", t)), len(re.findall(rb"[a-z]", t))
        if not re.match(rb"[A-Za-z0-9\x80-\xff]", t):
            return t
        return 1 if re.search(rb"[0-9]", t) else 2 if not big + small else 3 if not small and big > 1 else 4 if big == 1 and re.match(rb"[A-Z]", t) else 5 if big else 6
    shapes = [shape(t) for t in tokens]
    out += low
    out += ["same" if a == b else (a, b) for a, b in zip(low, low[1:])]
    out += list(zip(shapes, shapes[1:], shapes[2:]))
    return out


def test_ngrams_are_those_of_the_texts(hard_docs):
    texts = [t for _, t in plain(hard_docs)] + ["A b B b, c!! XX Yy 3d é zZ !! !!", "Re: Re: re"]
    meant, bucket_of = {}, {}
    docs, buckets = (np.concatenate(x) for x in zip(*ngrams(pa.array(texts))))
    for d, text in enumerate(texts):
        want, got = spoken(text), sorted(buckets[docs == d].tolist())
        assert len(want) == len(got)
        meant[d] = want
    # One bucket for each n-gram: learn it from documents with a single one, then add up.
    singles = sorted({g for w in meant.values() for g in w if isinstance(g, bytes)})
    found = [b[0] for b in ([x for _, x in ngrams(pa.array([s.decode(errors="surrogateescape")]))][0] for s in singles)]
    bucket_of = dict(zip(singles, found))
    for d in meant:
        have = buckets[docs == d].tolist()
        for g in meant[d]:
            if isinstance(g, bytes):
                have.remove(bucket_of[g])


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    learned = labels.filter(F.pmod(F.hash("doc_id"), F.lit(2)) == 0)
    told = quality_resample(docs, learned).join(labels.filter(F.pmod(F.hash("doc_id"), F.lit(2)) == 1), "doc_id").toPandas()
    assert (told.selected == (told.quality == 1)).mean() > 0.95
    assert told[told.quality == 1].selected.mean() > 0.98
    kept = keep_selected(docs, learned)
    assert kept.columns == docs.columns and 0.7 < kept.count() / docs.count() < 0.95


def test_draw_is_the_k_largest(hard_docs, spark):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(50)] + [(3, None, 0), (None, 1, 0), (7, 0, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality_resample(hard_docs, labels).collect()
    assert len(rows) == hard_docs.count()
    taken, left = [r.key for r in rows if r.selected], [r.key for r in rows if not r.selected]
    assert taken and (not left or min(taken) > max(left))
    assert all(r.log_weight == 0 for r in rows if r.doc_id in (100, 101, 102))
    again = {(r.doc_id, r.key) for r in quality_resample(hard_docs.repartition(3), labels).collect()}
    assert {(i, round(k, 9)) for i, k in again} == {(r.doc_id, round(r.key, 9)) for r in rows}


def test_labels_of_one_kind_or_none(hard_docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    bad = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, quality int")
    for labels in (none, bad):
        assert quality_resample(hard_docs, labels).filter("selected").count() == hard_docs.count()
    assert quality_resample(no_docs, bad).count() == 0
    clash = hard_docs.withColumn("good", F.lit("x")).withColumn("log_weight", F.lit(1)).withColumn("key", F.lit(2))
    assert keep_selected(clash, bad).columns == clash.columns


def test_gumbel_keys_draw_in_proportion(spark):
    """Of two rows with weights 1 and 3 the second has the larger key in three of four draws."""
    pairs = spark.range(20000).select("id", F.lit("a").alias("text"))
    a = pairs.withColumn("a", module.gumbel("id", "text", 1)).withColumn("b", F.log(F.lit(3.0)) + module.gumbel("id", "text", 2))
    assert a.agg(F.avg((F.col("b") > F.col("a")).cast("int"))).first()[0] == pytest.approx(0.75, abs=0.01)


def test_kth_largest(spark, monkeypatch):
    rng = random.Random(0)
    values = [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e6), 5.0]) for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    monkeypatch.setattr(module, "COLLECTED", 20)
    for k in (1, 2, 777, 1500, 3000):
        assert kth_largest(frame, "x", k) == sorted(values, reverse=True)[k - 1]


def test_best_limit():
    assert best_limit(np.array([-9.0, -8, 1, 2]), np.array([False, False, True, True])) == -3.5
    assert best_limit(np.array([1.0, 2]), np.array([True, True])) == -np.inf
    assert best_limit(np.array([-1.0, 3, 2]), np.array([False, True, True])) == 0.5


def test_log_weight_is_the_ratio_of_counted_models(spark, hard_docs):
    """From counts of every bucket, taken one by one."""
    rows = [(i, t) for i, t in plain(hard_docs) if i is not None and i < 60]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 3) for i, _ in rows[:30]], "doc_id long, quality int")
    good = {i for i, _ in rows[:30] if i % 3 == 1}
    of = {}
    for i, text in rows:
        found = [b for _, buckets in ngrams(pa.array([text])) for b in buckets.tolist()]
        of.setdefault(i, []).append(found)
    raw = np.bincount([b for lists in of.values() for found in lists for b in found], minlength=module.BUCKETS).astype(float)
    target = np.bincount([b for i in good for found in of[i] for b in found], minlength=module.BUCKETS).astype(float)
    expected = target.sum() * raw / raw.sum()
    tilt = (target + module.SMOOTHING) / (expected + module.SMOOTHING)
    scale = (raw / raw.sum() * tilt).sum()  # so that the target's shares add up to one
    log = [np.log(t / scale) for t in tilt]
    got = {}
    for r in quality_resample(docs, labels).collect():
        got.setdefault(r.doc_id, []).append(r.log_weight)
    for i, lists in of.items():
        assert np.allclose(sorted(got[i]), sorted(sum(log[b] for b in found) for found in lists), atol=1e-9)
