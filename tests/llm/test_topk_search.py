import re
from collections import Counter
from math import log

import pytest

from llm_cases import plain
from panelkit.llm import topk_search as module
from panelkit.llm.topk_search import top_k


def brute(rows, queries, k):
    words = [re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) for _, t in rows]
    df = Counter(t for w in words for t in set(w))
    n, average = len(rows), sum(map(len, words)) / len(rows)
    asked = {}
    for doc, text in queries:
        if doc is not None:
            asked.setdefault(doc, set()).update(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())))
    out = []
    for q, terms in asked.items():
        found = []
        for (doc, _), w in zip(rows, words):
            tf = Counter(w)
            if terms & tf.keys():
                s = sum(log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(w) / average)) for t in terms & tf.keys())
                found.append((-round(s, 6), doc is None, doc))
        out += [(q, r + 1, doc, -s) for r, (s, _, doc) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 5, 200])
def test_as_brute_force(hard_docs, monkeypatch, k):
    monkeypatch.setattr(module, "BLOCK_DOCS", 4)
    monkeypatch.setattr(module, "SHARD_BYTES", 1500)
    monkeypatch.setattr(module, "BLOCK_TERMS", 300)  # queries in several blocks
    queries = hard_docs.filter("doc_id % 3 = 0 OR doc_id > 99 OR doc_id IS NULL")
    got = sorted(tuple(r) for r in top_k(hard_docs, queries, k).collect())
    want = brute(plain(hard_docs), plain(queries), k)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(got, want))
    assert sum(a[2] == b[2] for a, b in zip(got, want)) >= len(want) - 2  # a last digit may round the other way


def test_bounds_prune(hard_docs):
    """Blocks that cannot reach the k-th score are not scored, and nothing changes."""
    rows = [r for r in plain(hard_docs) if r[0] is not None]
    import numpy as np
    import pyarrow as pa
    shard = module.Shard.build(np.array([r[0] for r in rows]), np.ones(len(rows), bool), pa.array([r[1] or "" for r in rows]))
    module.BLOCK_DOCS, kept = 4, module.BLOCK_DOCS
    shard.weigh(float(shard.lengths.mean()))
    module.BLOCK_DOCS = kept
    at = np.arange(0, len(shard.terms), 3)
    weight = np.linspace(1, 3, len(at))
    docs, score = shard.search(at, weight, 5, 0.0)
    again, _ = shard.search(at, weight, 5, float(score[-1]))
    assert list(docs) == list(again) and len(shard.search(at, weight, 5, 1e9)[0]) == 0


def test_empty_tables(hard_docs, no_docs):
    assert top_k(no_docs, hard_docs.filter("doc_id < 9")).count() == 0
    assert top_k(hard_docs, no_docs).count() == 0


def test_queries_of_a_shard_are_answered_together(hard_docs, monkeypatch):
    """Many queries in few calls, each with the answer that it gets alone, whatever is done by matrices."""
    import numpy as np
    import pyarrow as pa
    rows = [r for r in plain(hard_docs) if r[0] is not None]
    monkeypatch.setattr(module, "BLOCK_DOCS", 4)
    calls, real = [], module.Shard.search_some
    monkeypatch.setattr(module.Shard, "search_some", lambda self, *a: calls.append(len(a[-1])) or real(self, *a))
    found = []
    for frequent, queries, postings in ((0, 1, 1), (3, 7, 40), (10**6, 128, 1 << 18)):
        monkeypatch.setattr(module, "FREQUENT", frequent)
        monkeypatch.setattr(module, "QUERIES", queries)
        monkeypatch.setattr(module, "POSTINGS", postings)
        shard = module.Shard.build(np.array([r[0] for r in rows]), np.ones(len(rows), bool), pa.array([r[1] or "" for r in rows]))
        shard.weigh(float(shard.lengths.mean()))
        rng = np.random.default_rng(1)
        asked = [np.flatnonzero(rng.random(len(shard.terms)) < p) for p in np.linspace(0, 0.5, 40)]
        first, at = np.append(0, np.cumsum([len(a) for a in asked])), np.concatenate(asked)
        weight = rng.uniform(1, 3, len(at))
        calls.clear()
        query, docs, score = shard.search_all(first, at, weight, 5, np.zeros(40))
        assert sum(calls) == 40 and (queries < 128 or len(calls) == 1)
        for q in range(40):
            alone, points = shard.search(at[first[q]:first[q + 1]], weight[first[q]:first[q + 1]], 5, 0.0)
            assert list(docs[query == q]) == list(alone) and np.allclose(score[query == q], points, atol=2e-6)
            total = np.zeros(len(rows))
            for a, w in zip(asked[q], weight[first[q]:]):
                part = slice(shard.edges[a], shard.edges[a + 1])
                total[shard.docs[part]] += w * shard.impact[part]
            assert np.allclose(points, np.sort(total[total > 0])[::-1][:5], atol=2e-6)
        found.append(sorted(zip(query, docs)))
    assert found[0] == found[1] == found[2]


def test_rows_without_id_do_not_push_equal_ones_out(spark):
    docs = spark.createDataFrame([(None, "same words"), (None, "same words"), (5, "same words"), (6, "same words"), (7, "others")], "doc_id long, text string").coalesce(1)
    assert [(r.rank, r.doc_id) for r in top_k(docs, docs.filter("doc_id = 5"), 3).orderBy("rank").collect()] == [(1, 5), (2, 6), (3, None)]
