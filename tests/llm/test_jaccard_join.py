import random
import re

import numpy as np
import pytest

from llm_cases import SCHEMA, plain
from panelkit.llm import jaccard_join as module
from panelkit.llm.jaccard_join import jaccard_join, link_sets, need


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        reach = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(reach) if reach else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (1, 60)])
def test_as_brute_force(hard_docs, k, percent):
    got = sorted([tuple(r)[:3] for r in jaccard_join(hard_docs, n_words=k, percent=percent).collect()], key=str)
    assert got == brute(plain(hard_docs), k, percent)


def near_copies(seed=3, n=90):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    bases, rows = [[rng.choice(vocab) for _ in range(120)] for _ in range(4)], []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(7)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i, " ".join(words)))
    return rows


def test_families_of_near_copies(spark, monkeypatch):
    rows = near_copies()
    frame = spark.createDataFrame([(i, t, None, None, None, None) for i, t in rows], SCHEMA)
    want = brute(rows, 4, 85)
    assert len({r[2] for r in want}) not in (1, len(want))
    assert sorted([tuple(r)[:3] for r in jaccard_join(frame).collect()], key=str) == want
    monkeypatch.setattr(module, "FAMILY_BYTES", 4000)  # families dealt out by shingle
    assert sorted([tuple(r)[:3] for r in jaccard_join(frame).collect()], key=str) == want


def test_local_join_against_all_pairs():
    rng = random.Random(5)
    for percent in (50, 80, 90):
        sets = []
        for _ in range(60):
            base = set(range(rng.choice([0, 100]), rng.choice([20, 120]) + 20)) if not sets or rng.random() < 0.4 else set(rng.choice(sets))
            for _ in range(rng.randrange(6)):
                base ^= {rng.randrange(200)}
            sets.append(base or {1})
        count = {t: sum(t in s for s in sets) for s in sets for t in s}
        sizes = np.array([len(s) for s in sets])
        held = [np.array(sorted((t for t in s if count[t] > 1), key=lambda t: (count[t], t)), np.uint64) for s in sets]
        shared = np.array([len(h) for h in held])
        prefix = np.maximum(sizes - (-(-percent * sizes // 100)) + 1 - (sizes - shared), 0)
        may = [i for i in range(60) if 100 * shared[i] >= percent * sizes[i]]
        got = link_sets(sizes[may], prefix[may], [held[i] for i in may], percent)
        root = list(range(len(may)))
        for i in range(len(may)):
            for j in range(i):
                a, b = sets[may[i]], sets[may[j]]
                if len(a & b) >= need(len(a), len(b), percent):
                    low, high = sorted((root[i], root[j]))
                    root = [low if r == high else r for r in root]
        assert list(got) == root


def test_groups_and_carried_columns(hard_docs):
    rows = jaccard_join(hard_docs, carry=["lang", "block"]).collect()
    assert all(r.lang == "en" and r.block is None and (r.group is None) == (r.n_shingles == 0) for r in rows)
    reach = {}
    for r in rows:
        if r.group is not None:
            assert reach.setdefault(r.group, r.component_id) == r.component_id


def test_empty_table(no_docs):
    assert jaccard_join(no_docs).count() == 0


def links_of(rows, k, percent):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    number = [sum(bool(a and b) and i != j and 100 * len(a & b) >= percent * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    return sorted([(doc, len(a), m) for (doc, _), a, m in zip(rows, sets, number)], key=str)


def test_links_are_counted(spark, hard_docs, monkeypatch):
    rows = near_copies() + [(100 + i, t) for i, t in near_copies()[:9]]
    frame = spark.createDataFrame([(i, t, None, None, None, None) for i, t in rows], SCHEMA)
    want = links_of(rows, 4, 85)
    assert len({m for *_, m in want}) > 5
    found = lambda df: sorted([(r.doc_id, r.n_shingles, r.n_links) for r in jaccard_join(df).collect()], key=str)
    assert found(frame) == want and found(hard_docs) == links_of(plain(hard_docs), 4, 85)
    monkeypatch.setattr(module, "FAMILY_BYTES", 4000)  # families dealt out by shingle
    assert found(frame) == want
