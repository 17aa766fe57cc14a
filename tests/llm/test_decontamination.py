import re

import pytest

from llm_cases import plain
from panelkit.llm import decontamination as module
from panelkit.llm.decontamination import build_index, decontaminate, proximity_matches


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def brute(rows, items, n):
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for name, item in items:
            v = words(item)
            for k in range(max(len(v) - n, 0) + 1 if v else 0):
                p = v[k:k + n]
                for i in range(len(w) - len(p) + 1):
                    if w[i:i + len(p)] == p:
                        hit.update(range(i, i + len(p)))
                        found.add("" if name is None else str(name))
        out.append((doc, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(spark, hard_docs):
    texts = [t for _, t in plain(hard_docs) if t and len(t) > 300]
    rows = [(i, re.sub("[a-z]", lambda m: m[0].upper(), t[40:200]) + " unheard of") for i, t in enumerate(sorted(texts)[:12])]
    rows += [(50, None), (51, ""), (52, "another ROW"), (52, "word"), (None, "one word here"), (53, " ".join(["x"] * 12)), (54, "...!")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_as_brute_force(hard_docs, items, monkeypatch):
    want = brute(plain(hard_docs), [tuple(r) for r in items.collect()], 10)
    assert sum(r[5] for r in want) > 5
    assert sorted([tuple(r) for r in decontaminate(hard_docs, items).collect()], key=str) == want
    monkeypatch.setattr(module, "BLOCK_WORDS", 50)  # items in several blocks
    assert sorted([tuple(r) for r in decontaminate(hard_docs, items).collect()], key=str) == want


def test_proximity(spark, hard_docs):
    items = spark.createDataFrame([("a", "another ROW"), ("b", "id row another"), ("c", "one here word"), ("d", "missing word")], "item_id string, text string")
    index = build_index(hard_docs)
    for span, want in ((2, {"a"}), (3, {"a", "c"}), (5, {"a", "b", "c"})):
        assert {r.item for r in proximity_matches(index, items, span).collect()} == want


def test_empty_tables(hard_docs, no_docs, items):
    assert decontaminate(no_docs, items).count() == 0
    assert decontaminate(hard_docs, items.limit(0)).filter("contaminated").count() == 0
