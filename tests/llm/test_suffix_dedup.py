import numpy as np
from hypothesis import given, settings, strategies as st

from llm_cases import plain
from panelkit.llm.suffix_dedup import common_prefixes, eights, suffix_dedup, two_stage_sort


def brute(rows, length):
    first = {}
    texts = [(float("-inf") if i is None else i, i, (t or "").encode()) for i, t in rows]
    for key, _, t in texts:
        for p in range(len(t) - length + 1):
            s = t[p:p + length]
            first[s] = min(first.get(s, key), key)
    out = []
    for key, doc, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p:p + length]] < key:
                gone[p:p + length] = b"\1" * length
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((doc, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=60), st.integers(0, 2))
def test_sort_is_that_of_all_suffixes(data, few):
    text = np.frombuffer(bytes(b % (2, 3, 256)[few] for b in data), np.uint8)
    order = two_stage_sort(text, np.ones(len(text), bool), len(text) + 8)
    suffix = lambda p: bytes(text[p:]) + b"\0" * (len(text) + 8)
    assert [suffix(p)[:len(text)] for p in order] == sorted(suffix(p)[:len(text)] for p in range(len(text)))
    assert sorted(order) == list(range(len(text)))
    want = [0] + [next((k for k in range(16) if suffix(a)[k] != suffix(b)[k]), 16) if len(text) >= 8 else None for a, b in zip(order, order[1:])]
    if len(text) >= 8:
        got = common_prefixes(np.append(eights(text), np.zeros(80, np.uint64)), order, 16)
        assert list(got) == want[:len(got)]


def test_as_brute_force(hard_docs):
    for length in (50, 24):
        got = sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(hard_docs, length=length).collect()], key=str)
        assert got == brute(plain(hard_docs), length)
        assert sum(r[2] for r in got) > 1000


def test_spans_cut_what_is_removed(hard_docs):
    for r in suffix_dedup(hard_docs).collect():
        assert sum(e - s for s, e in zip(r.span_starts, r.span_ends)) == r.n_removed


def test_empty_table(no_docs):
    assert suffix_dedup(no_docs).count() == 0
