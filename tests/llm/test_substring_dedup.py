import re
from collections import Counter

from llm_cases import plain
from panelkit.llm.substring_dedup import substring_dedup

WINDOW = 35


def brute(rows, window=WINDOW):
    texts = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((doc, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def test_as_brute_force(hard_docs):
    got = sorted([tuple(r) for r in substring_dedup(hard_docs).collect()], key=str)
    assert got == brute(plain(hard_docs))
    assert sum(r[2] for r in got) > 1000


def test_other_window(hard_docs):
    got = sorted([tuple(r) for r in substring_dedup(hard_docs, window=22).collect()], key=str)
    assert got == brute(plain(hard_docs), 22)


def test_empty_table(no_docs):
    assert substring_dedup(no_docs).count() == 0
