import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_cases import plain
from panelkit.llm import spelling
from panelkit.llm.spelling import Ranks, spelling_variants, suffix_order, vocabulary

LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def distance_is_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted([a, b], key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows, least=5):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= least}


def brute(words):
    out = {}
    for w, n in words.items():
        near = sorted((-m, x) for x, m in words.items() if distance_is_one(w, x))
        form = near[0][1] if near and -near[0][0] >= 5 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)
    rows = []
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, near, form_n))
    return sorted(rows)


def invented_words(seed, n, letters="abé"):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randint(6, 9))): rng.choice([5, 5, 6, 25, 30, 125, 700]) for _ in range(n)}


def answer(spark, words):
    rows = spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(3))
    return sorted(tuple(r) for r in rows.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_suffix_order_and_ranks():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(1, 4, 300), 0).astype(np.uint8)
    order = suffix_order(text)
    assert list(order) == sorted(range(301), key=lambda i: text[i:].tobytes())
    ranks, at = Ranks(text, 4), np.arange(302) % 302
    before = text[order - 1]
    for s in range(4):
        symbol = np.full(302, s)
        assert list(ranks.count(symbol, at)) == [int((before[:i] == s).sum()) for i in at]
        assert list(ranks.count_below(symbol, at)) == [int((before[:i] < s).sum()) for i in at]
    assert (ranks.count_all(at) == np.array([np.bincount(before[:i], minlength=4) for i in at])).all()


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed):
    words = invented_words(seed, 700)
    assert answer(spark, words) == brute(words)


def test_every_kind_of_error_at_every_place(spark):
    word = "abcdefgh"
    words = {word: 1000}
    for i in range(len(word) + 1):
        words[word[:i] + "x" + word[i:]] = 5
        words[word[:i] + word[i:i + 1] + word[i:]] = 6
        if i < len(word):
            words[word[:i] + "y" + word[i + 1:]] = 7
            words[word[:i] + word[i + 1:]] = 8
    words[word] = 1000
    assert answer(spark, words) == brute(words)


def test_hot_ends_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PART_WORDS", 40)
    monkeypatch.setattr(spelling, "SHARD_ROWS", 60)
    rng = random.Random(8)
    words = {"abc" + "".join(rng.choices("abcd", k=rng.randint(3, 6))): rng.choice([5, 40, 300]) for _ in range(500)}
    words |= {"".join(rng.choices("abcd", k=rng.randint(3, 6))) + "tion": rng.choice([5, 40]) for _ in range(300)}
    assert answer(spark, words) == brute(words)


def test_ties_and_chains(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "baaaaa": 25, "caaaaa": 24, "zzzzzz": 9}
    got = {r[0]: r for r in answer(spark, words)}
    assert got["aaaaaa"][1] == "aaaaab" and got["aaaaaa"][2] == "aaabbb" and got["zzzzzz"][1:] == (None, "zzzzzz", 9, 0, None)
    assert sorted(got.values()) == brute(words)


def test_long_words(spark):
    words = {"ab" * 2000: 100, "ab" * 2000 + "c": 5, "x" + "ab" * 2000: 6, "ab" * 1000 + "z" + "ab" * 1000: 7, "ab" * 1500: 9}
    assert answer(spark, words) == brute(words)


def test_words_are_counted_like_brute_force(spark, hard_docs):
    more = [(i, "Neighbour NEIGHBOUR×Écoutez colour,colours " * 40) for i in range(40)] + [(None, "Neighbour " * 9)]
    docs = hard_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r.word: r.n for r in vocabulary(docs).collect()}
    assert got == brute_words(plain(docs)) and any(n < 40 for n in got.values())


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    words = brute_words(plain(spark.read.parquet(f"{sf}/documents.parquet")))
    got = sorted(tuple(r) for r in spelling.op11_spelling_variants(spark, sf).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == brute(words) and len(got) > 100


def test_empty(spark, no_docs):
    assert spelling_variants(vocabulary(no_docs)).collect() == []
