import re
import tracemalloc
import zlib
from collections import Counter
from math import isclose, log10

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import plain
from panelkit.llm import gated_network as net, lm_scoring
from panelkit.llm.lm_scoring import Vocabulary, drawn, lm_scores, train
from panelkit.llm.words import BLANK_WORDS, BYTES, P1, P2, mix, words_of


def tokens_of(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())), None]


def test_counts_and_base_as_brute_force(hard_docs):
    rows = plain(hard_docs)
    out = lambda doc: zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2
    seen = Counter(t for doc, text in rows if not out(doc) for t in tokens_of(text))
    n, v = sum(seen.values()), len(seen)
    want = []
    for doc, text in rows:
        tokens = tokens_of(text)
        want.append((str(doc), out(doc), len(tokens), sum(seen[t] > 0 for t in tokens), n, sum(log10((seen[t] + 1) / (n + v + 1)) for t in tokens)))
    got = lm_scores(hard_docs, rounds=1).collect()
    key = lambda r: (r[0], r[2], round(r[5], 6))
    for a, b in zip(sorted(want, key=key), sorted([(str(r.doc_id), *r[1:]) for r in got], key=key), strict=True):
        assert a[:5] == b[:5] and isclose(a[5], b[5], rel_tol=1e-9)
        assert b[6] < 0
    assert {r.held_out for r in got} == {True, False}


@pytest.fixture(scope="module")
def weights():
    rng = np.random.default_rng(2)
    return {k: v + rng.standard_normal(v.shape).astype(np.float32) * np.float32(0.3) for k, v in net.begin(rng.integers(0, 50, net.KNOWN), rng.integers(0, 90, net.RARE)).items()}


def test_gradient_is_that_of_the_loss(weights):
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, net.KNOWN + net.RARE, (9, 5))
    tokens[4, 2] = tokens[7, 0] = net.END
    h = rng.standard_normal((5, net.HIDDEN)).astype(np.float32)
    g, _, _ = net.gradient(weights, tokens, h)
    for name in net.SHAPES:
        way = rng.standard_normal(net.SHAPES[name]).astype(np.float32)
        loss = [net.gradient({**weights, name: weights[name] + np.float32(e) * way}, tokens, h)[2] for e in (0.01, -0.01)]
        assert isclose((loss[0] - loss[1]) / 0.02, float((g[name] * way).sum()), rel_tol=0.05, abs_tol=2e-2), name


def test_probabilities_add_up(weights):
    state = np.random.default_rng(1).standard_normal((1, net.HIDDEN)).astype(np.float32)
    every = np.arange(net.KNOWN + net.RARE)
    assert isclose(np.exp(net.log_probability(weights, np.repeat(state, len(every), 0), every)).sum(), 1, rel_tol=1e-4)


def test_lanes_carry_the_state_over_whole_documents(weights):
    rng = np.random.default_rng(5)
    docs = [np.append(rng.integers(1, net.KNOWN + net.RARE, n), net.END) for n in (0, 3, 200, 1, 70, 0, 33, 150)]
    want = []
    for doc in docs:
        h = np.zeros((1, net.HIDDEN), np.float32)
        for t in doc:
            want.append(net.log_probability(weights, h, np.array([t]))[0])
            h = net.step(weights, (weights["embed"] @ weights["wx"] + weights["b"])[[t]], h)[0]
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    for lanes, window in ((3, 16), (512, 64), (1, 7)):
        got = net.score_documents(weights, np.concatenate(docs), first, lanes, window)
        assert np.allclose(got, want, atol=1e-3)


def test_learns_what_follows_what(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        words = ["red", "green", "blue", "grey"]
        at, text = rng.integers(4), []
        for _ in range(40):
            text.append(words[at])
            at = (at + 1) % 4 if rng.random() < 0.95 else rng.integers(4)
        rows.append((i, " ".join(text)))
    got = lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).filter("held_out").collect()
    assert sum(r.score for r in got) > 0.6 * sum(r.base_score for r in got)  # logarithms: nearer to 0 is better


def test_empty_table(no_docs):
    assert lm_scores(no_docs, rounds=1).count() == 0


def test_rounds_draw_every_training_document_once(spark):
    docs = spark.range(500).toDF("id")
    want = sorted(i for i in range(500) if zlib.crc32(str(i).encode()) % 7 != 2)
    for rounds in (1, 3, 7):
        assert sorted(r.id for turn in range(rounds) for r in drawn(docs, turn, rounds).collect()) == want


def test_training_does_not_depend_on_the_size_of_the_corpus(spark):
    docs = spark.createDataFrame([(i, f"one two three {i % 5}") for i in range(200)], "doc_id long, text string").coalesce(1)
    found = []
    for more in (0, 10**9):  # tokens that the vocabulary counts besides
        vocabulary = Vocabulary([], [{"class": k, "tokens": 25, "words": 1} for k in range(net.RARE)], 172)
        vocabulary.tokens += more
        found.append(net.flat(train(docs, vocabulary, 3, "doc_id", "text")))
    assert np.array_equal(*found)


def test_trainer_leaves_no_token_out(weights, monkeypatch):
    seen, real = [], net.gradient
    monkeypatch.setattr(net, "gradient", lambda w, tokens, h: seen.extend(tokens.T.ravel().tolist()) or real(w, tokens, h))
    tokens = np.random.default_rng(4).integers(0, net.KNOWN + net.RARE, 7 * 1280 + 1285)
    trainer = net.Trainer(weights)
    for part in (tokens[:4001], tokens[4001:9003], tokens[9003:]):
        trainer.train(part)
    trainer.finish()
    assert sorted(seen) == sorted(tokens.tolist())


def test_score_of_known_weights_is_that_of_a_plain_network(spark, monkeypatch, weights):
    """Token by token in double precision, with slots, classes and shares worked out anew."""
    from panelkit.llm import lm_scoring
    from panelkit.llm.words import BLANK_WORDS, words_of
    import pyarrow as pa

    monkeypatch.setattr(lm_scoring, "train", lambda *_: weights)
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["aa", "bb", "cc", "Dd", "ee7", "é"], rng.integers(0, 30))) for _ in range(40)] + ["unseen words aa", None]
    ids = list(range(40)) + [next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 7 == 2), 300]
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in ids}
    hash_of = lambda t: int(words_of(pa.array([t.decode()]), BLANK_WORDS, True).hash[0])
    counts = Counter(t for i, text in zip(ids, texts) if not out[i] for t in tokens_of(text) if t)
    order = sorted(counts, key=lambda t: (-counts[t], int(np.uint64(hash_of(t)).view(np.int64))))
    slot = {None: net.END, **{t: k + 1 for k, t in enumerate(order)}}
    w = {k: v.astype(float) for k, v in weights.items()}

    def softmax(x):
        x = np.exp(x - x.max())
        return x / x.sum()

    def probability(text):
        total, h = 0.0, np.zeros(net.HIDDEN)
        for t in tokens_of(text):
            p = softmax(h @ w["wc"] + w["bc"])
            if t in slot:
                s = slot[t]
                total += np.log10(p[s // net.SLOTS] * softmax(h @ w["ww"][s // net.SLOTS] + w["bw"][s // net.SLOTS])[s % net.SLOTS])
            else:  # all words of training have slots, so its class has no other share to give away
                kind = int(rare(t))
                s = net.KNOWN + kind
                total += np.log10(p[net.FREQUENT + kind])
            gate, state = w["embed"][s] @ w["wx"] + w["b"], h @ w["wh"]
            z, r = (1 / (1 + np.exp(-(gate[:2 * net.HIDDEN] + state[:2 * net.HIDDEN])))).reshape(2, -1)
            n = np.tanh(gate[2 * net.HIDDEN:] + r * state[2 * net.HIDDEN:])
            h = n + z * (h - n)
        return total

    def rare(t):
        column = pa.chunked_array([pa.array([t.decode()])])
        return lm_scoring.rare_class(column, words_of(column, BLANK_WORDS, True))[0]

    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in lm_scores(docs, rounds=1).collect()}
    for i, text in zip(ids, texts):
        assert isclose(got[i], probability(text), rel_tol=1e-4, abs_tol=1e-4), (i, text)


def test_every_exponential_is_taken_once(weights, monkeypatch):
    """A window's gradient takes one per class and token, one per slot of its class, and one for both gates."""
    class Counting:
        taken = 0

        def __getattr__(self, name):
            return getattr(np, name)

        def exp(self, x, **more):
            self.taken += np.size(x)
            return np.exp(x, **more)

    rng = np.random.default_rng(7)
    tokens = rng.integers(0, net.KNOWN + net.RARE, (32, 20))
    h = np.zeros((20, net.HIDDEN), np.float32)
    want = net.gradient(weights, tokens, h)
    counting = Counting()
    monkeypatch.setattr(net, "np", counting)
    got = net.gradient(weights, tokens, h)
    assert counting.taken <= tokens.size * (net.CLASSES + 2 * net.HIDDEN) + (tokens < net.KNOWN).sum() * net.SLOTS
    assert want[2] == got[2] and all(np.array_equal(want[0][k], got[0][k]) for k in net.SHAPES)


def test_rows_far_below_others_keep_their_probabilities(weights):
    """Logits are moved by one number for all rows, unless that would leave a row nothing."""
    far = {**weights, "wc": weights["wc"] * np.float32(0)}
    far["wc"][0] = 500  # the first unit moves all classes of a row alike
    states = np.random.default_rng(9).standard_normal((50, net.HIDDEN)).astype(np.float32)
    states[:, 0] = np.linspace(-1, 1, 50)
    tokens = np.random.default_rng(10).integers(0, net.KNOWN + net.RARE, 50)
    together = net.log_probability(far, states, tokens)
    alone = [net.log_probability(far, states[i:i + 1], tokens[i:i + 1])[0] for i in range(50)]
    assert np.isfinite(together).all() and np.allclose(together, alone, atol=1e-3)


def test_a_document_that_ends_passes_no_gradient_on(weights):
    """A window with an end in the middle is two windows, of which the second begins anew."""
    rng = np.random.default_rng(11)
    tokens = rng.integers(1, net.KNOWN + net.RARE, (20, 6))
    tokens[8] = net.END
    h = rng.standard_normal((6, net.HIDDEN)).astype(np.float32) * np.float32(0.5)
    whole, after, loss = net.gradient(weights, tokens, h)
    first, _, loss_a = net.gradient(weights, tokens[:9], h)
    second, last, loss_b = net.gradient(weights, tokens[9:], np.zeros_like(h))
    assert isclose(loss, (9 * loss_a + 11 * loss_b) / 20, rel_tol=1e-5) and np.allclose(after, last, atol=1e-6)
    for k in net.SHAPES:
        assert np.allclose(whole[k], (9 * first[k] + 11 * second[k]) / 20, atol=1e-5), k


def test_probabilities_do_not_depend_on_what_is_scored_beside(weights):
    rng = np.random.default_rng(12)
    count = 2 * net.PIECE + 77
    tokens, states = rng.integers(0, net.KNOWN + net.RARE, count), rng.standard_normal((count, net.HIDDEN)).astype(np.float32)
    parts = [net.log_probability(weights, states[low:low + 97], tokens[low:low + 97]) for low in range(0, count, 97)]
    assert np.allclose(net.log_probability(weights, states, tokens), np.concatenate(parts), atol=1e-4)


def room(work):
    """Bytes that are allocated at once, beside what stays."""
    tracemalloc.start()
    try:
        kept = work()
        now, most = tracemalloc.get_traced_memory()
        return most - now, kept
    finally:
        tracemalloc.stop()


def test_a_window_keeps_no_second_copies(weights):
    """Before tiles of classes and states written in place: over 9 MB for 4,096 tokens."""
    tokens = np.random.default_rng(13).integers(0, net.KNOWN, (32, 128))
    assert room(lambda: net.gradient(weights, tokens, np.zeros((128, net.HIDDEN), np.float32)))[0] < 8e6


def test_words_are_hashed_in_a_cores_cache():
    """Before running sums over small pieces: over 20 bytes of room for each byte of text."""
    texts = pa.array(["some words of a text that goes on and on " * 25] * 1000)
    assert room(lambda: words_of(texts, BLANK_WORDS, True))[0] < 10 * texts.nbytes


def test_hashes_are_those_of_the_definition():
    texts = ["", "a", "B bb  b", None, "x" * 3000 + " tail", "\u00c4rger\x0b\u00c9tude " * 9000, "Same same SAME", "no blank at the end"]
    got = words_of(pa.array(texts), BLANK_WORDS, True)
    every = [t for text in texts for t in tokens_of(text)[:-1]]
    for word, value in zip(every, got.hash, strict=True):
        total = sum(int(BYTES[b]) * pow(int(P1), i + 1, 2**64) for i, b in enumerate(word)) + len(word) * int(P2)
        assert mix(np.array([total % 2**64], np.uint64))[0] == value


def test_classes_are_looked_up_of_distinct_words(monkeypatch):
    asked, real = [], lm_scoring.rare_class
    monkeypatch.setattr(lm_scoring, "rare_class", lambda *given: asked.append(real(*given)) or asked[-1])
    carried = pa.chunked_array([pa.StructArray.from_arrays([pa.array([False, True])], ["held_out"])])
    rows = pa.table({"text": pa.chunked_array([pa.array(["one two two One", "two three two"])]), "carried": carried})
    _, entry, hashes, kind, _, count = lm_scoring._entries(rows, 5)
    assert len(asked[0]) == len(hashes) == len(kind) == 3
    assert sorted(count.tolist()) == [0, 2, 2] and np.array_equal(hashes[entry], words_of(rows["text"], BLANK_WORDS, True).hash)
