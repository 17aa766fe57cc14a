import random
import zlib
from math import ceil

import numpy as np
import pytest

from llm_cases import plain
from panelkit.llm import packing as module
from panelkit.llm.packing import crossover, evolve, first_population, fills, pack, pack_documents, tokenizer_path


def direct(rows, capacity):
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(tokenizer_path()), []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            piece = ids[at:at + capacity]
            out.append((doc, k, at, len(piece), zlib.crc32(piece.tobytes())))
    return sorted(out, key=str)


def check_sequences(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity", [4096, 300])
def test_pieces_are_the_tokenizers(hard_docs, capacity):
    rows = pack_documents(hard_docs, tokenizer_path(), capacity).collect()
    assert sorted([tuple(r)[:5] for r in rows], key=str) == direct(plain(hard_docs), capacity)
    n = check_sequences(rows, capacity)
    assert n <= 1.02 * ceil(sum(r.length for r in rows) / capacity) + 1


def test_odd_texts(spark):
    texts = ["don't <|endoftext|> x<|startoftext|>y", "Á é ́ ΣΣ OΣ", "a b c\u0085d", "\U0001f600\U0001f600 你好 123abc'll", "İI\x00b\x1cc"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted([tuple(r)[:5] for r in pack_documents(frame, tokenizer_path()).collect()], key=str) == direct(list(enumerate(texts)), 4096)


def test_levels_and_islands(spark, monkeypatch):
    monkeypatch.setattr(module, "GROUP", 60)
    rng = random.Random(1)
    sizes = [rng.choice([1, 20, 33, 34, 35, 40, 48, 52, 60, 70, 99, 100]) for _ in range(400)]
    rows = pack(spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id long, length long"), 100).collect()
    assert sorted(r.length for r in rows) == sorted(sizes)
    assert ceil(sum(sizes) / 100) <= check_sequences(rows, 100) <= 1.1 * sum(sizes) / 100 + 1


def test_crossover_keeps_every_piece_and_evolution_improves():
    rng = np.random.default_rng(4)
    sizes = rng.integers(20, 60, 150)
    people = first_population(sizes, 100, rng, 4)
    child = crossover(sizes, people[0], people[1], 100, rng)
    assert (child >= 0).all() and fills(sizes, child).max() <= 100 and set(child) == set(range(child.max() + 1))
    after = evolve(sizes, people, 100, rng, 60)
    assert after[0].max() <= min(p.max() for p in people)


def test_empty_table(no_docs):
    assert pack_documents(no_docs, tokenizer_path()).count() == 0
