"""Substring dedup by difference-cover anchors.

A passage is a run of ``window`` words. Take a difference cover D modulo ``PERIOD``: for any two
places i and j there is a shift below PERIOD that brings both onto D. So if the same passage
starts at two places, the two have an anchor in common: ``ANCHOR`` words that begin inside the
passage at places of the documents that lie on D modulo PERIOD. Only anchors are hashed and asked
for first. Around an anchor found elsewhere the match is then extended: every window that holds
the whole anchor is asked for by a 128-bit hash, and a window found twice is a passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import exchange
from panelkit.llm.registry import query, table
from panelkit.llm.words import BLANK_WORDS, P2, Words, covered, rolled, words_of

WINDOW = 35
PERIOD = 21
COVER = (3, 6, 7, 12, 14)  # all differences modulo 21 occur
WIDE = [np.dtype(np.uint64), np.dtype(np.uint64), np.dtype(np.uint8)]


def anchors(words: Words, window: int) -> np.ndarray:
    """Places of the anchors."""
    place = np.arange(len(words.doc)) - words.first[words.doc]
    on = np.zeros(PERIOD, bool)
    on[list(COVER)] = True
    return np.flatnonzero(on[place % PERIOD] & words.windows(window - PERIOD + 1))


def _entries(words: Words, window: int, buckets: int):
    at = anchors(words, window)
    return at, exchange.once_each(rolled(words.hash, window - PERIOD + 1)[at], None, buckets)


def _extended(words: Words, window: int, buckets: int, told: np.ndarray):
    """Windows around shared anchors: places, then distinct 128-bit keys in bucket order with counts."""
    at, (_, _, _, entry) = _entries(words, window, buckets)
    at = at[told[entry] > 0] if len(at) else at
    reach = covered(np.maximum(at - PERIOD + 1, 0), at + 1, len(words.doc))
    place = np.flatnonzero(reach & words.windows(window))
    one, two = rolled(words.hash, window)[place], rolled(words.hash, window, P2)[place]
    bucket = (one % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((two, one, bucket))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    first = order[new]
    return place, bucket[first], one[first], two[first], np.bincount(entry, minlength=len(first)) > 1, entry


def _twice(payloads: list[bytes]) -> list[bytes]:
    parts = [exchange.unpack(p, WIDE) for p in payloads]
    one, two, own = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((two, one))
    same = (np.diff(one[order]) == 0) & (np.diff(two[order]) == 0)
    yes = own > 0
    yes[order[1:][same]] = True
    yes[order[:-1][same]] = True
    return [np.packbits(y).tobytes() for y in np.split(yes, np.cumsum([len(p[0]) for p in parts])[:-1])]


def _bits(payloads: list[bytes], buckets: np.ndarray) -> np.ndarray:
    """The packed answers, one per bucket, as one array."""
    sizes = np.unique(buckets, return_counts=True)[1]
    return np.concatenate([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p, n in zip(payloads, sizes, strict=True)] or [np.zeros(0, np.uint8)])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the remaining words, one space between).

    A word goes if a window of ``window`` words that covers it also starts anywhere else, in the same
    document too, judged on the input. Null and empty texts have no words; a document with fewer words
    than a window keeps all. Rows with equal ids, or none, are documents of their own. Other columns
    are not read.
    """
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    blocks = exchange.in_blocks(docs, id_col, text_col)
    buckets = exchange.pieces(docs, exchange.BUCKET_BYTES)

    def first(block, rows):
        bucket, small, twice, _ = _entries(words_of(rows["text"], BLANK_WORDS, False), window, buckets)[1]
        return exchange.shared_question(block, bucket, small, twice)

    def second(block, rows, told):
        _, bucket, one, two, twice, _ = _extended(words_of(rows["text"], BLANK_WORDS, False), window, buckets, exchange.joined(told))
        return exchange.pack(block, bucket, [one, two, twice.astype(np.uint8)])

    anchored = exchange.ask(blocks, first, exchange.shared_answer)
    verified = exchange.ask_again(blocks, anchored, second, _twice)

    def marked(rows, told):
        words = words_of(rows["text"], BLANK_WORDS, False)
        near, far = told
        place, bucket, *_, entry = _extended(words, window, buckets, exchange.joined(near))
        hit = place[_bits(far, bucket)[entry] > 0] if len(place) else place
        gone = covered(hit, hit + window, len(words.doc))
        kept, n_words = [], np.diff(words.first)
        for text, low, high in zip(rows["text"].to_pylist(), words.first[:-1], words.first[1:]):
            parts = text.encode().split()
            kept.append(b" ".join(parts if not gone[low:high].any() else [p for p, g in zip(parts, gone[low:high]) if not g]).decode())
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) * (n_words > 0) if len(n_words) else n_words
        return pa.table({"doc_id": exchange.ids_of(rows), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    return exchange.two_answers(blocks, anchored, verified, marked, "doc_id long, n_words long, n_removed long, kept string")


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(table(spark, sf_dir, "documents"))
    return kept.selectExpr("doc_id", "n_words", "n_removed", "sha2(kept, 256) AS kept_sha256")
