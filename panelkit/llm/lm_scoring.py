"""Scores of whole documents by a gated recurrent language model and by a unigram base.

All training documents are counted: blocks send their distinct words with counts, buckets add them
up and answer. The network (see ``gated_network``) starts from these counts. It is trained in
rounds, which together draw every training document once: every task trains the same weights on its
share of the documents of the round, and the weights are averaged by tokens. Then every block scores
its documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.llm import exchange, gated_network as net
from panelkit.llm.registry import query, table
from panelkit.llm.words import BLANK_WORDS, LOWER, Words, mix, text_bytes, words_of
from panelkit.session import store

BLOCK = 10 << 20  # larger blocks than elsewhere, so that long documents have company in the lanes
ROUNDS = 3
ENTRY = [np.dtype(np.uint64), np.dtype(np.uint32), np.dtype(np.uint8)]
STATS = "class int, tokens long, words long, hash long, count long"


def held_out(id_col) -> F.Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def rare_class(column: pa.ChunkedArray, words: Words, places: np.ndarray | slice = slice(None)) -> np.ndarray:
    """By a word's last two bytes; of all words or those at ``places``."""
    raw, start, end = text_bytes(column)[0], words.start[places], words.end[places]
    last, size = LOWER[raw[end - 1]].astype(np.uint64), end - start
    other = np.where(size > 1, LOWER[raw[np.maximum(end - 2, 0)]], 0).astype(np.uint64)
    return (mix(last * np.uint64(256) + other) % np.uint64(net.RARE)).astype(np.uint8)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, the place of one of each, and the entry of every hash."""
    order = np.argsort(hashes)
    sorted_hashes = hashes[order]
    new = np.ones(len(hashes), bool)
    np.not_equal(sorted_hashes[1:], sorted_hashes[:-1], out=new[1:])
    entry = np.empty(len(hashes), np.int64)
    entry[order] = np.cumsum(new) - 1
    return sorted_hashes[new], order[new], entry


def _entries(rows: pa.Table, buckets: int):
    """Words; each one's entry; per entry hash, class, bucket, count in training documents."""
    words = words_of(rows["text"], BLANK_WORDS, True)
    hashes, example, entry = distinct(words.hash)
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")  # by bucket, then hash
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    hashes, bucket, kind, entry = hashes[order], bucket[order], rare_class(rows["text"], words, example[order]), place[entry]
    learned = ~flatten(rows["carried"])[words.doc]
    count = np.bincount(entry, learned, len(order)).astype(np.uint32)
    return words, entry, hashes, kind, bucket, count


def flatten(carried: pa.ChunkedArray) -> np.ndarray:
    """The carried mark: is the row held out?"""
    return exchange.carried_of(pa.table({"carried": carried}), ["held_out"])["held_out"].to_numpy(zero_copy_only=False).astype(bool)


def _add_up(rows: pa.Table) -> pa.Table:
    """Totals for the blocks, and under block -1 the bucket's most frequent words and its classes' totals."""
    block, bucket, payload = exchange.rows_of(rows)
    parts = [exchange.unpack(p, ENTRY) for p in payload]
    hashes, count, kind = (np.concatenate(x) for x in zip(*parts))
    hashes, example, entry = distinct(hashes)
    total = np.bincount(entry, count, len(hashes)).astype(np.int64)
    answers = [t.astype(np.uint32).tobytes() for t in np.split(np.minimum(total, 2**32 - 1)[entry], np.cumsum([len(p[0]) for p in parts])[:-1])]
    kind = kind[example]
    top = np.argsort(-total, kind="stable")[:net.KNOWN]
    top = top[total[top] > 0]
    sums = np.bincount(kind, total, net.RARE).astype(np.int64), np.bincount(kind, total > 0, net.RARE).astype(np.int64)
    stats = b"".join(x.tobytes() for x in (*sums, hashes[top].view(np.int64), total[top], kind[top].astype(np.int64)))
    return pa.table({"block": pa.array([*block, -1], pa.int32()), "bucket": pa.array([*bucket, bucket[0]], pa.int32()), "payload": pa.array([*answers, stats], pa.binary())})


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of all buckets that the task reads: class totals, and the most frequent words."""
    names = ["class", "tokens", "words", "hash", "count"]
    rare, top = np.zeros((2, net.RARE), np.int64), np.zeros((3, 0), np.int64)
    for batch in batches:
        for payload in batch["payload"].to_pylist():
            x = np.frombuffer(payload, np.int64)
            rare = rare + x[:2 * net.RARE].reshape(2, -1)
            top = np.concatenate([top, x[2 * net.RARE:].reshape(3, -1)], axis=1)
            top = top[:, np.lexsort((top[0], -top[1]))[:net.KNOWN]]
    none = pa.nulls(net.RARE, pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(net.RARE), pa.int32()), pa.array(rare[0]), pa.array(rare[1]), none, none], names)
    none = pa.nulls(top.shape[1], pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(top[2], pa.int32()), none, none, pa.array(top[0]), pa.array(top[1])], names)


class Vocabulary:
    """Slots of the frequent words, and what all others weigh."""

    def __init__(self, top: Sequence, classes: Sequence, ends: int):
        top = sorted(((r["count"], r["hash"], r["class"]) for r in top), key=lambda r: (-r[0], r[1]))[:net.KNOWN - 1]
        hashes = np.array([h for _, h, _ in top], np.int64).view(np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.slots = hashes[order], (order + 1).astype(np.int64)  # slot 0 is the end
        self.counts = np.zeros(net.KNOWN, np.int64)
        self.counts[0] = ends
        self.counts[1:len(top) + 1] = [c for c, _, _ in top]
        self.rare_tokens, self.rare_words = np.zeros(net.RARE, np.int64), np.zeros(net.RARE, np.int64)
        for r in classes:
            self.rare_tokens[r["class"]], self.rare_words[r["class"]] = r["tokens"], r["words"]
        self.tokens = int(self.rare_tokens.sum()) + ends
        self.words = int(self.rare_words.sum()) + (ends > 0)
        for c, _, k in top:
            self.rare_tokens[k] -= c
            self.rare_words[k] -= 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        """What tasks need of it, without the class: executors have no copy of this package."""
        return self.hashes, self.slots, self.counts, self.rare_tokens, self.rare_words

    def share(self, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return share_of_class(tokens, counts, self.rare_tokens, self.rare_words)

    def of(self, hashes: np.ndarray, kind: np.ndarray) -> np.ndarray:
        return slots_of(hashes, kind, self.hashes, self.slots)


def slots_of(hashes: np.ndarray, kind: np.ndarray, known: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The slot of each word that has one; of others their class, behind the slots."""
    at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
    found = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
    return np.where(found, slots[at] if len(known) else 0, net.KNOWN + kind.astype(np.int64))


def share_of_class(tokens: np.ndarray, counts: np.ndarray, rare_tokens: np.ndarray, rare_words: np.ndarray) -> np.ndarray:
    """log10 of a token's share of its class, 0 for those with a slot. The words of a class that
    training has not seen share one part, as in the base."""
    kind = np.maximum(tokens - net.KNOWN, 0)
    rest = np.log10(counts + 1.0) - np.log10(rare_tokens[kind] + rare_words[kind] + 1.0)
    return np.where(tokens < net.KNOWN, 0.0, rest)


def with_ends(values: np.ndarray, first: np.ndarray, end) -> np.ndarray:
    """Values per word, and ``end`` after each document."""
    return np.insert(values, first[1:], end)


def drawn(docs: DataFrame, turn: int, rounds: int) -> DataFrame:
    """The training documents of one round; all rounds together draw each once."""
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("draw")), F.lit(rounds))
    return docs.filter(~held_out(F.col("id")) & (draw == turn))


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int, id_col: str, text_col: str) -> dict[str, np.ndarray]:
    """Weights after training on all documents that are not held out."""
    spark = docs.sparkSession
    weights = net.begin(vocabulary.counts, vocabulary.rare_tokens)
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    words = spark.sparkContext.broadcast(vocabulary.arrays()[:2])
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast(net.flat(weights))

        def learn(batches, sent=sent):
            trainer, n = net.Trainer(net.unflat(sent.value)), 0
            for batch in batches:
                for low in range(0, len(batch), 512):  # bounds the memory
                    part = pa.Table.from_batches([batch.slice(low, 512)])
                    found = words_of(part["text"], BLANK_WORDS, True)
                    tokens = with_ends(slots_of(found.hash, rare_class(part["text"], found), *words.value), found.first, net.END)
                    trainer.train(tokens)
                    n += len(tokens)
            trainer.finish()
            if n:
                yield exchange.in_slices(np.append(net.flat(trainer.weights).astype(np.float64) * n, n))

        total = exchange.add_slices(drawn(own, turn, rounds).select("text").mapInArrow(learn, "slice int, part binary"), np.dtype(np.float64), 1)
        if total[-1]:
            weights = net.unflat(total[:-1] / total[-1])
    return weights


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words, A-Z lower-cased, and one end; null and empty texts have the end alone. Rows
    whose crc32 of the id as text leaves 2 modulo 7 are held out of all learning (no id counts as the
    empty text). base_score adds log10((count + 1) / (N + V + 1)) over the tokens; score is the network's
    log10 probability of the whole text. Rows with one id are scored each by itself. Without training
    documents the network stays at its beginning. Other columns are not read.
    """
    spark = docs.sparkSession
    marked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), held_out(F.col(f"`{id_col}`")).alias("held_out"))
    blocks = exchange.in_blocks(marked, "id", "text", BLOCK, ["held_out"])
    buckets = exchange.pieces(docs, exchange.BUCKET_BYTES)

    def question(key, rows):
        _, _, hashes, kind, bucket, count = _entries(exchange.tidy(rows), buckets)
        return exchange.pack(key[0].as_py(), bucket, [hashes, count, kind])

    counted = store(blocks.groupBy("block").applyInArrow(question, exchange.PACKED).groupBy("bucket").applyInArrow(_add_up, exchange.PACKED), "counts")
    stats = counted.filter("block = -1").select("payload").mapInArrow(_stats, STATS)
    top = stats.filter("hash IS NOT NULL").orderBy(F.desc("count"), "hash").limit(net.KNOWN).collect()
    classes = stats.filter("hash IS NULL").groupBy("class").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).collect()
    ends = marked.filter(~F.col("held_out")).count()
    vocabulary = Vocabulary(top, classes, ends)
    weights = train(docs, vocabulary, rounds, id_col, text_col)
    known = spark.sparkContext.broadcast((vocabulary.arrays(), net.flat(weights)))
    all_tokens, all_words = vocabulary.tokens, vocabulary.words

    def scored(rows, told):
        (top_hashes, top_slots, top_counts, rare_tokens, rare_words), w = known.value
        words, entry, hashes, kind, _, _ = _entries(rows, buckets)
        count = exchange.joined(told, np.uint32).astype(np.float64)
        slot = slots_of(hashes, kind, top_hashes, top_slots)
        size = np.diff(words.first)
        tokens = with_ends(slot[entry], words.first, net.END)
        first = words.first + np.arange(len(words.first))
        by_doc = lambda x: np.bincount(words.doc, x, len(size)) if len(x) else np.zeros(len(size))
        score = np.bincount(np.repeat(np.arange(len(size)), size + 1), net.score_documents(net.unflat(w), tokens, first).astype(float), len(size)) / np.log(10)
        score += by_doc(share_of_class(slot, count, rare_tokens, rare_words)[entry])
        base = by_doc(np.log10(count + 1)[entry]) + np.log10(top_counts[0] + 1) - (size + 1) * np.log10(all_tokens + all_words + 1)
        return pa.table({
            "doc_id": exchange.ids_of(rows), "held_out": pa.array(flatten(rows["carried"])), "n_tokens": pa.array(size + 1, pa.int64()),
            "n_known": pa.array(by_doc((count > 0)[entry].astype(float)).astype(np.int64) + int(top_counts[0] > 0)),
            "train_tokens": pa.array(np.full(len(size), all_tokens), pa.int64()), "base_score": pa.array(base), "score": pa.array(score),
        })

    return exchange.conclude(blocks, counted.filter("block >= 0"), scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


@query("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
