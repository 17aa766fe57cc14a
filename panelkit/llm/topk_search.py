"""Exact BM25 top-k search with block-max pruning.

The index is a stored table of shards. In a shard documents with the same most frequent word stand
together and are cut into blocks of neighbours. Queries meet a shard many at a time. Postings of all
but the shard's most frequent terms are added up first. The frequent terms, which hold most of the
postings, have the largest impact of each block: these bound a query's scores in a block. The blocks
with a query's highest bounds are scored in full, and of the others those whose bound reaches the k-th
best score the task has seen. Bounds and scores of the frequent terms are products of matrices.
Statistics are those of all shards, so the shards' best lists merge exactly. Queries are taken in
blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelkit.llm import exchange
from panelkit.llm.registry import query, table
from panelkit.llm.words import PLAIN_WORDS, words_of
from panelkit.session import store

K1, B = 1.2, 0.75
SHARD_BYTES = 8 << 20  # of text in a shard, a single longer document apart
BLOCK_DOCS = 64
BLOCK_TERMS = 1_000_000  # (query, term) pairs searched for at once, which bounds what tasks are sent
FREQUENT = 512  # terms of a shard that are multiplied as a matrix
QUERIES, POSTINGS = 128, 1 << 18  # at once: queries, and postings of their other terms
CELLS = 1 << 22  # of a shard's tables of documents by terms and by queries
LEAD = 8  # one block in so many is scored first
DIGITS = 6  # of scores; ties go to the smaller id
SHARD = "ids binary, known binary, lengths binary, terms binary, edges binary, docs binary, counts binary"


@dataclass
class Shard:
    ids: np.ndarray
    known: np.ndarray
    lengths: np.ndarray  # words per document
    terms: np.ndarray
    edges: np.ndarray  # term i has the postings edges[i]:edges[i + 1]
    docs: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, known: np.ndarray, column) -> Shard:
        words = words_of(column, PLAIN_WORDS, True)
        n = len(ids)
        order = np.lexsort((words.hash, words.doc))
        doc, term = words.doc[order], words.hash[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (np.diff(doc) != 0) | (term[1:] != term[:-1])
        at = np.flatnonzero(fresh)
        doc, term, count = doc[at], term[at], np.diff(np.append(at, len(order)))
        # Each document's most frequent word, and then its length, say where it stands.
        top = np.lexsort((term, -count, doc))
        first = top[np.flatnonzero(np.diff(doc[top], prepend=-1))]
        main = np.zeros(n, np.uint64)
        main[doc[first]] = term[first]
        lengths = np.diff(words.first)
        stand = np.lexsort((lengths, main))
        place = np.empty(n, np.int64)
        place[stand] = np.arange(n)
        order = np.lexsort((place[doc], term))
        terms, edge = np.unique(term[order], return_index=True)
        return cls(ids[stand], known[stand], lengths[stand].astype(np.int32), terms, np.append(edge, len(order)).astype(np.int32), place[doc][order].astype(np.int32), count[order].astype(np.int32))

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms occur, and where they stand."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        there = np.flatnonzero(self.terms[at] == terms)
        return there, at[there]

    def weigh(self, average: float) -> None:
        """Impacts of all postings, and per term the blocks' bounds."""
        room = K1 * (1 - B + B * self.lengths / max(average, 1e-9))
        self.impact = self.counts * (K1 + 1) / (self.counts + room[self.docs])
        # The most frequent terms' impacts stand in a table of documents and terms, the largest of a block in another.
        often = np.argsort(-np.diff(self.edges), kind="stable")[:min(FREQUENT, max(1, CELLS // len(self.ids)))]
        self.column = np.full(len(self.terms), -1)
        self.column[often] = np.arange(len(often))
        column = np.repeat(self.column, np.diff(self.edges))
        own = np.flatnonzero(column >= 0)
        self.table = np.zeros((len(self.ids), len(often)))
        self.table[self.docs[own], column[own]] = self.impact[own]
        self.block_first = np.append(np.arange(0, len(self.ids), BLOCK_DOCS), len(self.ids))
        self.block_max = np.maximum.reduceat(self.table, self.block_first[:-1], axis=0)

    def search(self, at: np.ndarray, weight: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents with a score of ``floor`` at least, for weighted terms."""
        return self.search_all(np.array([0, len(at)]), at, weight, k, np.array([floor]))[1:]

    def search_all(self, first: np.ndarray, at: np.ndarray, weight: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, place and score of each query's k best documents with a score of its ``floor`` at least.
        Query q has the weighted terms first[q]:first[q + 1]."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        size = np.where(self.column[at] < 0, np.diff(self.edges)[at], 0)
        postings = np.append(0, np.cumsum(size))[first]
        most, low = max(1, min(QUERIES, CELLS // len(self.ids))), 0
        while low < len(floor):  # queries at once, which bounds the memory
            high = int(np.searchsorted(postings, postings[low] + POSTINGS, "right")) - 1
            high = min(max(high, low + 1), low + most, len(floor))
            own = slice(first[low], first[high])
            query, docs, score = self.search_some(first[low:high + 1] - first[low], at[own], weight[own], k, floor[low:high])
            found.append((query + low, docs, score))
            low = high
        return tuple(np.concatenate(x) for x in zip(*found))

    def search_some(self, first: np.ndarray, at: np.ndarray, weight: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, n_queries = len(self.ids), len(floor)
        query = np.repeat(np.arange(n_queries), np.diff(first))
        often = self.column[at] >= 0
        dense = np.zeros((n_queries, self.table.shape[1]))
        dense[query[often], self.column[at[often]]] = weight[often]
        query, at, weight = query[~often], at[~often], weight[~often]
        low, high = self.edges[at].astype(np.int64), self.edges[at + 1].astype(np.int64)
        posting = between(low, high)
        spot = np.repeat(query * n, high - low) + self.docs[posting]
        part = np.bincount(spot, self.impact[posting] * np.repeat(weight, high - low), n_queries * n).astype(float, copy=False).reshape(n_queries, n)
        bound = dense @ self.block_max.T + np.maximum.reduceat(part, self.block_first[:-1], axis=1)
        total, n_blocks = np.zeros_like(part), bound.shape[1]
        # What the blocks with the highest bounds reach says which others are left.
        lead = n_blocks - -(-n_blocks // LEAD)
        leading = bound >= np.partition(bound, lead, axis=1)[:, lead:lead + 1]
        for wave in (leading, ~leading):
            now = wave & (bound > 0) & (bound + 10.0**-DIGITS >= floor[:, None])
            for b in np.flatnonzero(now.any(axis=0)):
                asked, docs = np.flatnonzero(now[:, b]), slice(self.block_first[b], self.block_first[b + 1])
                total[asked, docs] = part[asked, docs] + dense[asked] @ self.table[docs].T
            new = np.flatnonzero(floor <= 0)
            if wave is leading and n > k and len(new):
                floor = floor.copy()
                floor[new] = np.round(np.partition(total[new], n - k, axis=1)[:, n - k], DIGITS)
        asked, docs = np.nonzero(total >= np.maximum(floor - 10.0**-DIGITS, np.finfo(float).tiny)[:, None])
        score = np.round(total[asked, docs], DIGITS)
        keep = score >= floor[asked]
        asked, docs, score = asked[keep], docs[keep], score[keep]
        best = best_of(asked, score, self.known[docs], self.ids[docs], k)
        return asked[best], docs[best], score[best]


def best_of(query: np.ndarray, score: np.ndarray, known: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, in their order; documents without an id come after equal ones."""
    order = np.lexsort((ids, ~known, -score, query))
    query = query[order]
    return order[np.arange(len(order)) - np.searchsorted(query, query) < k]


def between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    size = high - low
    if not len(size) or not size.sum():
        return np.zeros(0, np.int64)
    offset = np.cumsum(size) - size
    return np.arange(offset[-1] + size[-1]) + np.repeat(low - offset, size)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored shards of all rows."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for low in range(0, len(batch), 512):
                rows.append(batch.slice(low, 512))
                size += rows[-1]["bytes"].to_numpy().sum()
                if size >= SHARD_BYTES:
                    yield packed(rows)
                    rows, size = [], 0
        if rows:
            yield packed(rows)

    def packed(rows):
        part = pa.Table.from_batches(rows)
        built = Shard.build(part["id"].fill_null(0).to_numpy().astype(np.int64), part["id"].is_valid().to_numpy(), part["text"])
        return pa.RecordBatch.from_arrays([pa.array([getattr(built, f.split()[0]).tobytes()], pa.binary()) for f in SHARD.split(", ")], [f.split()[0] for f in SHARD.split(", ")])

    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return store(own.withColumn("bytes", F.octet_length("text").cast("long")).mapInArrow(shards, SHARD), "shards")


def opened(batch: pa.RecordBatch) -> Iterator[Shard]:
    kinds = (np.int64, bool, np.int32, np.uint64, np.int32, np.int32, np.int32)
    for row in batch.to_pylist():
        yield Shard(*(np.frombuffer(v, k) for v, k in zip(row.values(), kinds)))


def totals(index: DataFrame) -> tuple[int, float]:
    """Documents, and their mean number of words."""
    def count(batches):
        for batch in batches:
            lengths = [np.frombuffer(x, np.int32) for x in batch["lengths"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, lengths))], pa.int64()), pa.array([int(sum(x.sum() for x in lengths))], pa.int64())], ["n", "words"])

    n, words = index.select("lengths").mapInArrow(count, "n long, words long").agg(F.sum("n"), F.sum("words")).first()
    return n or 0, (words or 0) / max(n or 0, 1)


def query_blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Ids and distinct terms of the queries, in blocks of bounded size; rows with one id are one query."""
    def terms(batches):
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                words = words_of(pa.chunked_array([part["text"]]), PLAIN_WORDS, True)
                found = [np.unique(words.hash[a:b]).tobytes() for a, b in zip(words.first[:-1], words.first[1:])]
                yield pa.RecordBatch.from_arrays([part["id"], pa.array(found, pa.binary())], ["id", "terms"])

    own = queries.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).filter("id IS NOT NULL")
    ids: list[int] = []
    parts: list[np.ndarray] = []
    size = 0
    for row in store(own.mapInArrow(terms, "id long, terms binary"), "queries").orderBy("id").toLocalIterator():
        found = np.frombuffer(row["terms"], np.uint64)
        if ids and ids[-1] == row["id"]:
            parts[-1] = np.union1d(parts[-1], found)
            continue
        if size >= BLOCK_TERMS:
            yield ids, parts
            ids, parts, size = [], [], 0
        ids.append(row["id"])
        parts.append(found)
        size += len(found)
    if ids:
        yield ids, parts


def frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Number of documents of all shards with each term."""
    sent = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        total = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                own, edges = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["edges"], np.int32)
                spot = np.minimum(np.searchsorted(sent.value, own), max(len(sent.value) - 1, 0))
                there = sent.value[spot] == own if len(sent.value) else np.zeros(len(own), bool)
                total[spot[there]] += np.diff(edges)[there]
        yield exchange.in_slices(total)

    return exchange.add_slices(index.select("terms", "edges").mapInArrow(count, "slice int, part binary"), np.dtype(np.int64), len(terms))


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """query_id, rank, doc_id, score: the ``k`` best rows of ``docs`` for every row of ``queries``.

    Terms are runs of a-z, digits and bytes beyond ASCII after lower-casing A-Z; a query is the set of its
    terms. Scores are BM25 (k1 1.2, b 0.75, idf ln(1 + (N - df + 0.5) / (df + 0.5))), rounded to six
    digits; ties go to the smaller id, and rows without an id come after the others. Only rows with a
    common term are found, so blank queries find none. Queries without an id are not asked. Other columns
    are not read.
    """
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col)
    n, average = totals(index)
    out = None
    for ids, parts in query_blocks(queries, id_col, text_col):
        terms = np.unique(np.concatenate(parts))
        df = frequencies(index, terms)
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        first = np.append(0, np.cumsum([len(p) for p in parts]))
        sent = spark.sparkContext.broadcast((np.array(ids, np.int64), first, np.searchsorted(terms, np.concatenate(parts)).astype(np.int32), terms, idf, average))

        def search(batches, sent=sent):
            ids, first, asked, terms, idf, average = sent.value
            query_of = np.repeat(np.arange(len(ids)), np.diff(first))
            best = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool), np.zeros(0, np.int64)]  # query, score, known, id
            floor = np.zeros(len(ids))
            for batch in batches:
                for shard in opened(batch):
                    shard.weigh(average)
                    there, at = shard.find(terms)
                    local = np.full(len(terms), -1)
                    local[there] = at
                    here = np.flatnonzero(local[asked] >= 0)
                    own = np.searchsorted(query_of[here], np.arange(len(ids) + 1))
                    query, docs, score = shard.search_all(own, local[asked[here]], idf[asked[here]], k, floor)
                    best = [np.concatenate(x) for x in zip(best, (query, score, shard.known[docs], shard.ids[docs]))]
                    top = best_of(*best, k)
                    best = [x[top] for x in best]
                    last = np.searchsorted(best[0], np.arange(len(ids)), "right") - 1
                    full = np.bincount(best[0], minlength=len(ids)) == k
                    floor[full] = best[1][last[full]]
            yield pa.RecordBatch.from_arrays([pa.array(ids[best[0]]), pa.array(best[3], pa.int64(), mask=~best[2]), pa.array(best[1])], ["query_id", "doc_id", "score"])

        part = store(index.mapInArrow(search, "query_id long, doc_id long, score double"), "found")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def every_hundredth(id_col: str) -> Column:
    return F.pmod(F.col(id_col), F.lit(100)) == 0


ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT d.doc_id, coalesce(n, 0) AS dl FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM words GROUP BY 1) USING (doc_id)),
stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM lengths),
idf AS (SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, stats GROUP BY term, n),
scored AS (
  SELECT q.doc_id AS query_id, t.doc_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
  FROM (SELECT DISTINCT doc_id, term FROM tf WHERE doc_id % 100 = 0) q JOIN idf USING (term)
  JOIN tf t USING (term) JOIN lengths l ON l.doc_id = t.doc_id, stats GROUP BY ALL
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored QUALIFY rank <= 10
"""


@query("op2_topk_search", ORACLE)
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return top_k(docs, docs.filter(every_hundredth("doc_id")))
