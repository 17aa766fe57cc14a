"""Benchmark decontamination on a distributed positional inverted index.

The index is a table of segments: each holds the postings of a few MB of whole documents, sorted by
term, and is written once to the shared folder. A search takes test phrases in blocks of bounded
size. In each segment a phrase's terms are taken from the rarest on; their lists of places, shifted
by the term's offset in the phrase, are intersected until none or the exact matches are left.
Proximity search intersects the documents of the lists and slides over their merged places.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.llm.registry import query, table
from panelkit.llm.words import PLAIN_WORDS, words_of
from panelkit.session import store

WINDOW = 10
SEGMENT_BYTES = 4 << 20  # of text in a segment, a single longer document apart
BLOCK_WORDS = 200_000  # words of test phrases searched for at once, which bounds what tasks are sent
SEGMENT = "segment string, ids binary, known binary, first binary, terms binary, edges binary, places binary"


@dataclass
class Segment:
    """Postings of some documents: the places of term t are places[edges[i]:edges[i + 1]] where terms[i] = t."""

    first: np.ndarray  # per document the place of its first word; then the number of words
    terms: np.ndarray
    edges: np.ndarray
    places: np.ndarray

    @classmethod
    def build(cls, column) -> Segment:
        words = words_of(column, PLAIN_WORDS, True)
        order = np.argsort(words.hash, kind="stable")
        terms, edge = np.unique(words.hash[order], return_index=True)
        return cls(words.first.astype(np.int32), terms, np.append(edge, len(order)).astype(np.int32), order.astype(np.int32))

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Each term's place in the index, -1 if no document here has it."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def phrase(self, at: np.ndarray) -> np.ndarray:
        """Places where the phrase of these terms begins, within one document."""
        size = self.edges[at + 1] - self.edges[at]
        order = np.argsort(size, kind="stable")
        found = self.places[self.edges[at[order[0]]]:self.edges[at[order[0]] + 1]] - order[0]
        for k in order[1:]:
            other = self.places[self.edges[at[k]]:self.edges[at[k] + 1]]
            spot = np.minimum(np.searchsorted(other, found + k), len(other) - 1)
            found = found[other[spot] == found + k]
            if not len(found):
                return found
        inside = found >= 0
        found = found[inside]
        return found[self.doc(found) == self.doc(found + len(at) - 1)]

    def near(self, at: np.ndarray, span: int) -> np.ndarray:
        """Documents in which all terms (distinct) lie within ``span`` words."""
        lists = [self.places[self.edges[k]:self.edges[k + 1]] for k in at]
        lists.sort(key=len)
        docs = np.unique(self.doc(lists[0]))
        for other in lists[1:]:
            docs = np.intersect1d(docs, self.doc(other))
        lists = [x[np.isin(self.doc(x), docs)] for x in lists]
        merged = np.concatenate(lists)
        kind = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        order = np.argsort(merged, kind="stable")
        merged, kind = merged[order], kind[order]
        last = np.full((len(lists), len(merged)), -1)  # the last place of each term up to here
        for k in range(len(lists)):
            last[k] = np.maximum.accumulate(np.where(kind == k, merged, -1))
        low = last.min(axis=0) if len(merged) else merged
        good = (low >= 0) & (merged - low < span)
        return np.unique(self.doc(merged[good])[self.doc(merged[good]) == self.doc(low[good])])

    def doc(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, "right") - 1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index of all rows. Null texts have no words."""
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            bounds = np.cumsum(batch["bytes"].to_numpy()) // SEGMENT_BYTES
            for low, high in zip(*(lambda c: (np.append(0, c), np.append(c, len(batch))))(np.flatnonzero(np.diff(bounds)) + 1)):
                part = batch.slice(low, high - low)
                rows.append(part)
                size += int(part["bytes"].to_numpy().sum())
                if size >= SEGMENT_BYTES:
                    yield pack(rows)
                    rows, size = [], 0
        if rows:
            yield pack(rows)

    def pack(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        part = pa.Table.from_batches(rows)
        built = Segment.build(part["text"])
        ids = part["id"].fill_null(0).to_numpy().astype(np.int64)
        known = part["id"].is_valid().to_numpy()
        cells = [uuid.uuid4().hex, *(x.tobytes() for x in (ids, known, built.first, built.terms, built.edges, built.places))]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.string() if isinstance(c, str) else pa.binary()) for c in cells], [f.split()[0] for f in SEGMENT.split(", ")])

    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return store(own.withColumn("bytes", F.octet_length("text").cast("long")).mapInArrow(segments, SEGMENT), "index")


def opened(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray, Segment]]:
    for row in batch.to_pylist():
        array = lambda name, kind: np.frombuffer(row[name], kind)  # noqa: B023,E731
        yield row["segment"], array("ids", np.int64), array("known", bool), Segment(array("first", np.int32), array("terms", np.uint64), array("edges", np.int32), array("places", np.int32))


def documents_of(index: DataFrame) -> DataFrame:
    """segment, at, doc_id, n_words of every indexed row; (segment, at) names the row."""
    def rows(batches):
        for batch in batches:
            for name, ids, known, part in opened(batch):
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(ids), pa.string()), pa.array(np.arange(len(ids)), pa.int32()),
                    pa.array(ids, pa.int64(), mask=~known), pa.array(np.diff(part.first), pa.int64()),
                ], ["segment", "at", "doc_id", "n_words"])

    return index.select("segment", "ids", "known", "first", F.lit(b"").alias("terms"), F.lit(b"").alias("edges"), F.lit(b"").alias("places")).mapInArrow(rows, "segment string, at int, doc_id long, n_words long")


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list[str], list[np.ndarray]]]:
    """Names and word hashes of the items, in blocks of bounded size."""
    names, hashes, size = [], [], 0
    for row in items.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")).toLocalIterator():
        words = words_of(pa.array([row[1]], pa.string()), PLAIN_WORDS, True).hash
        names.append(row[0] or "")
        hashes.append(words)
        size += len(words)
        if size >= BLOCK_WORDS:
            yield names, hashes
            names, hashes, size = [], [], 0
    if names:
        yield names, hashes


def phrase_matches(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """segment, at, starts (of covered words in the document), ends, items: per indexed row and block of
    items with any exact occurrence of a window of an item."""
    out = None
    for names, hashes in item_blocks(items, id_col, text_col):
        # Equal windows of several items are one phrase.
        phrases: dict[bytes, tuple[np.ndarray, set]] = {}
        for name, words in zip(names, hashes):
            for k in range(max(len(words) - window, 0) + 1 if len(words) else 0):
                phrase = words[k:k + window]
                phrases.setdefault(phrase.tobytes(), (phrase, set()))[1].add(name)
        spread = index.sparkSession.sparkContext.broadcast(list(phrases.values()))

        def search(batches, spread=spread):
            wanted = spread.value
            terms = np.unique(np.concatenate([p for p, _ in wanted])) if wanted else np.zeros(0, np.uint64)
            slots = [np.searchsorted(terms, p) for p, _ in wanted]
            for batch in batches:
                for name, _, _, part in opened(batch):
                    here = part.find(terms)
                    covered: dict[int, list] = {}
                    found: dict[int, set] = {}
                    for slot, (phrase, owners) in zip(slots, wanted):
                        at = here[slot]
                        if at.min(initial=0) < 0:
                            continue
                        starts = part.phrase(at)
                        for s, d in zip(starts.tolist(), part.doc(starts).tolist()):
                            covered.setdefault(d, []).append((s - int(part.first[d]), s - int(part.first[d]) + len(phrase)))
                            found.setdefault(d, set()).update(owners)
                    docs = sorted(covered)
                    spans = [np.array(sorted(set(covered[d]))) for d in docs]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * len(docs), pa.string()), pa.array(docs, pa.int32()), pa.array([s[:, 0].tolist() for s in spans], pa.list_(pa.int32())),
                        pa.array([s[:, 1].tolist() for s in spans], pa.list_(pa.int32())), pa.array([sorted(found[d]) for d in docs], pa.list_(pa.string())),
                    ], ["segment", "at", "starts", "ends", "items"])

        part = index.mapInArrow(search, "segment string, at int, starts array<int>, ends array<int>, items array<string>")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = index.sparkSession.createDataFrame([], "segment string, at int, starts array<int>, ends array<int>, items array<string>")
    return out


def proximity_matches(index: DataFrame, items: DataFrame, span: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """doc_id, item: documents that have all distinct words of an item within ``span`` words, in any order."""
    out = index.sparkSession.createDataFrame([], "doc_id long, item string")
    for names, hashes in item_blocks(items, id_col, text_col):
        spread = index.sparkSession.sparkContext.broadcast([(n, np.unique(h)) for n, h in zip(names, hashes) if len(h)])

        def search(batches, spread=spread):
            for batch in batches:
                for _, ids, known, part in opened(batch):
                    for name, terms in spread.value:
                        at = part.find(terms)
                        docs = part.near(at, span) if at.min() >= 0 else np.zeros(0, int)
                        yield pa.RecordBatch.from_arrays([pa.array(ids[docs], pa.int64(), mask=~known[docs]), pa.array([name] * len(docs), pa.string())], ["doc_id", "item"])

        out = out.unionByName(index.mapInArrow(search, "doc_id long, item string"))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items (sorted as strings), contaminated.

    Words are runs of a-z, digits and bytes beyond ASCII after lower-casing A-Z. A window is ``window``
    consecutive words of an item, or all words of a shorter one. A document's word is hit if it lies in
    any occurrence of a window. Null and blank texts have no words and blank items no window. Items
    with one id count once; an item without an id is listed as the empty string. Rows with equal ids are
    rows of their own. Other columns are not read.
    """
    index = build_index(docs, id_col, text_col)
    hits = phrase_matches(index, items, item_id_col, item_text_col, window)
    # One row per document and block of items; a document's spans are no more than its words.
    hits = hits.groupBy("segment", "at").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    spans = F.array_sort(F.arrays_zip("starts", "ends"))
    # Sorted by start: each span adds what lies beyond the furthest end so far.
    step = lambda acc, s: F.struct((acc["hit"] + F.greatest(s["ends"] - F.greatest(s["starts"], acc["far"]), F.lit(0))).alias("hit"), F.greatest(acc["far"], s["ends"]).alias("far"))
    hits = hits.select("segment", "at", "items", F.aggregate(spans, F.struct(F.lit(0).alias("hit"), F.lit(0).alias("far")), step)["hit"].cast("long").alias("n_hit"))
    out = documents_of(index).join(hits, ["segment", "at"], "left")
    none = F.array().cast("array<string>")
    out = out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"))
    return out.withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", F.col("n_hit") > 0)


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
