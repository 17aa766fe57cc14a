"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt into groups of bounded size;
a group is packed by several islands, each a Spark group with a small population. A child takes whole
well-filled bins of one parent; bins of the other parent that hold any of their pieces are
dissolved, and the displaced pieces are put where they fit best. After each round an island's best
solution migrates to the next island. Bins that stay badly filled are dissolved and their pieces
dealt into new, fewer groups, until one group is left.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.llm.registry import query, table
from panelkit.session import store, store_counted

CAPACITY = 4096
END = 1  # id after each document
GROUP = 8192  # pieces packed together
ISLANDS, ROUNDS, GENERATIONS, POPULATION = 4, 3, 12, 4
WELL_FILLED = 0.99
CACHED_WORDS = 500_000  # ids of so many words are kept in a task
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- pieces -----------------------------------------------------------------------------------

class WordIds:
    """Ids of a text, word by word. No token spans a blank, so words can be looked up one by one.

    Words of ASCII and Latin letters are cut where the tokenizer's own pattern cuts them, and its model
    is asked once for each part; any other word, and one that may hold a special token, goes through
    the whole tokenizer.
    """

    PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
    PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # How the byte-level step shows each character.
        self.shown = {c: shown.pre_tokenize_str(chr(c))[0][0] for c in [*range(0x21, 0x7F), *range(0xC0, 0x100)]}
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def part(self, text: str) -> bytes:
        found = self.parts.get(text)
        if found is None:
            found = self.parts[text] = self.packed([t.id for t in self.model.tokenize(text.translate(self.shown))])
        return found

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, word: bytes) -> bytes:
        found = self.known.get(word)
        if found is None:
            text = word.decode()
            if "<" not in text and self.PLAIN.fullmatch(text):
                found = b"".join(map(self.part, self.PARTS.findall(text.lower())))
            else:
                found = self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
            self.known[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if len(self.known) > CACHED_WORDS:
            self.known, self.parts = {}, {}
        words = text.encode().split()
        ids = list(map(self.known.get, words))
        if None in ids:
            ids = [self.word(w) if x is None else x for w, x in zip(words, ids)]
        return b"".join(ids)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """One row per piece. The tokenizer's file has to lie at ``tokenizer`` on every executor."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordIds(tokenizer), np.array([END], "<u4").tobytes()
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                source, number, start, length, crc = [], [], [], [], []
                for i, text in enumerate(part["text"].to_pylist()):
                    ids = words.encode(text) + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at:at + 4 * capacity]
                        source.append(i)
                        number.append(k)
                        start.append(at // 4)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                yield pa.RecordBatch.from_arrays([part["doc_id"].take(pa.array(source, pa.int32())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return own.mapInArrow(cut, PIECE)


# --- the grouping genetic algorithm -----------------------------------------------------------

def best_fit(sizes: np.ndarray, items: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Put items into the bin with the least room that takes them, largest first; ``bins`` gets the places
    and ``room`` grows by a bin where none does."""
    free: dict[int, list[int]] = {}
    have = 0  # bit r: some bin has room r
    for b, r in enumerate(room):
        if r:
            free.setdefault(r, []).append(b)
            have |= 1 << r
    for i in items[np.argsort(-sizes[items], kind="stable")].tolist():
        size = int(sizes[i])
        above = have >> size
        if above:
            r = size + (above & -above).bit_length() - 1
            b = free[r].pop()
            if not free[r]:
                have ^= 1 << r
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins[i] = b
        r -= size
        room[b] = r
        if r:
            free.setdefault(r, []).append(b)
            have |= 1 << r


def packed(sizes: np.ndarray, bins: np.ndarray, items: np.ndarray, capacity: int) -> np.ndarray:
    """``bins`` with ``items`` best-fitted into what the others leave; bins are numbered anew."""
    out = np.full(len(sizes), -1)
    rest = np.ones(len(sizes), bool)
    rest[items] = False
    used, out[rest] = np.unique(bins[rest], return_inverse=True)
    room = (capacity - np.bincount(out[rest], sizes[rest], len(used))).astype(int).tolist()
    best_fit(sizes, items, out, room, capacity)
    return out


def fills(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, sizes)


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> float:
    """Mean square of how full the bins are: rewards full bins beside one nearly empty."""
    return float(np.mean((fills(sizes, bins) / capacity) ** 2))


def crossover(sizes: np.ndarray, giver: np.ndarray, taker: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Well-filled bins of ``giver`` go into ``taker`` whole."""
    full = fills(sizes, giver)
    good = np.flatnonzero(full >= np.quantile(full, 0.5))
    chosen = np.zeros(len(full), bool)
    chosen[rng.choice(good, max(1, int(len(good) * rng.uniform(0.2, 0.6))), replace=False)] = True
    moved = chosen[giver]
    struck = np.zeros(taker.max() + 1, bool)
    struck[taker[moved]] = True
    displaced = np.flatnonzero(struck[taker] & ~moved)
    child = np.where(moved, giver + len(struck), taker)
    return packed(sizes, child, displaced, capacity)


def mutate(sizes: np.ndarray, bins: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Dissolve the worst bins and a few others."""
    full = fills(sizes, bins)
    struck = np.zeros(len(full), bool)
    struck[np.argsort(full, kind="stable")[:2]] = True
    struck[rng.choice(len(full), min(len(full), 3), replace=False)] = True
    return packed(sizes, bins, rng.permutation(np.flatnonzero(struck[bins])), capacity)


def first_population(sizes: np.ndarray, capacity: int, rng: np.random.Generator, n: int) -> list[np.ndarray]:
    """Best fit decreasing, and variants that pack a random part of the pieces first."""
    out = []
    for k in range(n):
        early = np.flatnonzero(rng.random(len(sizes)) < (0.5 if k else 1.0))
        start = np.full(len(sizes), -1)
        room: list[int] = []
        best_fit(sizes, early, start, room, capacity)
        late = np.setdiff1d(np.arange(len(sizes)), early)
        best_fit(sizes, late, start, room, capacity)
        out.append(start)
    return out


def evolve(sizes: np.ndarray, population: list[np.ndarray], capacity: int, rng: np.random.Generator, generations: int) -> list[np.ndarray]:
    """Best first. Stops when the best has as few bins as the total allows."""
    least = ceil(int(sizes.sum()) / capacity)
    scored = sorted(((fitness(sizes, b, capacity), k, b) for k, b in enumerate(population)), key=lambda x: (-x[0], x[1]))
    number = len(scored)
    for _ in range(generations):
        if scored[0][2].max() + 1 <= least or len(scored) < 2:
            break
        a, b = sorted(rng.choice(len(scored), 2, replace=False))
        child = crossover(sizes, scored[a][2], scored[b][2], capacity, rng)
        if rng.random() < 0.5:
            child = mutate(sizes, child, capacity, rng)
        number += 1
        scored = sorted([*scored, (fitness(sizes, child, capacity), number, child)], key=lambda x: (-x[0], x[1]))[:-1]
    return [b for _, _, b in scored]


# --- islands ----------------------------------------------------------------------------------

ISLAND = "group long, island int, migrant boolean, keys binary, sizes binary, bins array<binary>"


def _island(group: int, island: int, migrant: bool, keys: bytes, sizes: bytes, population: list[np.ndarray]) -> dict:
    return {"group": group, "island": island, "migrant": migrant, "keys": keys, "sizes": sizes, "bins": [b.astype(np.int32).tobytes() for b in population]}


def _to_arrow(rows: list[dict]) -> pa.Table:
    kinds = [("group", pa.int64()), ("island", pa.int32()), ("migrant", pa.bool_()), ("keys", pa.binary()), ("sizes", pa.binary()), ("bins", pa.list_(pa.binary()))]
    return pa.Table.from_pylist(rows, pa.schema(kinds))


def _pack_groups(spark: SparkSession, pieces: DataFrame, n_groups: int, capacity: int, level: int) -> DataFrame:
    """key, length, sequence_id, place, fill of each piece. pieces: key, length."""
    def settle(key, rows):
        order = np.argsort(rows["key"].to_numpy(), kind="stable")
        keys, sizes = rows["key"].to_numpy()[order], rows["length"].to_numpy()[order]
        out = []
        for island in range(ISLANDS):
            rng = np.random.default_rng([level, key[0].as_py(), island])
            people = evolve(sizes, first_population(sizes, capacity, rng, POPULATION), capacity, rng, 0)
            out.append(_island(key[0].as_py(), island, False, keys.tobytes(), sizes.tobytes(), people))
            if people[0].max() + 1 == ceil(int(sizes.sum()) / capacity):  # no island can do better
                break
        return _to_arrow(out[-1:] if out[-1]["island"] < ISLANDS - 1 else out)

    def meet(key, rows, turn):
        group, island = (k.as_py() for k in key)
        own = [r for r in rows.to_pylist() if not r["migrant"]]
        if not own:
            return _to_arrow([])
        sizes = np.frombuffer(own[0]["sizes"], np.int64)
        come = sorted(b for r in rows.to_pylist() if r["migrant"] for b in r["bins"])
        people = [np.frombuffer(b, np.int32).astype(np.int64) for b in [*own[0]["bins"], *come]]
        people = evolve(sizes, people, capacity, np.random.default_rng([level, group, island, turn + 1]), GENERATIONS)[:POPULATION]
        return _to_arrow([_island(group, island, False, own[0]["keys"], own[0]["sizes"], people)])

    def met(turn):
        return lambda key, rows: meet(key, rows, turn)

    def best(key, rows):
        rows = sorted(rows.to_pylist(), key=lambda r: r["island"])
        sizes = np.frombuffer(rows[0]["sizes"], np.int64)
        heads = [np.frombuffer(r["bins"][0], np.int32).astype(np.int64) for r in rows]
        bins = max(heads, key=lambda b: (-b.max(), fitness(sizes, b, capacity)))
        order = np.argsort(bins, kind="stable")
        full = fills(sizes, bins).astype(np.int64)
        place = np.cumsum(sizes[order]) - sizes[order]
        offset = place - (np.cumsum(full) - full)[bins[order]]
        keys = np.frombuffer(rows[0]["keys"], np.int64)[order]
        number = (np.int64(level) << np.int64(56)) + (np.int64(key[0].as_py()) << np.int64(20)) + bins[order]
        return pa.table({"key": keys, "length": sizes[order], "sequence_id": number, "place": offset, "fill": full[bins[order]]})

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(n_groups)))
    islands = store(dealt.groupBy("group").applyInArrow(settle, ISLAND), "islands")
    for turn in range(ROUNDS):
        # A group with one island has reached the bound.
        open_ = islands.join(islands.groupBy("group").agg(F.max("island").alias("a"), F.min("island").alias("b")).filter("a > b").select("group"), "group", "left_semi")
        if open_.isEmpty():
            break
        away = open_.select("group", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.lit(True).alias("migrant"), F.lit(b"").alias("keys"), F.lit(b"").alias("sizes"), F.slice("bins", 1, 1).alias("bins"))
        islands = store(islands.unionByName(away).groupBy("group", "island").applyInArrow(met(turn), ISLAND), "islands")
    return islands.groupBy("group").applyInArrow(best, "key long, length long, sequence_id long, place long, fill long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a column length, 1 to ``capacity``) and sequence_id, offset for each.

    Sequences hold at most ``capacity``; offsets are gapless from 0. Equal pieces are packed like any
    others; an empty table gives none.
    """
    spark = pieces.sparkSession
    pieces = store(pieces.withColumn("key", F.monotonically_increasing_id()), "pieces")
    todo, n = store_counted(pieces.filter(F.col("length") < capacity).select("key", "length"), "small")
    done = None
    level = 0
    while n:
        groups = ceil(n / GROUP)
        out = store(_pack_groups(spark, todo, groups, capacity, level), "packed")
        settled = out if groups == 1 else out.filter(F.col("fill") >= WELL_FILLED * capacity)
        settled = settled.select("key", "sequence_id", F.col("place").alias("offset"))
        done = settled if done is None else done.unionByName(settled)
        if groups == 1:
            break
        todo, left = store_counted(out.filter(F.col("fill") < WELL_FILLED * capacity).select("key", "length"), "left")
        if left > n // 2:  # pieces that don't fill bins better in other company
            done = done.unionByName(out.filter(F.col("fill") < WELL_FILLED * capacity).select("key", "sequence_id", F.col("place").alias("offset")))
            break
        n, level = left, level + 1
    whole = pieces.filter(F.col("length") >= capacity).select("key", (-1 - F.col("key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return pieces.join(whole if done is None else whole.unionByName(done), "key").drop("key")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and END, cut into pieces of ``capacity`` if longer. Null and empty texts have the
    one id END. Rows with equal ids, or none, are documents of their own. Other columns are not read.
    """
    return pack(token_pieces(docs, tokenizer, capacity, id_col, text_col), capacity)


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
