"""N-gram Jaccard join with set-relation skipping.

A document's set holds its distinct word shingles. First the corpus is asked how many documents
hold each shingle. A set can only have a partner if at least the wanted share of it is held
elsewhere; all others are done. What is left is ordered by rarity, equal sets become one class, and
sets that have a rare shingle in common in their prefixes form a family, the only place where links
can be. Within a family index lists are cut into blocks by position and skipped by what a position
still allows, and the answers of a set are derived from those of a highly similar set: their
overlaps with a third set differ by no more than the two sets do, so most are settled by this
bound and the others by counting the difference alone. Every set gets all its answers, so that
its links are counted; links that several tasks see count in one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from panelkit.llm import exchange
from panelkit.llm.graph import components
from panelkit.llm.registry import query, table
from panelkit.llm.words import BLANK_WORDS, P1, P2, mix, rolled, words_of
from panelkit.session import store

FAMILY_BYTES = 32 << 20  # of sets joined in one task, beyond which a family is dealt out by shingle
ROW = "id long, known boolean, n long, one long, two long, held binary, prefix int"
HELD = [np.dtype(np.uint32), np.dtype(np.uint8)]


def need(n, m, percent: int):
    """Least overlap of sets of n and m elements that link: 100 * i >= percent * (n + m - i)."""
    return -(-(percent * (n + m)) // (100 + percent))


def shingles(column, n_words: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct shingles of all documents: document, hash (sorted by both), number of documents."""
    words = words_of(column, BLANK_WORDS, True)
    starts = np.flatnonzero(words.windows(n_words))
    doc, value = words.doc[starts], rolled(words.hash, n_words)[starts] if len(starts) else np.zeros(0, np.uint64)
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < n_words))
    whole = []
    for d in short:  # the whole sequence is one shingle
        value_of = np.uint64(count[d])
        for h in words.hash[words.first[d]:words.first[d + 1]].tolist():
            value_of = np.uint64((int(value_of) * int(P1) + h) % 2**64)
        whole.append(value_of)
    doc = np.concatenate([doc, short]).astype(np.int64)
    value = np.concatenate([value, mix(np.array(whole, np.uint64))])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (np.diff(doc) != 0) | (value[1:] != value[:-1])
    return doc[fresh], value[fresh], len(count)


def _add_up(payloads: list[bytes]) -> list[bytes]:
    """For each entry the number of documents with its fingerprint, up to 65535."""
    parts = [exchange.unpack(p, HELD) for p in payloads]
    small, count = (np.concatenate(x) for x in zip(*parts))
    _, entry = np.unique(small, return_inverse=True)
    total = np.minimum(np.bincount(entry, count), 65535).astype(np.uint16)[entry]
    return [t.tobytes() for t in np.split(total, np.cumsum([len(p[0]) for p in parts])[:-1])]


def _sets(rows: pa.Table, told: list[bytes], n_words: int, percent: int, buckets: int) -> pa.Table:
    """Every document with its set's size and key; the first of each key in the block with the set's
    shared shingles by rarity, if so many are shared that a partner is possible."""
    doc, value, n_docs = shingles(rows["text"], n_words)
    _, _, _, entry = exchange.once_each(value, None, buckets)
    count = exchange.joined(told, np.uint16)[entry].astype(np.int64)
    size = np.bincount(doc, minlength=n_docs)
    edge = np.concatenate([[0], np.cumsum(size)])
    total = lambda x: np.diff(np.concatenate([np.zeros(1, x.dtype), np.cumsum(x)])[edge])
    one, two = total(mix(value)), total(mix(value * P2 + P1))
    shared = total((count > 1).astype(np.int64))
    may = (size > 0) & (100 * shared >= percent * size)
    keys = np.column_stack([one, two]).view([("a", np.uint64), ("b", np.uint64)]).ravel()
    firsts = np.zeros(n_docs, bool)
    firsts[np.unique(keys, return_index=True)[1]] = True
    held: list[bytes | None] = [None] * n_docs
    for d in np.flatnonzero(may & firsts):
        mine, rare = value[edge[d]:edge[d + 1]], count[edge[d]:edge[d + 1]]
        mine, rare = mine[rare > 1], rare[rare > 1]
        held[d] = mine[np.lexsort((mine, rare))].tobytes()
    # Shingles no other document has come first in the order and take their part of the prefix.
    prefix = size - (-(-percent * size // 100)) + 1 - (size - shared)
    return pa.table({
        "id": rows["id"], "known": rows["known"], "n": pa.array(size, pa.int64()), "one": pa.array(one.view(np.int64)), "two": pa.array(two.view(np.int64)),
        "held": pa.array(held, pa.binary()), "prefix": pa.array(np.where(may, prefix, 0), pa.int32()), "carried": rows["carried"],
    })


def link_sets(sizes: np.ndarray, prefix: np.ndarray, sets: list[np.ndarray], percent: int, tell: Callable[[int, np.ndarray], None] | None = None) -> np.ndarray:
    """For each set the smallest place of a set it is connected to. ``sizes`` count also what no other
    document has; sets hold the rest in the common order of rarity. ``tell`` gets each set's place and
    the places of all sets it links to, if there are any."""
    back = np.argsort(sizes, kind="stable")
    size = sizes[back].astype(np.int64)
    length = np.array([len(sets[b]) for b in back], np.int64)
    flat = np.unique(np.concatenate([sets[b] for b in back]), return_inverse=True)[1]
    n, edge = len(back), np.concatenate([[0], np.cumsum(length)])
    owner = np.repeat(np.arange(n), length)
    place = np.arange(len(flat)) - edge[owner] + (size - length)[owner]  # position in the whole set
    by_token = np.argsort(flat, kind="stable")
    list_edge = np.searchsorted(flat[by_token], np.arange(flat.max() + 2))
    lists = owner[by_token]  # all holders of a shingle
    head = np.flatnonzero(place - (size - length)[owner] < prefix[back][owner])
    head = head[np.lexsort((place[head], flat[head]))]  # prefix lists, by position
    head_token, head_place, head_owner = flat[head], place[head], owner[head]
    width = int(size.max()) + 2
    head_key = head_token.astype(np.int64) * width + head_place

    root = np.arange(n)
    done = np.zeros(n, bool)
    tokens = lambda i: flat[edge[i]:edge[i + 1]]

    def holders(of: np.ndarray) -> np.ndarray:
        return lists[between(list_edge[of], list_edge[of + 1])]

    def connect(i: int, others: np.ndarray) -> None:
        if tell is not None:
            tell(back[i], back[others])
        gone = np.unique(np.append(root[others], root[i]))
        if len(gone) > 1:
            root[np.isin(root, gone)] = gone[0]

    mark = np.zeros(int(flat.max()) + 1, bool)
    for pivot in range(n):
        if done[pivot]:
            continue
        least, most = np.searchsorted(size, -(-percent * size[pivot] // 100)), np.searchsorted(size, 100 * size[pivot] // percent, "right")
        # Blocks of a list beyond this position leave too few elements for any partner.
        last = 100 * size[pivot] // percent - (-(-percent * size[pivot] // 100))
        mine = tokens(pivot)[:prefix[back[pivot]]].astype(np.int64)
        seen = head_owner[between(np.searchsorted(head_key, mine * width), np.searchsorted(head_key, mine * width + last, "right"))]
        seen = np.unique(seen[(seen >= least) & (seen < most)])
        mark[tokens(pivot)] = True
        overlap = np.zeros(n, np.int64)
        overlap[seen] = np.add.reduceat(mark[flat[between(edge[seen], edge[seen + 1])]].astype(np.int64), np.cumsum(length[seen]) - length[seen]) if len(seen) else 0
        mark[tokens(pivot)] = False
        alike = seen[(overlap[seen] >= need(size[pivot], size[seen], percent)) & (seen != pivot)]
        done[pivot] = True
        if not len(alike):
            continue
        connect(pivot, alike)
        todo = alike[~done[alike]]
        full = None
        for other in todo:
            done[other] = True
            if full is None:  # the pivot's overlaps with all sets, once for all derivations
                full = np.bincount(holders(tokens(pivot)), minlength=n)
            extra, missing = np.setdiff1d(tokens(other), tokens(pivot)), np.setdiff1d(tokens(pivot), tokens(other))
            wanted = need(size[other], size, percent)
            links = full - len(missing) >= wanted
            unsettled = ~links & (full + len(extra) >= wanted)
            if unsettled.any():
                exact = full + np.bincount(holders(extra), minlength=n) - np.bincount(holders(missing), minlength=n)
                links |= unsettled & (exact >= wanted)
            links[other] = False
            connect(other, np.flatnonzero(links))
    least_place = np.full(n, n)
    np.minimum.at(least_place, root, back)
    out = np.empty(n, np.int64)
    out[back] = least_place[root]
    return out


def between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    size = high - low
    size = np.maximum(size, 0)
    if not len(size) or not size.sum():
        return np.zeros(0, np.int64)
    offset = np.cumsum(size) - size
    return np.arange(offset[-1] + size[-1]) + np.repeat(low - offset, size)


def _link_family(part: int, rows: pa.Table, percent: int) -> pa.Table:
    """For each linked set a member it is connected to (a, b), and the rows it links to. Two sets
    count in the first part that both are dealt to."""
    node = rows["node"].to_numpy()
    order = np.argsort(node, kind="stable")
    held, dealt = rows["held"].to_pylist(), rows["dealt"].to_pylist()
    node, copies = node[order], rows["copies"].to_numpy()[order]
    parts = np.unique(np.concatenate([np.array(d) for d in dealt]))
    at = np.zeros((len(order), len(parts)), bool)
    for k, i in enumerate(order):
        at[k, np.searchsorted(parts, dealt[i])] = True
    before = at[:, parts < part]
    links, linked = np.zeros(len(order), np.int64), np.zeros(len(order), bool)

    def tell(i: int, others: np.ndarray) -> None:
        linked[i] = True
        links[i] = copies[others][~(before[others] & before[i]).any(axis=1)].sum()

    root = link_sets(rows["n"].to_numpy()[order], rows["prefix"].to_numpy()[order], [np.frombuffer(held[i], np.uint64) for i in order], percent, tell)
    return pa.table({"a": pa.array(node[linked], pa.int64()), "b": pa.array(node[root[linked]], pa.int64()), "links": pa.array(links[linked], pa.int64())})


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 4, percent: int = 85, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_links, group, and the columns named in ``carry``.

    Two rows link when 100 * intersection >= percent * union of their sets of distinct ``n_words``
    shingles (A-Z lower-cased; fewer words make one shingle of the whole). component_id is the
    smallest id reachable by links, the row's own included; rows without an id have no say in it and
    get null when all they reach have none. Connected rows, and only they, have the same group; it is null
    for rows without shingles. n_links is the number of other rows that link with the row. Null, empty and blank texts link with nothing. Rows with
    one id and different texts are nodes of their own. Other columns are not read.
    """
    blocks = exchange.in_blocks(docs, id_col, text_col, carry=carry)
    buckets = exchange.pieces(docs, exchange.BUCKET_BYTES)
    schema = StructType(StructType.fromDDL(ROW).fields + [blocks.schema["carried"]])

    def question(block, rows):
        _, value, _ = shingles(rows["text"], n_words)
        bucket, small = exchange.fingerprints(value, buckets)
        keys, count = np.unique((bucket.astype(np.uint64) << np.uint64(32)) | small, return_counts=True)
        return exchange.pack(block, (keys >> np.uint64(32)).astype(np.int64), [keys.astype(np.uint32), np.minimum(count, 255).astype(np.uint8)])

    counts = exchange.ask(blocks, question, _add_up)
    rows = store(exchange.conclude(blocks, counts, lambda rows, told: _sets(rows, told, n_words, percent, buckets), schema), "sets")
    copies = rows.filter("n > 0").groupBy("one", "two").agg(F.count(F.lit(1)).alias("copies"))
    classes = rows.filter("held IS NOT NULL").dropDuplicates(["one", "two"]).select("one", "two", "n", "prefix", "held").join(copies, ["one", "two"])
    classes = store(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    def prefixes(batches):
        for batch in batches:
            heads = [np.frombuffer(h, np.int64, p) for h, p in zip(batch["held"].to_pylist(), batch["prefix"].to_pylist())]
            node = np.repeat(batch["node"].to_numpy(), [len(h) for h in heads])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*heads, np.zeros(0, np.int64)])), pa.array(node, pa.int64())], ["shingle", "node"])

    heads = classes.select("held", "prefix", "node").mapInArrow(prefixes, "shingle long, node long")
    first = heads.groupBy("shingle").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    shared = store(heads.join(first, "shingle").select("shingle", "node", "first"), "heads")
    family = components(shared.select(F.col("node").alias("a"), F.col("first").alias("b")).distinct())
    sets = classes.select("node", "n", "prefix", "held", "copies").join(family, "node")
    # A family beyond FAMILY_BYTES is dealt out by its prefix shingles; each set goes where its own are.
    large = sets.groupBy("root").agg(F.sum(F.length("held")).alias("bytes")).select("root", F.ceil(F.col("bytes") / FAMILY_BYTES).cast("int").alias("parts"))
    sets = sets.join(large, "root")
    small = sets.filter("parts = 1").withColumn("part", F.lit(0).cast("long")).withColumn("dealt", F.array("part"))
    split = shared.join(sets.filter("parts > 1").select("node", "root", "parts"), "node").select("node", "root", F.pmod(F.xxhash64("shingle"), "parts").alias("part")).distinct()
    dealt = split.groupBy("node").agg(F.sort_array(F.collect_list("part")).alias("dealt"))
    split = split.join(sets.filter("parts > 1").join(dealt, "node"), ["node", "root"])
    columns = ["root", "part", "node", "n", "prefix", "held", "copies", "dealt"]
    links = small.select(columns).unionByName(split.select(columns)).groupBy("root", "part").applyInArrow(lambda key, t: _link_family(key[1].as_py(), t, percent), "a long, b long, links long")
    links = store(links, "links")
    joined = components(links.select("a", "b"))
    number = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = classes.select("one", "two", "node", "copies").join(joined, "node", "left").join(number, "node", "left")
    # A row also links to the others of its class.
    classes = classes.select("one", "two", F.coalesce("root", "node").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    # Rows that share a class or a root: the smallest id, taken before each shuffle.
    lowest = rows.filter("known AND n > 0").groupBy("one", "two").agg(F.min("id").alias("lowest"))
    lowest = lowest.join(classes, ["one", "two"], "left")
    reach = lowest.filter("root IS NOT NULL").groupBy("root").agg(F.min("lowest").alias("reach"))
    lowest = lowest.join(reach, "root", "left").select("one", "two", "root", F.coalesce("reach", "lowest").alias("reach"), "n_links")
    # A class none of whose rows has an id reaches one through its root.
    orphans = classes.join(lowest.select("one", "two"), ["one", "two"], "left_anti").join(reach, "root", "left").select("one", "two", "root", "reach", "n_links")
    out = rows.drop("held", "prefix").join(lowest.unionByName(orphans), ["one", "two"], "left")
    return out.select(
        F.expr("if(known, id, null)").alias("doc_id"), F.col("n").alias("n_shingles"), F.expr("if(n > 0, reach, if(known, id, null))").alias("component_id"),
        F.expr("if(n > 0, coalesce(n_links, 0L), 0L)").alias("n_links"),
        F.expr("if(n > 0, coalesce(string(root), concat_ws('/', one, two)), null)").alias("group"), *[F.col(f"carried.`{c}`") for c in carry],
    )


@query("op6_jaccard_join")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), n_words=4, percent=85).drop("group")
