"""Suffix-array dedup: bytes of long strings that an earlier document has too are removed.

All windows of ``length`` bytes that are equal have to meet in one sorted array of suffixes. They
are dealt out by their smallest seed: of the 16-byte seeds inside a window, the one with the least
hash. Neighbouring windows mostly have the same smallest seed, so a document falls into short
fragments, each a run of windows with one seed. Seeds that only one document has are sorted out
first (see ``exchange``). A block sends each distinct fragment once, with the smallest id it has
there; a bucket sorts the suffixes of its fragments in two stages and reads repeats off the
adjacent common prefixes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import exchange
from panelkit.llm.registry import query, table
from panelkit.llm.words import P1, PIECE, _hash, mix, text_bytes

LENGTH = 50
SEED = 16
LOW32 = np.uint64(0xFFFFFFFF)


# --- two-stage suffix sorting -----------------------------------------------------------------

def eights(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that compares like them; zeros follow the text."""
    x = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    x = (x[:-1] << np.uint64(8)) | x[1:]
    x = (x[:-2] << np.uint64(16)) | x[2:]
    x = (x[:-4] << np.uint64(32)) | x[4:]
    return x[:len(text)]


def _direct_sort(loads: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
    """Places by their suffixes' first ``depth`` bytes: by eight, then ties by the next eight."""
    key = loads[place]
    order = np.argsort(key, kind="stable")
    place, key = place[order], key[order]
    fresh = np.ones(len(place), bool)  # begins a group of ties
    fresh[1:] = key[1:] != key[:-1]
    for at in range(8, depth, 8):
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        todo = np.flatnonzero(tied)
        if not len(todo):
            break
        key = loads[np.minimum(place[todo] + at, len(loads) - 1)]
        group = np.cumsum(fresh[todo])
        order = np.lexsort((key, group))
        place[todo] = place[todo[order]]
        key, group = key[order], group[order]
        fresh[todo[1:]] |= (key[1:] != key[:-1]) | (group[1:] != group[:-1])
    return place


def two_stage_sort(text: np.ndarray, wanted: np.ndarray, depth: int, loads: np.ndarray | None = None) -> np.ndarray:
    """Wanted places (a mask) in the order of their suffixes' first ``depth`` bytes at least.

    A suffix not larger than its successor, seen from its first two bytes, is sorted directly. Any
    other one is larger than its successor, which stands in a lower bucket of first bytes, so one
    scan over the buckets in their order puts all of those in place.
    """
    loads = eights(text) if loads is None else loads
    follows = np.append(text[1:], np.uint8(0))
    larger = text > follows
    wanted_here, needed = wanted, wanted.copy()
    frontier = np.flatnonzero(needed & larger)
    while len(frontier):  # successors that an induced suffix needs
        frontier = frontier[frontier + 1 < len(text)] + 1
        frontier = frontier[~needed[frontier]]
        needed[frontier] = True
        frontier = frontier[larger[frontier]]
    direct = _direct_sort(loads, np.flatnonzero(needed & ~larger), depth)
    edges = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    # A larger suffix at the very end of the text is only followed by zeros.
    if len(text) and needed[-1] and larger[-1]:
        waiting[text[-1]].append(np.array([len(text) - 1]))
    out = []
    for byte in range(256):
        bucket = np.concatenate([*waiting[byte], direct[edges[byte]:edges[byte + 1]]])
        waiting[byte] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[needed[before] & (text[before] > byte)]
        heads = text[before]
        before = before[np.argsort(heads, kind="stable")]
        heads = text[before]
        cuts = np.flatnonzero(np.diff(heads)) + 1
        for part in np.split(before, cuts) if len(before) else []:
            waiting[text[part[0]]].append(part)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted_here[order]].astype(np.int64)


def common_prefixes(loads: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in order, up to ``cap``."""
    out = np.zeros(len(order), np.int32)
    left, right, open_ = order[:-1], order[1:], np.arange(1, len(order))
    for at in range(0, cap, 8):
        a, b = loads[np.minimum(left + at, len(loads) - 1)], loads[np.minimum(right + at, len(loads) - 1)]
        differ = a ^ b
        same = differ == 0
        rest = differ[~same]
        out[open_[~same]] = at + sum((rest < np.uint64(1 << (64 - 8 * k))).astype(np.int32) for k in range(1, 8))
        out[open_[same]] = at + 8
        left, right, open_ = left[same], right[same], open_[same]
    return np.minimum(out, cap)


def earliest(text: np.ndarray, starts: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """For each window start the smallest owner of an equal window."""
    wanted = np.zeros(len(text), bool)
    wanted[starts] = True
    slot = np.zeros(len(text), np.int32)
    slot[starts] = np.arange(len(starts), dtype=np.int32)
    loads = eights(text)
    order = two_stage_sort(text, wanted, length, loads)
    if not len(order):
        return owner
    begins = np.flatnonzero(common_prefixes(loads, order, length) < length)
    rank = slot[order]
    least = np.minimum.reduceat(owner[rank], begins)
    out = np.empty(len(starts), np.int64)
    out[rank] = np.repeat(least, np.diff(np.append(begins, len(order))))
    return out


# --- fragments --------------------------------------------------------------------------------

@dataclass
class Fragments:
    start: np.ndarray  # first byte, which is the first window
    windows: np.ndarray  # number of windows
    doc: np.ndarray
    seed: np.ndarray  # hash

    def take(self, mask: np.ndarray) -> Fragments:
        return Fragments(self.start[mask], self.windows[mask], self.doc[mask], self.seed[mask])


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n neighbours."""
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (n - size)], x[n - size:]) if n > size else x


def fragments(raw: np.ndarray, at: np.ndarray, length: int) -> Fragments:
    parts: list[tuple] = []
    low = 0
    cuts = np.unique(np.append(np.searchsorted(at, np.arange(PIECE, len(raw), PIECE)), len(at) - 1))
    for high in cuts[cuts > 0]:  # whole documents at a time
        piece, own = raw[at[low]:at[high]], at[low:high + 1] - at[low]
        if len(piece) >= length:
            loads = eights(piece)
            seeds = mix(loads[:len(piece) - SEED + 1] * P1 + mix(loads[8:len(piece) - SEED + 9]))
            keys = (seeds & ~LOW32) | np.arange(len(seeds), dtype=np.uint64)
            doc = np.repeat(np.arange(len(own) - 1), np.diff(own))
            fits = np.flatnonzero(doc[:len(piece) - length + 1] == doc[length - 1:])
            if len(fits):
                seed_at = (_least(keys, length - SEED + 1) & LOW32).astype(np.int64)[fits]
                opens = np.ones(len(fits), bool)
                opens[1:] = (seed_at[1:] != seed_at[:-1]) | (doc[fits[1:]] != doc[fits[:-1]])
                first = np.flatnonzero(opens)
                parts.append((fits[first] + at[low], np.diff(np.append(first, len(fits))), doc[fits[first]] + low, seeds[seed_at[first]]))
        low = high
    empty = np.zeros(0, np.int64)
    start, windows, doc, seed = (np.concatenate(x) for x in zip(*parts)) if parts else (empty, empty, empty, empty.astype(np.uint64))
    return Fragments(start, windows, doc, seed)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    offset = np.cumsum(sizes) - sizes
    return np.arange(offset[-1] + sizes[-1]) + np.repeat(starts - offset, sizes)


def _distinct(raw, at, ids, told, length, buckets):
    """Fragments with a shared seed; each one's entry; per entry: bucket, an example, the smallest id."""
    parts = fragments(raw, at, length)
    _, _, _, entry = exchange.once_each(parts.seed, parts.doc, buckets)
    parts = parts.take(told[entry] > 0) if len(entry) else parts
    content = np.concatenate([_hash(raw, s, e) for s, e in _chunked(parts.start, parts.start + parts.windows + length - 1)] or [np.zeros(0, np.uint64)])
    bucket = ((parts.seed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((content, bucket))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(content[order]) != 0) | (np.diff(bucket[order]) != 0)
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(fresh) - 1
    example = order[fresh]
    least = np.full(len(example), 2**63 - 1, np.int64)
    np.minimum.at(least, entry, ids[parts.doc])
    return parts, entry, bucket[example], example, least


def _chunked(start, end):
    cuts = np.flatnonzero(np.diff(np.cumsum(end - start) // PIECE)) + 1 if len(start) else []
    return [(s, e) for s, e in zip(np.split(start, cuts), np.split(end, cuts)) if len(s)]


def _sorted_out(payloads: list[bytes], length: int) -> list[bytes]:
    """For each entry one bit per window: an equal window has a smaller id."""
    ids, windows, texts = [], [], []
    for p in payloads:
        n = int.from_bytes(p[:4], "little")
        ids.append(np.frombuffer(p, np.int64, n, 4))
        windows.append(np.frombuffer(p, np.int32, n, 4 + 8 * n).astype(np.int64))
        texts.append(np.frombuffer(p, np.uint8, offset=4 + 12 * n))
    count = [int(w.sum()) for w in windows]
    ids, windows, text = np.concatenate(ids), np.concatenate(windows), np.concatenate(texts)
    size = windows + length - 1
    starts = ranges(np.cumsum(size) - size, windows)
    owner = np.repeat(ids, windows)
    yes = earliest(text, starts, owner, length) < owner
    return [np.packbits(y).tobytes() for y in np.split(yes, np.cumsum(count)[:-1])]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (binary), and the removed
    runs as arrays span_starts and span_ends (bytes, end excluded).

    A byte goes if it is covered by a string of ``length`` bytes that also starts in a document with a
    smaller id, judged on the input. Matches never cross documents. Null and short texts keep all. Rows
    without an id count as before all others; rows with the same id are one document in this comparison
    and give a row each. Other columns are not read.
    """
    if length < SEED + 8:
        raise ValueError(f"a string has at least {SEED + 8} bytes")
    blocks = exchange.in_blocks(docs, id_col, text_col)
    buckets = exchange.pieces(docs, exchange.BUCKET_BYTES // 2)

    def seeds(block, rows):
        raw, at = text_bytes(rows["text"])
        parts = fragments(raw, at, length)
        bucket, small, twice, _ = exchange.once_each(parts.seed, parts.doc, buckets)
        return exchange.shared_question(block, bucket, small, twice)

    def contents(block, rows, told):
        raw, at = text_bytes(rows["text"])
        parts, _, bucket, example, least = _distinct(raw, at, rows["id"].to_numpy(), exchange.joined(told), length, buckets)
        sent, payloads = [], []
        for part in np.split(np.arange(len(example)), np.flatnonzero(np.diff(bucket)) + 1) if len(example) else []:
            pick = example[part]
            body = raw[ranges(parts.start[pick], parts.windows[pick] + length - 1)]
            sent.append(int(bucket[part[0]]))
            payloads.append(len(part).to_bytes(4, "little") + least[part].tobytes() + parts.windows[pick].astype(np.int32).tobytes() + body.tobytes())
        return pa.table({"block": pa.array([block] * len(sent), pa.int32()), "bucket": pa.array(sent, pa.int32()), "payload": pa.array(payloads, pa.binary())})

    def removed(rows, told):
        raw, at = text_bytes(rows["text"])
        ids = rows["id"].to_numpy()
        parts, entry, bucket, example, least = _distinct(raw, at, ids, exchange.joined(told[0]), length, buckets)
        n = parts.windows[example]
        sizes = np.add.reduceat(n, np.flatnonzero(np.diff(bucket, prepend=-1))) if len(n) else []
        bits = np.concatenate([np.unpackbits(np.frombuffer(p, np.uint8), count=int(c)) for p, c in zip(told[1], sizes, strict=True)] or [np.zeros(0, np.uint8)])
        later = ids[parts.doc] > least[entry] if len(entry) else np.zeros(0, bool)
        depth = np.zeros(len(raw) + 1, np.int32)
        np.add.at(depth, parts.start[later], 1)
        np.add.at(depth, parts.start[later] + parts.windows[later] + length - 1, -1)
        first, own = ~later, (np.cumsum(n) - n)
        hit = bits[ranges(own[entry[first]], parts.windows[first])] > 0
        starts = ranges(parts.start[first], parts.windows[first])[hit]
        np.add.at(depth, starts, 1)
        np.add.at(depth, starts + length, -1)
        gone = np.cumsum(depth[:-1]) > 0
        opens, closes = gone.copy(), gone.copy()
        inner = at[(at > 0) & (at < len(raw))]
        opens[1:] &= ~gone[:-1]
        opens[inner] = gone[inner]
        closes[:-1] &= ~gone[1:]
        closes[inner - 1] = gone[inner - 1]
        opens, closes = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        cut = np.searchsorted(opens, at)
        kept, data = [], raw.tobytes()
        for d in range(len(at) - 1):
            edges = [at[d], *np.column_stack([opens[cut[d]:cut[d + 1]], closes[cut[d]:cut[d + 1]]]).ravel().tolist(), at[d + 1]]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
        shift = np.repeat(at[:-1], np.diff(cut))
        lists = lambda x: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x - shift, pa.int32()))
        size = np.diff(at)
        return pa.table({
            "doc_id": exchange.ids_of(rows), "n_bytes": pa.array(size, pa.int64()),
            "n_removed": pa.array(size - np.array([len(k) for k in kept], np.int64), pa.int64()), "n_spans": pa.array(np.diff(cut), pa.int64()),
            "kept": pa.array(kept, pa.binary()), "span_starts": lists(opens), "span_ends": lists(closes),
        })

    seeded = exchange.ask(blocks, seeds, exchange.shared_answer)
    verified = exchange.ask_again(blocks, seeded, contents, lambda payloads: _sorted_out(payloads, length))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, span_starts array<int>, span_ends array<int>"
    return exchange.two_answers(blocks, seeded, verified, removed, schema)


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS kept_sha256")
