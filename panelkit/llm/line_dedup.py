"""Line dedup with a log-template tree.

A line goes down a tree of fixed depth: by its number of tokens, then by its leading tokens, where
tokens with digits count as one variable field. In the leaf it joins the most similar template, if
enough tokens agree; where they differ the template becomes variable. Otherwise it starts a
template. Lines are taken in the order of the smallest document id they occur in, so the result
does not depend on how the work is dealt out, and lines that are equal but for fields are put
together before anything is shuffled. Leaves that only one document reaches send nothing more.
Short lines have too few tokens for a similarity: all of theirs lead, as they are, so that only
equal ones share a leaf.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.llm import exchange
from panelkit.llm.registry import query, table
from panelkit.llm.words import BLANK_WORDS, P1, mix, text_bytes, words_of

LEADING = 3
SIMILARITY = 0.75
MIN_TOKENS = 5  # lines of fewer are short
FIELD = np.uint64(0x5BD1E9955BD1E995)  # stands for a token with digits


class Lines:
    """The lines of a block with enough tokens."""

    def __init__(self, rows: pa.Table, leading: int, min_tokens: int):
        raw, at = text_bytes(rows["text"])
        words = words_of(rows["text"], BLANK_WORDS, False)
        breaks = np.concatenate([[0], np.cumsum(raw == 0x0A)])
        digits = np.concatenate([[0], np.cumsum((raw >= 0x30) & (raw <= 0x39))])
        line = breaks[words.start] + words.doc  # each document begins a line of its own
        opens = np.flatnonzero(np.diff(line, prepend=-1))
        size = np.diff(np.append(opens, len(line)))
        short = size < max(MIN_TOKENS, leading)
        token = np.where((digits[words.end] > digits[words.start]) & ~np.repeat(short, size), FIELD, words.hash)
        keep = size >= min_tokens
        self.first, self.size = opens[keep], size[keep]
        self.doc = words.doc[self.first]
        self.number = line[self.first] - self.doc - breaks[at[self.doc]]  # in its document, from 0
        self.token = token
        leaf = mix(self.size.astype(np.uint64))
        leads = np.where(short[keep], self.size, leading)
        for k in range(int(leads.max(initial=0))):
            on = leads > k
            leaf[on] = mix(leaf[on] * P1 + token[self.first[on] + k])
        self.leaf = leaf
        self.ids = rows["id"].to_numpy()[self.doc]

    def take(self, mask: np.ndarray) -> None:
        for name in ("first", "size", "doc", "number", "leaf", "ids"):
            setattr(self, name, getattr(self, name)[mask])

    def tokens(self, pick: np.ndarray) -> np.ndarray:
        size = self.size[pick]
        offset = np.cumsum(size) - size
        place = np.arange(size.sum()) + np.repeat(self.first[pick] - offset, size)
        return self.token[place]

    def distinct(self, buckets: int):
        """Each line's entry; per entry: bucket, an example, the smallest id."""
        every = np.arange(len(self.first))
        flat = self.tokens(every)
        power = np.cumprod(np.full(int(self.size.max(initial=1)), P1, np.uint64))
        offset = np.cumsum(self.size) - self.size
        place = np.arange(len(flat)) - np.repeat(offset, self.size)
        whole = mix(np.add.reduceat(flat * power[place], offset)) if len(flat) else np.zeros(0, np.uint64)
        bucket = ((self.leaf >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((whole, self.leaf, bucket))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(whole[order]) != 0) | (np.diff(self.leaf[order]) != 0)
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(fresh) - 1
        example = order[fresh]
        least = np.full(len(example), 2**63 - 1, np.int64)
        np.minimum.at(least, entry, self.ids)
        return entry, bucket[example], example, least


def grow_templates(tokens: np.ndarray, similarity: float) -> np.ndarray:
    """For each line (a row of tokens of one leaf) the place of the line that began its template."""
    templates, fixed = np.zeros_like(tokens), np.zeros(tokens.shape, bool)
    began, n = np.zeros(len(tokens), np.int64), 0
    out = np.empty(len(tokens), np.int64)
    for i, line in enumerate(tokens):
        same = (templates[:n] == line) & fixed[:n]
        # A token with digits agrees with a variable field of the template.
        share = (same | (~fixed[:n] & (line == np.uint32(FIELD & np.uint64(0xFFFFFFFF))))).mean(axis=1) if n else np.zeros(0)
        best = int(np.argmax(share)) if n else -1
        if best >= 0 and share[best] >= similarity:
            fixed[best] &= templates[best] == line
        else:
            best = n
            templates[n], fixed[n], began[n] = line, True, i
            n += 1
        out[i] = began[best]
    return out


def _first_seen(payloads: list[bytes], leading: int, similarity: float) -> list[bytes]:
    """For each entry the smallest id in which its template occurs."""
    leaf, ids, size, token = [], [], [], []
    for p in payloads:
        n = int.from_bytes(p[:4], "little")
        leaf.append(np.frombuffer(p, np.uint64, n, 4))
        ids.append(np.frombuffer(p, np.int64, n, 4 + 8 * n))
        size.append(np.frombuffer(p, np.int32, n, 4 + 16 * n).astype(np.int64))
        token.append(np.frombuffer(p, np.uint32, offset=4 + 20 * n))
    count = [len(x) for x in ids]
    leaf, ids, size, token = (np.concatenate(x) for x in (leaf, ids, size, token))
    start = np.cumsum(size) - size
    out = ids.copy()
    order = np.lexsort((ids, leaf))
    cuts = np.flatnonzero(np.diff(leaf[order])) + 1
    for group in np.split(order, cuts):
        if len(group) == 1:
            continue
        n = size[group[0]]
        lines = token[start[group][:, None] + np.arange(n)]
        # Equal lines of several blocks are one; order by smallest id, then by content.
        distinct, line = np.unique(lines, axis=0, return_inverse=True)
        line = line.ravel()
        least = np.full(len(distinct), 2**63 - 1, np.int64)
        np.minimum.at(least, line, ids[group])
        by_age = np.argsort(least, kind="stable")
        began = grow_templates(distinct[by_age], similarity if n >= max(MIN_TOKENS, leading) else 1.0) if len(distinct) > 1 else np.zeros(1, np.int64)
        first = np.empty(len(distinct), np.int64)
        first[by_age] = least[by_age][began]
        out[group] = first[line]
    return [x.tobytes() for x in np.split(out, np.cumsum(count)[:-1])]


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leading: int = LEADING, similarity: float = SIMILARITY, min_tokens: int = 1, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept (the remaining lines), and the columns
    named in ``carry``.

    A line is dropped if its template also occurs in a document with a smaller id, so of a recurring
    template the lines of its first document stay. Repeats within one document stay. Lines end at line
    feeds, tokens are split at blanks; lines of fewer than ``min_tokens`` tokens are left alone, and of the
    others those of fewer than MIN_TOKENS (or ``leading``, if more) recur only as they are. Null and
    empty texts have no lines; long texts are taken whole. Rows without an id count as before all others; rows with one id are one
    document in this comparison. Other columns are not read.
    """
    blocks = exchange.in_blocks(docs, id_col, text_col, carry=carry)
    buckets = exchange.pieces(docs, exchange.BUCKET_BYTES)

    def leaves(block, rows):
        lines = Lines(rows, leading, min_tokens)
        bucket, small, twice, _ = exchange.once_each(lines.leaf, lines.ids, buckets)
        return exchange.shared_question(block, bucket, small, twice)

    def shared(rows, told) -> Lines:
        lines = Lines(rows, leading, min_tokens)
        entry = exchange.once_each(lines.leaf, lines.ids, buckets)[3]
        if len(entry):
            lines.take(exchange.joined(told)[entry] > 0)
        return lines

    def contents(block, rows, told):
        lines = shared(rows, told)
        _, bucket, example, least = lines.distinct(buckets)
        sent, payloads = [], []
        for part in np.split(np.arange(len(example)), np.flatnonzero(np.diff(bucket)) + 1) if len(example) else []:
            pick = example[part]
            sent.append(int(bucket[part[0]]))
            payloads.append(len(part).to_bytes(4, "little") + lines.leaf[pick].tobytes() + least[part].tobytes() + lines.size[pick].astype(np.int32).tobytes() + lines.tokens(pick).astype(np.uint32).tobytes())
        return pa.table({"block": pa.array([block] * len(sent), pa.int32()), "bucket": pa.array(sent, pa.int32()), "payload": pa.array(payloads, pa.binary())})

    def dropped(rows, told):
        lines = shared(rows, told[0])
        entry = lines.distinct(buckets)[0]
        gone = lines.ids > exchange.joined(told[1], np.int64)[entry] if len(entry) else np.zeros(0, bool)
        doc, number = lines.doc[gone], lines.number[gone]
        edge = np.searchsorted(doc, np.arange(len(rows) + 1))
        kept, n_lines = [], []
        for d, text in enumerate(rows["text"].to_pylist()):
            parts = text.split("\n") if text else []
            n_lines.append(len(parts))
            out = set(number[edge[d]:edge[d + 1]].tolist())
            kept.append("\n".join(p for i, p in enumerate(parts) if i not in out) if out else text)
        return pa.table({"doc_id": exchange.ids_of(rows), "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(np.diff(edge), pa.int64()), "kept": pa.array(kept, pa.string())} | exchange.carried_of(rows, carry))

    seen = exchange.ask(blocks, leaves, exchange.shared_answer)
    first = exchange.ask_again(blocks, seen, contents, lambda payloads: _first_seen(payloads, leading, similarity))
    schema = exchange.with_carried("doc_id long, n_lines long, n_dropped long, kept string", blocks, carry)
    return exchange.two_answers(blocks, seen, first, dropped, schema)


@query("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
