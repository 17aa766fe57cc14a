"""Words and their hashes over whole columns of text, without a Python object per word.

A word's hash sums a fixed random number per byte value times a power per place in the word, so
equal words have equal hashes in every task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20  # bytes that are hashed at once; bounds the temporary arrays
CACHED = 1 << 16  # the same for whole columns, in a core's cache; a longer document is hashed as a whole
P1, P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BYTES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _classes(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.ones(256, bool)
    for low, high in ranges:
        out[low:high + 1] = False
    return out


BLANK_WORDS = _classes((0x20, 0x20), (0x09, 0x0D))  # everything but blanks belongs to a word
PLAIN_WORDS = _classes((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # digits, a-z and bytes beyond ASCII
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the differences of 64-bit numbers over all their bits; one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= P2
    return x ^ (x >> np.uint64(32))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the place where each row begins, with the end; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


@dataclass
class Words:
    hash: np.ndarray  # of each word
    first: np.ndarray  # per document, its first word's place; then the number of words
    doc: np.ndarray  # of each word
    start: np.ndarray  # byte where it begins
    end: np.ndarray

    def windows(self, n: int) -> np.ndarray:
        """Whether n words of one document begin at each word."""
        fits = np.zeros(len(self.doc), bool)
        if len(fits) >= n:
            fits[:len(fits) - n + 1] = self.doc[:len(fits) - n + 1] == self.doc[n - 1:]
        return fits


def _spans(raw: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mark = inside[raw]
    at = at[at < len(raw)]
    opens, closes = mark.copy(), mark.copy()
    np.greater(mark[1:], mark[:-1], out=opens[1:])
    opens[at] = mark[at]
    np.greater(mark[:-1], mark[1:], out=closes[:-1])
    closes[at[at > 0] - 1] = mark[at[at > 0] - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def _hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    if not len(size):
        return np.zeros(0, np.uint64)
    offset = np.cumsum(size) - size
    place = np.arange(offset[-1] + size[-1]) - np.repeat(offset, size)
    power = np.cumprod(np.full(int(size.max()), P1, np.uint64))
    value = BYTES[raw[place + np.repeat(start, size)]]
    value *= power[place]
    return mix(np.add.reduceat(value, offset) + size.astype(np.uint64) * P2)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """P1 to the power of 1, 2, ...; its inverse modulo 2**64 to the power of 0, 1, ..."""
    inverse = np.full(size, pow(int(P1), -1, 2**64), np.uint64)
    inverse[:1] = 1
    return np.cumprod(np.full(size, P1, np.uint64)), np.cumprod(inverse)


def _hash_words(value: np.ndarray, start: np.ndarray, end: np.ndarray, power: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """``_hash`` by running sums over all bytes with powers of their places in the piece, taken back to places in the word."""
    total = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(value * power[:len(value)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * P2)


def words_of(column, inside: np.ndarray, lower: bool) -> Words:
    raw, at = text_bytes(column)
    hashes, starts, ends = [], [], []
    cuts = np.unique(np.searchsorted(at, np.arange(0, len(raw), CACHED)))
    cuts = np.append(cuts[cuts < len(at) - 1], len(at) - 1)
    inside, value = (inside[LOWER], BYTES[LOWER]) if lower else (inside, BYTES)
    low, cuts = 0, cuts[cuts > 0]
    powers = _powers(int(np.diff(at[cuts], prepend=0).max(initial=0)))
    for high in cuts:  # whole documents at a time
        piece = raw[at[low]:at[high]]
        start, end = _spans(piece, at[low:high + 1] - at[low], inside)
        hashes.append(_hash_words(value[piece], start, end, *powers))
        starts.append(start + at[low])
        ends.append(end + at[low])
        low = high
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    first = np.searchsorted(start, at)
    first[-1] = len(start)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), first, doc, start, end)


def rolled(values: np.ndarray, n: int, factor: np.uint64 = P1) -> np.ndarray:
    """A hash of every n neighbours: polynomial in ``factor``, built by doubling. n - 1 values shorter."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    done, width, power = None, 0, 1
    part, part_power, size = values, int(factor), 1
    rest = n
    while rest:
        if rest & 1:
            if done is None:
                done, width = part, size
            else:
                m = len(values) - width - size + 1
                done = done[:m] * np.uint64(part_power) + part[width:width + m]
                width += size
        rest >>= 1
        if rest:
            m = len(values) - 2 * size + 1
            part = part[:m] * np.uint64(part_power) + part[size:size + m]
            part_power = part_power * part_power % 2**64
            size *= 2
    return mix(done)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any [start, end)."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:n]) > 0
