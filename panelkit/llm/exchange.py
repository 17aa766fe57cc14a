"""Questions that blocks of documents ask of the whole corpus.

Several operators have to know which of a document's hashes occur elsewhere, or how often. Rows of
(hash, document) would be many and a hash that a third of all documents share would meet in one
task. Instead the documents are dealt into blocks of a few MB. A block sends every hash once, with
what is known of it inside the block, in one packed row per bucket of the hash space. The bucket
puts the blocks' rows together and sends each block a packed answer in the order of its question.
So a frequent hash costs one entry per block, and tasks are even in size.

Blocks are dealt by what is in the row and their rows are sorted, so a task that is run again after
a lost executor builds the same block. The documents' exchange is the same subplan in each step and
Spark runs it once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

BLOCK_BYTES = 2 << 20  # of the input's stored size
BUCKET_BYTES = 8 << 20
NO_ID = -(2**63)  # stands for a missing document id: before all others
PACKED = "block int, bucket int, payload binary"


def stored_bytes(df: DataFrame) -> int:
    """The planner's estimate of the input's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def pieces(df: DataFrame, each: int) -> int:
    """Number of parts: no fewer than shuffle partitions, more if the input asks for it."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(min(max(least, stored_bytes(df) // each), 2**30))


def in_blocks(docs: DataFrame, id_col: str, text_col: str, each: int = BLOCK_BYTES, carry: Sequence[str] = ()) -> DataFrame:
    """id, known, text, carried (a struct of other columns that come along), block.

    Rows without an id get ``NO_ID`` and known = false.
    """
    n = pieces(docs, each)
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(True).alias("none"))
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), carried.alias("carried"))
    own = own.select(F.coalesce("id", F.lit(NO_ID)).alias("id"), F.col("id").isNotNull().alias("known"), "text", "carried")
    return own.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int"))


def tidy(block: pa.Table) -> pa.Table:
    """Rows in an order that does not depend on how they came."""
    return block.take(pc.sort_indices(block, sort_keys=[("id", "ascending"), ("known", "ascending"), ("text", "ascending")]))


def pack(block: int, buckets: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    """One row per bucket; ``buckets`` is sorted. The payload is the columns, one after the other."""
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    low, high = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(buckets)]])
    if not len(buckets):
        low = high = np.zeros(0, int)
    return pa.table({
        "block": pa.array(np.full(len(low), block, np.int32)), "bucket": pa.array(buckets[low].astype(np.int32)),
        "payload": pa.array([b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(low, high)], pa.binary()),
    })


def unpack(payload: bytes, kinds: list[np.dtype]) -> list[np.ndarray]:
    n, out, at = len(payload) // sum(k.itemsize for k in kinds), [], 0
    for k in kinds:
        out.append(np.frombuffer(payload, k, n, at))
        at += n * k.itemsize
    return out


def rows_of(table: pa.Table) -> tuple[list[int], list[int], list[bytes]]:
    table = table.take(pc.sort_indices(table, sort_keys=[("block", "ascending"), ("bucket", "ascending")]))
    return table["block"].to_pylist(), table["bucket"].to_pylist(), table["payload"].to_pylist()


def ask(blocks: DataFrame, question: Callable[[int, pa.Table], pa.Table], answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """question(block, rows) gives packed rows; answer(payloads of one bucket) one payload for each."""
    def send(key, rows):
        return question(key[0].as_py(), tidy(rows))

    def reply(rows):
        block, bucket, payload = rows_of(rows)
        return pa.table({"block": pa.array(block, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "payload": pa.array(answer(payload), pa.binary())})

    asked = blocks.groupBy("block").applyInArrow(send, PACKED)
    return asked.groupBy("bucket").applyInArrow(reply, PACKED)


def ask_again(blocks: DataFrame, answers: DataFrame, question: Callable[[int, pa.Table, list[bytes]], pa.Table], answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """The same with the answers to an earlier question at hand (its payloads by bucket)."""
    def send(key, rows, told):
        return question(key[0].as_py(), tidy(rows), rows_of(told)[2])

    def reply(rows):
        block, bucket, payload = rows_of(rows)
        return pa.table({"block": pa.array(block, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "payload": pa.array(answer(payload), pa.binary())})

    asked = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(send, PACKED)
    return asked.groupBy("bucket").applyInArrow(reply, PACKED)


def conclude(blocks: DataFrame, answers: DataFrame, result: Callable[[pa.Table, list[bytes]], pa.Table], schema: str | StructType) -> DataFrame:
    """result(rows, payloads by bucket) for every block, also for those that asked nothing."""
    def end(key, rows, told):
        return result(tidy(rows), rows_of(told)[2])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(end, schema)


def two_answers(blocks: DataFrame, near: DataFrame, far: DataFrame, result: Callable[[pa.Table, tuple[list[bytes], list[bytes]]], pa.Table], schema: str | StructType) -> DataFrame:
    """result(rows, (payloads of the first answer, payloads of the second)) for every block."""
    both = near.union(far.selectExpr("block", "-1 - bucket", "payload"))

    def end(key, rows, told):
        _, bucket, payload = rows_of(told)
        split = sum(b < 0 for b in bucket)
        return result(tidy(rows), (payload[split:], payload[:split][::-1]))

    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(end, schema)


def with_carried(schema: str, blocks: DataFrame, carry: Sequence[str]) -> StructType:
    """The schema of a result to which the carried columns are added by name."""
    own = StructType.fromDDL(schema)
    return StructType(own.fields + (list(blocks.schema["carried"].dataType.fields) if carry else []))


def ids_of(rows: pa.Table) -> pa.Array:
    known = rows["known"].to_numpy()
    return pa.array(rows["id"].to_numpy(), pa.int64(), mask=~known)


def carried_of(rows: pa.Table, carry: Sequence[str]) -> dict[str, pa.Array]:
    flat = rows["carried"].combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return dict(zip(carry, flat.flatten())) if carry else {}


# Sums of long arrays over tasks: in slices, so that neither a task nor the driver holds many arrays.

SLICES = 1024


def in_slices(total: np.ndarray) -> pa.RecordBatch:
    parts = np.array_split(total, SLICES)
    return pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["slice", "part"])


def add_slices(parts: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    """The sum of the arrays that tasks gave as ``in_slices`` (slice int, part binary); only the sum reaches the driver."""
    def add(rows):
        total = sum(np.frombuffer(p, kind) for p in rows["part"].to_pylist())
        return pa.table({"slice": rows["slice"][:1], "part": pa.array([total.tobytes()], pa.binary())})

    rows = parts.groupBy("slice").applyInArrow(add, "slice int, part binary").collect()
    return np.concatenate([np.frombuffer(r["part"], kind) for r in sorted(rows, key=lambda r: r["slice"])]) if rows else np.zeros(size, kind)


# Which hashes occur at least twice. The fingerprint has 32 bits beside the bucket's own, so a few
# hashes are called shared that are not; callers verify what they keep.

def fingerprints(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), hashes.astype(np.uint32)


def once_each(hashes: np.ndarray, twice_at: np.ndarray | None, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, fingerprint) in order; whether it counts as two by itself; for each hash its entry.

    ``twice_at``: the group (e.g. document) of each hash; two groups make two. None: two places do.
    """
    bucket, small = fingerprints(hashes, buckets)
    keys, entry, count = np.unique((bucket.astype(np.uint64) << np.uint64(32)) | small, return_inverse=True, return_counts=True)
    if twice_at is None:
        twice = count > 1
    else:
        low, high = np.full(len(keys), 2**62), np.full(len(keys), -1)
        np.minimum.at(low, entry, twice_at)
        np.maximum.at(high, entry, twice_at)
        twice = high > low
    return (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32), twice, entry


def shared_question(block: int, bucket: np.ndarray, small: np.ndarray, twice: np.ndarray) -> pa.Table:
    return pack(block, bucket, [small, twice.astype(np.uint8)])


def shared_answer(payloads: list[bytes]) -> list[bytes]:
    """For each entry a byte: 1 if another block has it too or its own block has it twice."""
    parts = [unpack(p, [np.dtype(np.uint32), np.dtype(np.uint8)]) for p in payloads]
    small = np.concatenate([p[0] for p in parts])
    _, entry, count = np.unique(small, return_inverse=True, return_counts=True)
    yes = ((count[entry] > 1) | (np.concatenate([p[1] for p in parts]) > 0)).astype(np.uint8)
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    return [y.tobytes() for y in np.split(yes, cuts)]


def joined(payloads: list[bytes], kind=np.uint8) -> np.ndarray:
    return np.frombuffer(b"".join(payloads), kind)
