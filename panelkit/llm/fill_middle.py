"""Fill-in-the-middle: documents cut into prefix, middle and suffix, and put together in another order.

A document's units are runs of ASCII letters and single other code points, so no cut falls into a
word. Each batch goes through one chain of ``pyarrow.compute`` calls: units are split into list
arrays, flattened with the row each came from, numbered within the row, filtered by role, built into
lists again and joined. Where a document is cut and which form it takes follow from a hash of its id
alone, so a task that is run again gives the same rows.

Defined cases: a null text is empty; empty texts and texts with a marker in them stay plain; a null id
is hashed as the seed alone; repeated rows and rows of one id are each treated alike; other columns
are not looked at; an empty table gives an empty one. A long text is handled whole: a batch is worked
on in slices of a few MB, and one document is the least a slice can hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.llm.registry import query, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 2 << 20
# UTF-8 seen as bytes: a run of letters, another ASCII byte, or a lead byte with those that follow it.
UNIT = rb"([A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\xc2-\xf4][\x80-\xbf]+)"
BETWEEN = b"\xff"  # no byte of any UTF-8 text
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def hash_numbers(id_col: str, seed: str) -> Column:
    """The first four 32-bit numbers of the SHA-256 of seed and decimal id."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def remainder(a, b):
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _joined(units: pa.Array, role: pa.Array, counts: pa.Array) -> pa.Array:
    """The units of one role, put together per row."""
    ends = pc.cumulative_sum(counts).cast(pa.int64())
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends])
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, pc.filter(units, role)), pa.scalar(b"", pa.large_binary()))


def cut_and_join(text: pa.Array, h: list[pa.Array], plain_percent: int, spm_percent: int) -> dict[str, pa.Array]:
    """Columns n, form, prefix_chars, middle_chars and output of a large_binary column of texts."""
    lists = pc.split_pattern(pc.replace_substring_regex(text, pattern=UNIT, replacement=rb"\1" + BETWEEN), pattern=BETWEEN)
    n = pc.subtract(pc.list_value_length(lists), 1).cast(pa.int64())  # behind the last unit stands an empty one
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    first = lists.offsets.slice(0, len(lists)).cast(pa.int64())
    place = pc.subtract(pc.cumulative_sum(pa.repeat(pa.scalar(1, pa.int64()), len(units))), 1)
    ordinal = pc.subtract(place, pc.take(first, parent))

    one, other = (remainder(x, pc.add(n, 1)) for x in h[:2])
    low, high = pc.min_element_wise(one, other), pc.max_element_wise(one, other)
    below, above = pc.less(ordinal, pc.take(low, parent)), pc.greater_equal(ordinal, pc.take(high, parent))
    is_unit = pc.less(ordinal, pc.take(n, parent))
    prefix = _joined(units, below, low)
    middle = _joined(units, pc.and_(pc.invert(below), pc.invert(above)), pc.subtract(high, low))
    suffix = _joined(units, pc.and_(above, is_unit), pc.subtract(n, high))

    marked = pc.or_(pc.or_(pc.match_substring(text, PREFIX), pc.match_substring(text, SUFFIX)), pc.match_substring(text, MIDDLE))
    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(pc.or_(pc.equal(n, 0), marked), pc.greater_equal(remainder(h[2], hundred), 100 - plain_percent))
    spm = pc.less(remainder(h[3], hundred), spm_percent)
    p, s, m, none = (pa.scalar(x.encode(), pa.large_binary()) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    moved = pc.if_else(spm, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none), pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none))
    count = lambda piece: pc.if_else(plain, None, pc.utf8_length(piece.cast(pa.large_string())).cast(pa.int64()))
    return {
        "n": n, "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        "prefix_chars": count(prefix), "middle_chars": count(middle), "output": pc.if_else(plain, text, moved).cast(pa.large_string()),
    }


def slices(batch: pa.RecordBatch, column: str, each: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Whole rows at a time, about ``each`` bytes of text."""
    if not len(batch):
        return
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).cast(pa.int64())
    number = pc.divide(pc.subtract(pc.cumulative_sum(sizes), sizes), each)  # rises from row to row
    at = 0
    for run in pc.run_end_encode(number).run_ends.to_pylist():
        yield batch.slice(at, run - at)
        at = run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain_percent: int = 10, spm_percent: int = 20, seed: str = "1:") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain), output: one row per row of ``docs``.

    ``plain_percent`` of the documents stay as they are; of the others ``spm_percent`` begin with the
    suffix (spm), the rest with the prefix (psm).
    """
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), hash_numbers(id_col, seed).alias("h"))
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                text = part["text"].cast(pa.large_binary())
                h = [pc.list_element(part["h"], i) for i in range(4)]
                out = cut_and_join(text, h, plain_percent, spm_percent)
                yield pa.RecordBatch.from_arrays([part["doc_id"]] + [out[c].cast(schema.field(c).type) for c in schema.names[1:]], schema=schema)

    return own.mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of. A marker cannot arise where pieces meet, so each stands there once."""
    def between(start: str, end: str | None) -> Column:
        at = F.locate(start, output) + len(start)
        return output.substr(at, (F.locate(end, output) if end else F.length(output) + 1) - at)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents),
h AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
         ('0x' || substr(hex, 1, 8))::BIGINT AS h1, ('0x' || substr(hex, 9, 8))::BIGINT AS h2,
         ('0x' || substr(hex, 17, 8))::BIGINT AS h3, ('0x' || substr(hex, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high FROM h),
p AS (
  SELECT doc_id, text, n, coalesce(array_to_string(units[1:low], ''), '') AS prefix, coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
         coalesce(array_to_string(units[high + 1:n], ''), '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""


@query("op12_fill_in_middle", SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-the-middle form, its output and the text rebuilt from it by their hashes."""
    found = fill_in_middle(table(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))
