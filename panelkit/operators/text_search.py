"""Substring search over an index of short pieces of text.

The index has a row for every piece of one to three characters of an entity's texts. It is stored in
the order of the pieces, so a search reads the files of its own pieces only; their lists are
intersected before any text is looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.config import ENTITY
from panelkit.session import store

PIECE = 3


def _pieces(text: Column, sizes: Sequence[int]) -> Column:
    """The distinct pieces of these sizes; none where the text is shorter."""
    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
        return F.when(F.length(text) >= n, F.transform(starts, lambda i: F.substr(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(*map(of_size, sizes))))


def build_index(entities: DataFrame, columns: Sequence[str], id: str = ENTITY, parts: int | None = None) -> DataFrame:
    """(piece, column number, id), stored in ranges of pieces; ids are those of rows, not of distinct texts."""
    parts = parts or int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = [F.struct(F.lit(i).alias("field"), F.lower(F.col(f"`{c}`")).alias("text")) for i, c in enumerate(columns)]
    own = entities.select(F.col(f"`{id}`").alias("id"), F.explode(F.array(*rows)).alias("r")).select("id", "r.*").filter("text IS NOT NULL")
    index = own.select(F.explode(_pieces(F.col("text"), range(1, PIECE + 1))).alias("piece"), "field", "id").distinct()
    return store(index.repartitionByRange(parts, "piece", "id").sortWithinPartitions("piece", "id"), "pieces")


def search_index(index: DataFrame, entities: DataFrame, text: str, columns: Sequence[str], k: int = 15, id: str = ENTITY,
                 order: Sequence[str] = (ENTITY,)) -> DataFrame:
    """The rows ``relational.search`` finds: a case-insensitive substring of any of the columns, first ``k`` in order."""
    needle = text.lower().strip()
    if not needle:
        return entities.limit(0)
    size = min(len(needle), PIECE)
    pieces = sorted({needle[i:i + size] for i in range(len(needle) - size + 1)})
    lists = index.filter(F.col("piece").isin(pieces)).groupBy("id", "field").agg(F.count_distinct("piece").alias("n"))
    likely = lists.filter(F.col("n") == len(pieces)).select(F.col("id").alias(id)).distinct()
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(F.col(f"`{c}`")).contains(needle), F.lit(False))
    return entities.join(likely, id, "left_semi").filter(hit).orderBy(*order).limit(k)
