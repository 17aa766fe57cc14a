"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
next one's documents. All but the last return the columns of ``documents``. Rows are told apart by a
hash of id and text, so rows without an id and rows that share one are treated each by itself; rows
that agree in both have the same fate. No stage can be put as SQL in full: the models, the template
tree and the packing have no SQL form, so ORACLE_SQL is None and the tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.llm.decontamination import decontaminate
from panelkit.llm.importance import keep_selected
from panelkit.llm.jaccard_join import jaccard_join
from panelkit.llm.line_dedup import line_dedup
from panelkit.llm.packing import pack_documents, tokenizer_path
from panelkit.llm.registry import query, table
from panelkit.session import store

NEAR_WORDS, NEAR_PERCENT = 5, 80
ROW = "row of the pipeline"  # the key's column name


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards those labelled good; the others go.

    Null and empty texts weigh 0 and are drawn by their noise alone; repeated rows go or stay together; an empty
    table stays empty; long texts are taken whole.
    """
    return keep_selected(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str, min_tokens: int = 1) -> DataFrame:
    """Lines whose template an earlier document has go, and with them documents that lose all they had.

    Lines of every length are taken, so that of a later copy nothing is left. Null texts become empty ones;
    n_chars counts what is left.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = line_dedup(docs, min_tokens=min_tokens, carry=others)
    out = out.filter((F.col("n_dropped") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]")).withColumnRenamed("kept", "text")
    if "n_chars" in others:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles (similarity 0.8 or more) the smallest id stays."""
    marked = docs.withColumn(ROW, row_key())
    found = jaccard_join(marked, n_words=NEAR_WORDS, percent=NEAR_PERCENT, carry=[ROW])
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(f"`{ROW}`"))
    stay = found.filter("`group` IS NOT NULL").groupBy("group").agg(F.min(order).alias("first")).select(F.col(f"first.`{ROW}`").alias(ROW))
    alone = found.filter("`group` IS NULL").select(F.col(f"`{ROW}`")).distinct()
    chosen = marked.join(stay.withColumn("once", F.lit(True)).unionByName(alone.withColumn("once", F.lit(False))), ROW)
    # Repeated rows of one id and text are one document of a group; blank ones are in no group.
    once = chosen.filter("once").dropDuplicates([ROW])
    return once.unionByName(chosen.filter("NOT once")).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any window of a benchmark item go. Null and empty texts and repeated rows have none or the
    same; an empty table stays empty; long texts are taken whole."""
    marked = docs.withColumn(ROW, row_key())
    found = decontaminate(marked, table(spark, sf_dir, "benchmark"), id_col=ROW)
    return marked.join(found.filter("contaminated").select(F.col("doc_id").alias(ROW)).distinct(), ROW, "left_anti").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences. A null or empty text is its end token;
    repeated rows are packed each; an empty table gives no pieces; long texts are cut into pieces."""
    return pack_documents(docs, tokenizer_path())


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("decontamination", benchmark), ("packing", packing)]
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
